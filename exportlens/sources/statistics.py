"""Row counts and extremes of written tables from the statistics in their files.

The vectorised source answers COUNT, MIN and MAX of plain columns from Parquet footers, without reading a
row, if the scan is one of its own kind and nothing but columns and partitions is asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LIST, PUSHDOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def footer_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan of Parquet files whose COUNT, MIN and MAX come from the footers.

    Which kind of scan a path gets is settled when it is read, so the session's list is changed for this
    call only; the pushdown is looked up when the query is planned and stays on. It concerns no other scan.
    """
    before = spark.conf.get(LIST)
    spark.conf.set(PUSHDOWN, "true")
    try:
        spark.conf.set(LIST, ",".join(x for x in before.split(",") if x != "parquet"))
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(LIST, before)


def file_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of :func:`footer_scan` tables."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def file_extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, row_count, present, min, max) of whole-number columns of a :func:`footer_scan`; one row each."""
    cells = [x for c in columns for x in (F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
    row = df.agg(F.count("*").alias("row_count"), *cells)
    return row.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("row_count"), F.col(f"n_{c}").alias("present"),
        F.col(f"lo_{c}").cast("long").alias("min"), F.col(f"hi_{c}").cast("long").alias("max")) for c in columns])))
