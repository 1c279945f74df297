"""Reading, writing and naming the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exportlens.sources.schemas import PARTITION_COLUMNS, SCHEMAS


def read_table(
    spark: SparkSession,
    path: str,
    name: str,
    *,
    fmt: str = "csv",
    null_values: str | None = None,
) -> DataFrame:
    """Scan one of the nine tables with its declared schema (types are never inferred).

    CSV columns are matched to the header; a malformed value stops the load. ``null_values`` names
    a text to read as NULL; by default the text ``None`` of ``delay_reason`` is kept as it is.
    """
    if fmt == "parquet":
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    reader = (
        spark.read.schema(SCHEMAS[name])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
    )
    if null_values is not None:
        reader = reader.option("nullValue", null_values)
    return reader.csv(path)


def load_table(df: DataFrame, path: str, name: str, mode: str = "append", dealt: bool = False) -> None:
    """Write a table as Parquet in one distributed job; ``mode="overwrite"`` recreates it.

    Facts are partitioned by year. The rebalance hint lets adaptive execution split a large year
    over many writers and merge small ones, so neither one task nor thousands of tiny files carry
    a year. ``dealt`` says that the rows come dealt that way already.
    """
    columns = [f.name for f in SCHEMAS[name].fields]
    partitions = PARTITION_COLUMNS.get(name, [])
    out = df.select(*columns)
    if partitions and not dealt:
        out = out.hint("rebalance", *[F.col(c) for c in partitions])
    writer = out.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a result as CSV part files with a header and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Manifest of (table_name, row_count), one count per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    """Create or replace one temporary view per table, for ad-hoc ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_views(
    tables: Mapping[str, DataFrame], views: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]]
) -> list[str]:
    """Create or replace a temporary view ``vw_<name>`` per KPI view; returns the names."""
    names = []
    for name, build in views.items():
        build(tables).createOrReplaceTempView(f"vw_{name}")
        names.append(f"vw_{name}")
    return names


def view(spark: SparkSession, name: str) -> DataFrame:
    """A registered KPI view as a DataFrame."""
    return spark.table(f"vw_{name}")
