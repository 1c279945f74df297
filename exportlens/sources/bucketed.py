"""Tables bucketed by key, so that joins and groupings on the key find their rows in place.

A bucketed table lives in the session's catalog: the catalog holds its bucket count and key, the
files lie in the folder given. Two tables of the same count and key are joined bucket by bucket without moving a row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a table: the session's number of shuffle partitions, by which joins are sized anyhow."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df`` written once to ``path`` as catalog table ``table``, dealt and sorted by ``keys``; a scan of it.

    One shuffle deals the rows to their buckets, so each bucket is one file; Spark leaves it out if the rows lie so already. A table of that name is replaced. Keys
    should be nearly unique, as order ids are: a bucket is what one task reads in a join.
    """
    spark = df.sparkSession
    buckets = buckets or bucket_count(spark)
    if not re.fullmatch(r"\w+", table):
        raise ValueError(f"not a plain table name: {table}")
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd").option("parquet.writer.version", "v2")
    writer.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).saveAsTable(table)
    return spark.table(table)
