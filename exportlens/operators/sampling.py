"""Reproducible sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Digits of the hash by which rows are counted: 16^4 buckets.
_BUCKETS = 1 << 16
_BUCKET_SHIFT = 44


def sample_orders(
    orders: DataFrame, n: int, seed: int = 42, *, key: Sequence[str] = ("order_id",), status: str = "Delivered"
) -> DataFrame:
    """Exactly ``n`` orders of one status (or all, if fewer), without replacement.

    The rows with the n smallest seeded key hashes are kept, the MD5 of seed and key as text: the same
    key and seed always give the same sample, whatever the partitioning or the engine. Counts per hash bucket, of which
    there are 65,536 at most, settle the bucket that holds the n-th hash: rows of lower buckets are kept as they are,
    and only that bucket's rows are put in order, so no window or sort sees the pool and a large n meets in no task.
    """
    pool = orders.where(F.col("order_status") == status)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    # The first 15 hexadecimal digits as a number.
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    hashed = pool.withColumn("_hash", number)
    bucket = F.shiftright("_hash", _BUCKET_SHIFT)
    # Only key hashes are read for the counts; the running sum is over the buckets.
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = hashed.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    reached = counts.where(F.col("_upto") >= n).agg(F.min("_bucket"))
    before = counts.where(F.col("_upto") < n).agg(F.max("_upto"))
    last = F.coalesce(reached.scalar(), F.lit(_BUCKETS))  # no bucket: the pool has fewer than n rows
    inside = Window.partitionBy("_bucket").orderBy("_hash", *key)
    rest = hashed.withColumn("_bucket", bucket).where(F.col("_bucket") == last)
    rest = rest.withColumn("_place", F.row_number().over(inside)).where(F.col("_place") <= F.lit(n) - F.coalesce(before.scalar(), F.lit(0)))
    return hashed.where(bucket < last).drop("_hash").unionByName(rest.drop("_hash", "_bucket", "_place"))
