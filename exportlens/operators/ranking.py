"""Ranks, top-k, previous-row growth and running totals.

A window without PARTITION BY pulls its whole input into one task. The operators here use one only
on inputs whose size is fixed (counts of rank ranges, the n rows of a top-n, rollups by market, years, cost components);
a rank over an unbounded set goes through sorted ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exportlens.functions import pct
from exportlens.sources.warehouse import written

RANK_BUCKETS = 4096
# ``monotonically_increasing_id`` holds the partition above this many bits of row number.
_ROW_BITS = 33
# Value range of a 64-bit hash, as bounds for ``with_rank``.
HASH_BOUNDS = (-(2.0**63), 2.0**63)


def _bucket(value: Column, lo: Column, hi: Column, descending: bool) -> Column:
    """Order-preserving bucket number 0..RANK_BUCKETS-1; NULLs go to the bucket after the last.

    Values outside lo..hi go to the outermost buckets, so a rough range only costs balance.
    """
    x, lo, hi = (c.cast("double") for c in (value, lo, hi))
    width = F.nullif(hi - lo, F.lit(0.0))
    scaled = F.coalesce((x - lo) / width, F.lit(0.0)) * RANK_BUCKETS
    place = F.least(F.greatest(F.floor(scaled), F.lit(0)), F.lit(RANK_BUCKETS - 1)).cast("int")
    if descending:
        place = F.lit(RANK_BUCKETS - 1) - place
    return F.when(value.isNull(), F.lit(RANK_BUCKETS)).otherwise(place)


def sorted_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows in total order over the partitions, whose bounds are sampled from all of ``order``."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def with_rank(
    df: DataFrame,
    by: str,
    tie: Sequence[str],
    *,
    descending: bool = True,
    rank: str = "rank",
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """1-based position of every row by the number ``by``, ties by the unique key ``tie``.

    NULLs come last. The rows are dealt by sampled ranges of (by, tie), so neither an outlier nor a
    value that most rows share fills one task: its ties are dealt too. The sorted ranges are numbered
    and written once; only the ranges' counts meet in one task. ``bounds`` is for values known to be
    spread evenly over them, such as hashes: rows are then numbered inside equal-width buckets,
    without sampling or writing. A value beyond the bounds is still ranked exactly.
    """
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    if bounds:
        lo, hi = (F.lit(b) for b in bounds)
        inside = Window.partitionBy("_bucket").orderBy(order, *tie)
        placed = df.withColumn("_bucket", _bucket(F.col(by), lo, hi, descending))
        numbered = placed.withColumn("_place", F.row_number().over(inside))
    else:
        return with_position(df, [order, *tie], rank)
    return _with_offsets(numbered, placed, rank)


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """1-based place of every row in the total order ``order``, which should end with a unique key.

    The rows are dealt by sampled ranges of the order and sorted inside them, and the numbered ranges are written once, so
    that their counts and their rows are of the same ranges.
    """
    ranges = sorted_ranges(df, *order)
    numbered = written(ranges.withColumn("_at", F.monotonically_increasing_id())).withColumns({
        "_bucket": F.shiftright("_at", _ROW_BITS),
        "_place": F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1) + 1,
    }).drop("_at")
    return _with_offsets(numbered, numbered, name)


def _with_offsets(numbered: DataFrame, placed: DataFrame, rank: str) -> DataFrame:
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per bucket or per range, at most a few thousand.
    return (
        numbered.join(F.broadcast(offsets), "_bucket")
        .withColumn(rank, F.col("_offset") + F.col("_place"))
        .drop("_bucket", "_offset", "_place")
    )


def rank_rollup(df: DataFrame, by: str, tie: Sequence[str], *, descending: bool = True, rank: str = "rank") -> DataFrame:
    """:func:`with_rank` for a rollup by the rows of a small dimension, such as markets or categories.

    Such a frame fits a task whatever the facts' size, so it is numbered in one sorted partition and not written.
    """
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.withColumn(rank, F.row_number().over(Window.orderBy(order, *tie)))


def top_n(df: DataFrame, by: Sequence[Column], n: int, *, rank: str | None = None) -> DataFrame:
    """First ``n`` rows in the order ``by`` (state null placement, end with a unique key).

    Sort + limit plans as a per-partition top-n followed by a merge, so tasks pass on at most n rows.
    """
    top = df.orderBy(*by).limit(n)
    if rank:
        top = top.withColumn(rank, F.row_number().over(Window.orderBy(*by)))
    return top


def top_k_per(
    df: DataFrame, part: Sequence[str], by: Sequence[Column], k: int, *, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group. Spark limits each group before the shuffle."""
    window = Window.partitionBy(*part).orderBy(*by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def rank_over_agg(
    df: DataFrame, part: Sequence[str], by: Column, *, rank: str = "rank"
) -> DataFrame:
    """RANK() (gaps after ties) inside each group of an already aggregated frame."""
    return df.withColumn(rank, F.rank().over(Window.partitionBy(*part).orderBy(by)))


def growth_pct(
    df: DataFrame,
    order: str,
    col: str,
    *,
    part: Sequence[str] = (),
    digits: int = 1,
    scale: int = 2,
    name: str = "growth_pct",
    previous: str | None = None,
) -> DataFrame:
    """Percent change against the previous row; the first row of a series has none.

    Without ``part`` the frame must be a short rolled-up series, such as one row per year. For series of
    any length see ``operators.series``; ``previous`` names a column that holds the previous value already.
    """
    before = F.col(previous) if previous else F.lag(col).over(Window.partitionBy(*part).orderBy(order))
    return df.withColumn("_prev", before).withColumn(
        name, pct(F.col(col) - F.col("_prev"), F.col("_prev"), digits, scale=scale)
    ).drop("_prev")


def running_total(
    df: DataFrame, order: str, col: str, *, part: Sequence[str] = (), inclusive: bool = True,
    name: str = "running_total",
) -> DataFrame:
    """Cumulative sum in ``order``; ``inclusive=False`` gives the base under each step (0 first)."""
    window = Window.partitionBy(*part).orderBy(order)
    window = window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return df.withColumn(name, F.coalesce(F.sum(col).over(window), F.lit(0)))
