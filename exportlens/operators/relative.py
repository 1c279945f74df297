"""Measures relative to the whole set: shares, scaling, ratios, histogram.

All set-level numbers of an operator are one struct, taken in one pass as one uncorrelated scalar subquery. Spark
runs it once and hands the value to the tasks; no join is planned. The pass and the rows are two reads of the frame,
so a frame that is costly to evaluate is written first (``sources.warehouse.written``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.functions import as_double, dec, pct, round_ratio


def with_totals(df: DataFrame, totals: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Attach aggregates of another frame to every row, each as one column; the other frame is read once for all."""
    whole = totals.agg(F.struct(*[expr.alias(name) for name, expr in exprs.items()]).alias("_t")).scalar()
    return df.withColumn("_t", whole).withColumns({name: F.col("_t")[name] for name in exprs}).drop("_t")


def with_total(df: DataFrame, totals: DataFrame, expr: Column, name: str = "total") -> DataFrame:
    """Attach one aggregate of another frame to every row."""
    return with_totals(df, totals, {name: expr})


def share_of_total(df: DataFrame, col: str, digits: int, *, scale: int = 2, name: str = "share_pct") -> DataFrame:
    """Percent of the column total, rounded exactly."""
    out = with_total(df, df, F.sum(col), "_total")
    return out.withColumn(name, pct(col, "_total", digits, scale=scale)).drop("_total")


def scaled_to(x: Column, lo: Column, hi: Column, a: int, b: int, *, digits: int, scale: int) -> Column:
    """``x`` moved linearly from [lo, hi] to [a, b], half-even; NULL where the range has no width."""
    spread = hi - lo
    return round_ratio((x - lo) * F.lit(Decimal(b - a)) + spread * F.lit(Decimal(a)), spread, digits, scale=scale, even=True)


def ratio_of(x: Column, most: Column, k: int, *, digits: int, scale: int, plus: int = 0) -> Column:
    """``x / most * k + plus``, half-even."""
    return round_ratio(x * F.lit(Decimal(k)) + most * F.lit(Decimal(plus)), most, digits, scale=scale, even=True)


def min_max_scale(
    df: DataFrame, cols: dict[str, str], lo: int = 0, hi: int = 1, *, digits: int = 4, scale: int = 2
) -> DataFrame:
    """Add ``cols[c]`` = c scaled linearly so that the set spans [lo, hi]; half-even rounding.

    The fraction is formed from exact differences. A constant column has no spread and gives NULL.
    """
    edges, out = {}, {}
    for i, (col, name) in enumerate(cols.items()):
        x = dec(col, 20, scale)
        edges |= {f"_lo{i}": F.min(x), f"_hi{i}": F.max(x)}
        out[name] = scaled_to(x, F.col(f"_lo{i}"), F.col(f"_hi{i}"), lo, hi, digits=digits, scale=scale)
    return with_totals(df, df, edges).withColumns(out).drop(*edges)


def ratio_to_max(
    df: DataFrame, col: str, k: int, *, digits: int = 2, scale: int = 2, plus: int = 0, name: str = "ratio"
) -> DataFrame:
    """``col / max(col) * k + plus``, half-even rounding."""
    x = dec(col, 20, scale)
    ratio = ratio_of(x, F.col("_most"), k, digits=digits, scale=scale, plus=plus)
    return with_total(df, df, F.max(x), "_most").withColumn(name, ratio).drop("_most")


def ratio_to_mean(df: DataFrame, col: str, *, name: str = "ratio") -> DataFrame:
    """``col / mean(col)`` as a double, from an exact decimal total."""
    mean = as_double("_sum") / as_double("_count")
    out = with_totals(df, df, {"_sum": F.sum(col), "_count": F.count(col)})
    return out.withColumn(name, as_double(col) / mean).drop("_sum", "_count")


def histogram(df: DataFrame, col: str, bins: int = 30, *, scale: int = 1) -> DataFrame:
    """Equal-width bins over min..max, the last bin closed, empty bins included.

    Bin numbers come from exact arithmetic. A constant column falls into the middle bin of a range
    one wide around it. The frame is evaluated once, to the count of each exact value, which is one row per value and
    task before the shuffle. Edges and bins both come from these counts: their plans are alike up to the shuffle, so it is run
    once and read twice, and nothing is written.
    """
    values = df.select(dec(col, 20, scale).alias("x")).where("x IS NOT NULL").groupBy("x").agg(F.count("*").alias("_n"))
    # The edges ask for the count as well, for otherwise their plan would have a shuffle of its own.
    there = F.when(F.col("_n") > 0, F.col("x"))
    edges = {"_min": F.min(there), "_max": F.max(there)}
    half = F.when(F.col("_min") == F.col("_max"), F.lit(Decimal("0.5"))).otherwise(F.lit(Decimal("0.0")))
    lo, hi = F.col("_min") - half, F.col("_max") + half
    place = F.call_function("div", (F.col("x") - lo) * F.lit(Decimal(bins)), hi - lo)
    counts = (
        with_totals(values, values, edges)
        .select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"), "_n")
        .groupBy("bin").agg(F.sum("_n").alias("n"))
    )
    every = with_totals(
        df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), values, edges
    )
    width = (as_double(hi) - as_double(lo)) / F.lit(float(bins))
    return every.join(counts, "bin", "left").select(
        "bin",
        (as_double(lo) + F.col("bin") * width).alias("bin_start"),
        (as_double(lo) + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
