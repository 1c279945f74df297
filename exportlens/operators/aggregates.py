"""Grouped operators: additive states, modal value, argument of the maximum, zero fill, reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.functions import dec
from exportlens.operators.distinct import distinct_counts, join_counts


def merge_states(df: DataFrame, keys: Sequence[str], states: Sequence[str]) -> DataFrame:
    """Sum additive states (sums, counts) up to coarser ``keys``.

    The views aggregate a fact by its ids first and join dimensions to the few result rows; this
    is the second level, which regroups by the dimension's names. Sums and counts merge exactly,
    so nothing is averaged twice, the fact never meets a dimension row by row, and a hot id is
    combined on the map side before any shuffle.
    """
    return df.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in states])


def with_distinct_counts(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], distinct: Mapping[str, str]
) -> DataFrame:
    """GROUP BY with plain aggregates and several COUNT(DISTINCT)s, ``distinct`` = name -> column.

    In one aggregation Spark repeats every row per distinct column and shuffles each distinct
    (keys, value) pair together with a buffer for all the other aggregates. Here every column is
    counted from its distinct pairs with the keys (``operators.distinct``), by a scan of its own few columns, and the plain
    aggregates combine to one row per group and task. The results, one row per group each, are
    joined on the keys; NULL keys match each other as in GROUP BY.
    """
    return join_counts(df.groupBy(*keys).agg(*aggs), distinct_counts(df, keys, distinct), keys)


def sums(**columns: Column | str) -> list[Column]:
    """``name=column`` pairs as SUM states."""
    return [F.sum(c).alias(name) for name, c in columns.items()]


def unit_ratio(amount: str, quantity: str) -> Column:
    """Row ratio money / whole number as DECIMAL(25, 13); NULL for a zero quantity."""
    return dec(amount, 14, 2) / F.nullif(dec(quantity, 10, 0), F.lit(0))


def money_ratio_pct(amount: str, base: str) -> Column:
    """Row ratio money / money * 100 with 17 fraction digits; NULL for a zero base."""
    return dec(amount, 14, 2) / F.nullif(dec(base, 14, 2), F.lit(0)) * F.lit(100)


def mode_by(df: DataFrame, keys: Sequence[str], col: str, *, name: str = "mode") -> DataFrame:
    """Most frequent value per group; a tie goes to the smallest value, NULLs do not count.

    Two aggregations instead of a per-group value buffer: a group of any size is first reduced to
    its distinct values on the map side.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(mode_of(col, "_n").alias(name))


def mode_of(value: str, count: str) -> Column:
    """Aggregate over (value, count) rows: the value with the largest count, smallest on a tie."""
    pair = F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))
    return F.min(F.when(F.col(value).isNotNull(), pair))["v"]


def arg_max(value: str, by: str, tie: str) -> Column:
    """Aggregate: ``value`` of the row with the largest ``by``; a tie goes to the smallest ``tie``."""
    best = F.struct((-F.col(by)).alias("b"), F.col(tie).alias("t"), F.col(value).alias("v"))
    return F.min(F.when(F.col(by).isNotNull(), best))["v"]


def arg_min(value: str, by: str, tie: str) -> Column:
    """Aggregate: ``value`` of the row with the smallest ``by``; a tie goes to the smallest ``tie``."""
    best = F.struct(F.col(by).alias("b"), F.col(tie).alias("t"), F.col(value).alias("v"))
    return F.min(F.when(F.col(by).isNotNull(), best))["v"]


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace NULL by 0 in the named columns only (groups without facts after a left join)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def drop_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where one column is present."""
    return df.dropna(subset=[col])


def unpivot(
    df: DataFrame, ids: Sequence[str], cols: Mapping[str, str], *, variable: str, value: str, value_type: str
) -> DataFrame:
    """Wide to long. ``cols`` maps a column to its label; all values are cast to ``value_type``."""
    wide = df.select(*ids, *[F.col(c).cast(value_type).alias(label) for c, label in cols.items()])
    return wide.unpivot(list(ids), list(cols.values()), variable, value)


def pivot(df: DataFrame, row: str, column: str, labels: Mapping, value: Column) -> DataFrame:
    """Long to wide with the column values stated, so no extra job looks for them."""
    wide = df.groupBy(row).pivot(column, list(labels)).agg(value)
    return wide.withColumnsRenamed({str(k): v for k, v in labels.items()})
