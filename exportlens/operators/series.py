"""Previous row and running total of long series.

A window per series sends the whole series to one task. Here the rows are dealt by sorted ranges of
(series, order), so one series may fill any number of tasks. Inside a range the rows are next to each other;
what a range needs from those before it is one state per series: the last row and the total so
far. These states are one row per range and series that begins, ends or crosses there, and are chained by a window over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exportlens.operators.ranking import _ROW_BITS, sorted_ranges
from exportlens.sources.warehouse import written


def _numbered(df: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows in sorted ranges with _range and _row, written once so that both readers see the same ranges."""
    at = F.monotonically_increasing_id()
    ranges = written(sorted_ranges(df, *part, *order).withColumn("_at", at))
    return ranges.withColumns({"_range": F.shiftright("_at", _ROW_BITS), "_row": F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)}).drop("_at")


def _with_states(rows: DataFrame, part: Sequence[str], states: DataFrame) -> DataFrame:
    names = states.withColumnsRenamed({c: f"_s_{c}" for c in [*part, "_range"]})
    same = F.col("_range") == F.col("_s__range")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return rows.join(names, same, "left").drop(*[f"_s_{c}" for c in [*part, "_range"]])


def with_previous(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, name: str = "previous") -> DataFrame:
    """``name`` = ``col`` of the row before in the series, null for its first row. ``order`` should be unique in a series.

    The same as LAG over PARTITION BY part ORDER BY order, with any series spread over tasks.
    """
    rows = _numbered(df, part, order)
    inside = Window.partitionBy("_range", *part).orderBy("_row")
    last = rows.groupBy(*part, "_range").agg(F.max_by(F.struct(F.col(col).alias("v")), "_row").alias("_last"))
    # States: one row per series and range.
    chained = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(*part).orderBy("_range"))).drop("_last")
    first = F.row_number().over(inside) == 1
    rows = _with_states(rows.withColumns({"_first": first, "_near": F.lag(col).over(inside)}), part, chained)
    return rows.withColumn(name, F.when(F.col("_first"), F.col("_before.v")).otherwise(F.col("_near"))).drop("_first", "_near", "_before", "_range", "_row")


def with_running_total(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, name: str = "running_total") -> DataFrame:
    """``name`` = sum of ``col`` over the series up to and with the row; nulls add nothing, before any value it is 0."""
    rows = _numbered(df, part, order)
    inside = Window.partitionBy("_range", *part).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*part, "_range").agg(F.sum(col).alias("_sum"))
    before = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    chained = sums.withColumn("_base", F.sum("_sum").over(before)).drop("_sum")
    rows = _with_states(rows.withColumn("_near", F.sum(col).over(inside)), part, chained)
    kind = rows.schema["_near"].dataType
    zero = F.lit(0).cast(kind)
    return rows.withColumn(name, F.coalesce("_near", zero) + F.coalesce("_base", zero)).drop("_near", "_base", "_range", "_row")
