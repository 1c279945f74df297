"""Calendar spine and dense panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exportlens.operators.ranking import HASH_BOUNDS, with_rank


def _days(start, end, step: int) -> Column:
    as_date = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("date")
    return F.sequence(as_date(start), as_date(end), F.expr(f"INTERVAL {int(step)} DAY"))


def date_spine(spark: SparkSession, start, end, step: int = 1) -> DataFrame:
    """One row per ``step`` days from ``start`` through ``end``.

    ``start`` and ``end`` may be dates, ISO strings or scalar-subquery columns.
    """
    return spark.range(1).select(F.explode(_days(start, end, step)).alias("date"))


def dense_panel(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, start, end, step: int = 1
) -> DataFrame:
    """Every left key x right key x date, the frame a daily panel fact is laid out on.

    The right keys get dense positions 1..M; each left row explodes to M positions and meets its
    partner in an equi-join. That spreads the panel evenly over tasks and needs neither a cross
    join nor the keys on the driver. Dates are exploded last, row by row, without a shuffle.
    """
    lefts = left.select(left_key).distinct()
    hashed = right.select(right_key).distinct().withColumn("_h", F.xxhash64(right_key))
    rights = with_rank(hashed, "_h", [right_key], rank="_pos", bounds=HASH_BOUNDS).drop("_h")
    last = right.agg(F.countDistinct(right_key)).scalar()
    return (
        lefts.select(left_key, F.explode(F.sequence(F.lit(1), last.cast("int"))).alias("_pos"))
        .join(rights.withColumn("_pos", F.col("_pos").cast("int")), "_pos")
        .select(left_key, right_key, F.explode(_days(start, end, step)).alias("date"))
    )
