"""Exact distinct counts that merge: bitmaps of ids, kept as states by period and joined to coarser ones.

A state row holds the ids of one group within one range of 32,768 numbers as a bitmap of 4 KB. States of
months are merged to quarters, years and a total by OR, so a coarser count reads the states and not
the facts. Ids are whole numbers and should be dense, as surrogate keys are: a range with a single id costs as much as a full one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_states(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys…, bucket, ids): one bitmap per group and range of ids. Null ids are left out.

    The ids of a group are first reduced to distinct ones, on the map side too, so a hot group or a hot id is
    small before any shuffle. These are then dealt by group and range, so that a bitmap is built in one place and none
    is shuffled in parts: each task would otherwise send a part of every bitmap.
    """
    x = F.col(column).cast("long")
    pairs = df.where(F.col(column).isNotNull()).select(*keys, x.alias("_id")).distinct()
    placed = pairs.withColumn("bucket", F.bitmap_bucket_number("_id")).repartition(*keys, "bucket")
    return placed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("ids"))


def merge_distinct(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """States of coarser groups; ``keys`` are columns of ``states`` or expressions over them."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def count_states(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys…, ``name``): distinct ids of each group of merged states."""
    return states.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(name))


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> list[DataFrame]:
    """For each name -> id column the (keys…, name) counts, every one from a scan of its own few columns.

    Several COUNT(DISTINCT)s in one aggregation would repeat every row per column. The distinct pairs of keys and id
    are counted, at most one narrow row per fact; bitmaps would be 4 KB for each group and range of ids, however few ids
    a group has, and products number as the ids do.
    """
    out = []
    for name, column in columns.items():
        pairs = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("_id")).distinct()
        out.append(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
    return out


def join_counts(df: DataFrame, counts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``df`` with the counts of its groups, 0 where a group has no id; null keys match each other."""
    for part in counts:
        name = part.columns[-1]
        part = part.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.lit(True))
        df = df.join(part, same, "left").drop(*[f"_{k}" for k in keys]).withColumn(name, F.coalesce(name, F.lit(0)))
    return df


def distinct_by_period(df: DataFrame, column: str, name: str) -> DataFrame:
    """(period, fiscal_year, quarter, month_num, ``name``): distinct ids by month, quarter and year and in all.

    The facts are read once, for the months; each coarser period merges the states of the finer one.
    """
    levels = ["fiscal_year", "quarter", "month_num"]
    states, parts = distinct_states(df, levels, column), []
    for depth, period in ((3, "month"), (2, "quarter"), (1, "year"), (0, "all")):
        keys = levels[:depth]
        states = states if depth == 3 else merge_distinct(states, keys)
        counts = count_states(states, keys, name)
        missing = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in levels[depth:]]
        parts.append(counts.select(F.lit(period).alias("period"), *keys, *missing, name))
    return reduce(DataFrame.unionByName, parts)
