"""Data-quality checks. Spark does not enforce keys or lengths, so these report violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructType

from exportlens.functions import as_double
from exportlens.operators.distinct import distinct_states


def _long(df: DataFrame, wide: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """One aggregation over the frame, returned as (name, value) rows."""
    cells = [F.struct(F.lit(k).alias(name), v.cast("bigint").alias(value)) for k, v in wide.items()]
    return df.agg(F.array(*cells).alias("_r")).select(F.inline("_r"))


def dq_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def dq_foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child key values without a parent row, with their row count; a NULL key passes.

    The child is reduced to its distinct keys on the map side first, so a hot key is one row by
    the time it meets the parent.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    parents = parent.select(F.col(parent_key or key).alias(key))
    return keys.join(parents, key, "left_anti")


def foreign_key_report(tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(child_table, key, orphan_keys, orphan_rows) for every declared (child, key, parent).

    Whole-number keys of dimensions are looked up in bitmaps of the parents' ids, other keys and those of a parent
    that is a fact by an anti join on the key, which co-bucketed tables do in place. Keys keep their types.
    """
    parts = []
    for child, key, parent in references:
        kinds = {tables[t].schema[key].dataType.simpleString() for t in (child, parent)}
        dense = kinds <= {"int", "bigint"} and parent.startswith("dim_")
        found = orphans_by_bitmap if dense else dq_foreign_key
        orphans = found(tables[child], key, tables[parent])
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(child).alias("child_table"), F.lit(key).alias("key"), "orphan_keys", "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def orphans_by_bitmap(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """:func:`dq_foreign_key` for dense whole-number ids: child ids whose bit is not set in the parent's bitmaps.

    The parent is one 4 KB bitmap per 32,768 ids, the child one row per id after the map side; the two meet by range of ids,
    where the child's rows test their bit. A range without parents has no bitmap and all its ids are orphans.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    keys = keys.withColumn("_bucket", F.bitmap_bucket_number(F.col(key).cast("long")))
    known = distinct_states(parent, [], parent_key or key).select(F.col("bucket").alias("_bucket"), "ids")
    at = F.bitmap_bit_position(F.col(key).cast("long"))
    byte = F.conv(F.hex(F.substring("ids", (F.call_function("div", at, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
    return keys.join(known, "_bucket", "left").where(F.col("ids").isNull() | ~is_set).select(key, "row_count")


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, null_count) of the columns that must be present, in one pass."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in cols}, "column_name", "null_count")


def dq_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per metric: rows, mean, min, max, sum, negative count. One pass over the table.

    The metrics are exact numbers (integers, decimals); the mean is the exact sum over the count.
    """
    cells = []
    for c in cols:
        x = F.col(c)
        total, present = F.sum(x), F.count(x)
        cells.append(F.struct(
            F.lit(c).alias("metric"),
            F.count("*").alias("row_count"),
            (as_double(total) / as_double(F.nullif(present, F.lit(0)))).alias("mean"),
            as_double(F.min(x)).alias("min"),
            as_double(F.max(x)).alias("max"),
            as_double(total).alias("sum"),
            F.count_if(x < 0).alias("negative_count"),
        ))
    return df.agg(F.array(*cells).alias("_r")).select(F.inline("_r"))


def dq_domain(df: DataFrame, schema: StructType) -> DataFrame:
    """(column_name, violations): values longer than declared or not fitting their decimal type.

    Fields need a ``max_length`` in their metadata (text) or a decimal type; others are not checked.
    """
    checks: dict[str, Column] = {}
    for field in schema.fields:
        x = F.col(field.name)
        if isinstance(field.dataType, StringType) and "max_length" in field.metadata:
            checks[field.name] = F.count_if(F.length(x.cast("string")) > field.metadata["max_length"])
        elif isinstance(field.dataType, DecimalType):
            limit = 10 ** (field.dataType.precision - field.dataType.scale)
            # Written out as text the value must not need more fraction digits than declared.
            rounded = F.round(x.cast(DecimalType(38, 10)), field.dataType.scale)
            fits = (F.abs(rounded) < F.lit(limit)) & (rounded == x.cast(DecimalType(38, 10)))
            checks[field.name] = F.count_if(~fits)
    return _long(df, checks, "column_name", "violations")


def dq_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows inside and outside an expected value range (bounds inclusive)."""
    inside = F.col(col).between(F.lit(lo), F.lit(hi))
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(inside).alias("inside"),
        F.count_if(~inside).alias("outside"),
        F.count_if(F.col(col).isNull()).alias("missing"),
    ).select(F.lit(col).alias("column_name"), "row_count", "inside", "outside", "missing")


def primary_key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, duplicate_keys): for every table the number of key values that occur twice or more."""
    parts = []
    for table, columns in keys.items():
        repeated = tables[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        parts.append(repeated.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(F.lit(table).alias("table_name"), "duplicate_keys"))
    return reduce(DataFrame.unionByName, parts)
