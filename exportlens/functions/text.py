"""String and date helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column | str, width: int) -> Column:
    """Zero-padded identifier, e.g. ``P007``; longer numbers keep all their digits."""
    number = F.col(number) if isinstance(number, str) else number
    return F.format_string(f"{prefix}%0{width}d", number)


def short_text(x: Column | str, n: int) -> Column:
    """First ``n`` characters, for report labels."""
    return F.substring(x, 1, n)


def days_since(day: Column | str, as_of: dt.date | str) -> Column:
    """Whole days from ``day`` to an explicit as-of date (never the wall clock)."""
    return F.datediff(F.lit(as_of).cast("date"), day)


def ordered_join(value: Column | str, order: Column | str, sep: str = ", ") -> Column:
    """Aggregate: join the group's strings in ``order``.

    The group is held as one array, so use it on groups already cut to a fixed size (top k).
    """
    value = F.col(value) if isinstance(value, str) else value
    order = F.col(order) if isinstance(order, str) else order
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)
