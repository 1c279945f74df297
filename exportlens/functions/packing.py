"""Several small numbers in one bigint, for rows that are shuffled.

A shuffled row holds eight bytes for each column however small its values are, and two words for a short text. Columns that
only pass through a shuffle are packed before and taken out again after it; nulls come back as nulls.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

INT = (-(1 << 31), (1 << 31) - 1)
# A timestamp of 64 bits in microseconds is within 106,751,992 days of 1970.
DAY = (-(1 << 27), (1 << 27) - 1)


class Packing:
    """Whole numbers by name, each with its least and largest value, which the types of the columns must ensure."""

    def __init__(self, **ranges: tuple[int, int]):
        self.fields: dict[str, tuple[int, int, int]] = {}
        step = 1
        for name, (least, most) in ranges.items():
            span = most - least + 2  # 0 stands for null
            self.fields[name] = (least, step, span)
            step *= span
        if step >= 1 << 63:
            raise ValueError(f"{', '.join(ranges)} do not fit into a bigint")

    def pack(self, values: Mapping[str, Column]) -> Column:
        """One bigint of all fields, never null."""
        parts = [
            F.coalesce(values[name].cast("long") - F.lit(least - 1), F.lit(0)) * F.lit(step)
            for name, (least, step, _) in self.fields.items()
        ]
        return sum(parts[1:], parts[0])

    def get(self, packed: Column, name: str) -> Column:
        """The field ``name`` as a bigint, or null."""
        least, step, span = self.fields[name]
        return F.nullif(F.call_function("div", packed, F.lit(step)) % F.lit(span), F.lit(0)) + F.lit(least - 1)
