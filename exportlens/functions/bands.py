"""Labels from thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(cases: Sequence[tuple[Column, str]], else_: str | None) -> Column:
    """Searched CASE: the first predicate that holds wins; NULL predicates fall through."""
    out = F
    for pred, label in cases:
        out = out.when(pred, F.lit(label))
    return out.otherwise(F.lit(else_))


def bin_right(x: Column | str, edges: Sequence, labels: Sequence[str]) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ...; values outside every bin give NULL.

    ``Bucketizer`` closes bins on the left, which would put a value on an edge one bin too high.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    x = F.col(x) if isinstance(x, str) else x
    cases = [
        ((x > F.lit(lo)) & (x <= F.lit(hi)), label)
        for lo, hi, label in zip(edges, edges[1:], labels)
    ]
    return band(cases, None)


def tag_contains(x: Column | str, text: str) -> Column:
    """Substring predicate that is false, not NULL, for a NULL tag."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(x.contains(text), F.lit(False))
