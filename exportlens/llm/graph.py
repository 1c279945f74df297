"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exportlens.llm.common import cut


EDGES_OF_A_TASK = 100_000  # of 16 bytes each


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Large-star links each node's larger neighbours to its smallest neighbour, small-star its smaller
    ones; both keep connectivity, and what remains at the fixed point are stars around the smallest
    node. Every step is a minimum per key, combined on the map side, and a join that adaptive
    execution can split at a hot key. Its input is spread over one task per ``EDGES_OF_A_TASK`` edges,
    so a small graph enters the shuffles from few tasks and a large one from all. No edge reaches the
    driver: a step returns one count and one checksum. Nulls and self-loops are ignored; repeated
    edges count once; no edges give no rows.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = cut(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(high.alias("u"), low.alias("v")).distinct())
    seen = _state(now)
    fit = lambda df: df.coalesce(1 + seen[0] // EDGES_OF_A_TASK)
    while seen[0]:
        both = _each(fit(now), ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        now = cut(_each(large.join(root, "u"), ("v", "m"), ("u", "m")).where("u <> v").distinct())
        state = _state(now)
        if state == seen:
            break
        seen = state
    return _each(fit(now), ("u", "v"), ("v", "v")).select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()


def _each(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) for every row and each of the pairs of its columns."""
    return df.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum of them."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
