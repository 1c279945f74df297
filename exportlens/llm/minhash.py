"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exportlens.llm.common import bytes_column, cut, list_column, mix, small_batches, window_hashes, word_cache, word_hashes
from exportlens.llm.graph import components

BINS = 21  # log2 of the number of dimensions that are permuted
LEADS = 2  # members of a bucket that all others are compared with, before the rest is settled by prefixes
FEW_IDS = 1_000_000  # ids, of 8 bytes, that are broadcast to pick out texts; more meet them by a shuffle

_tables: dict[int, np.ndarray] = {}


def shingles(text: bytes | None, size: int, cache) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z lower-cased; fewer words make one."""
    return np.unique(window_hashes(word_hashes((text or b"").lower().split(), cache), size))


def _windows(length: int) -> np.ndarray:
    """Row i: the second permutation from place i on, ``length`` values, wrapping around."""
    if length not in _tables:
        order = np.argsort(mix(np.arange(1 << BINS, dtype=np.uint64) + np.uint64(1)), kind="stable").astype(np.int32)
        _tables[length] = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: length - 1]]), length)
    return _tables[length]


def signature(hashes: np.ndarray, length: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of pi(sigma(x) + k) over the set.

    sigma permutes the bins by an affine rule; pi is one fixed permutation that is shifted by one
    place per coordinate, so all coordinates of an element are one contiguous slice of it.
    """
    windows = _windows(length)
    places = (hashes >> np.uint64(64 - BINS)) * np.uint64(0x2545F491) + np.uint64(12345) & np.uint64((1 << BINS) - 1)
    out = np.full(length, 1 << BINS, dtype=np.int32)
    for k in range(0, len(places), 4096):
        np.minimum(out, windows[places[k : k + 4096]].min(axis=0), out=out)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of ``rows`` coordinates; the band's number is part of it."""
    out = mix(np.arange(bands, dtype=np.uint64) + np.uint64(7))
    for column in sig.reshape(bands, rows).T.astype(np.uint64):
        out = mix(out ^ column) * np.uint64(0x9E3779B97F4A7C15)
    return mix(out).view(np.int64)


def _sketch(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    def run(batches):
        cache = word_cache()
        for batch in batches:
            sizes, prints, lists = [], [], []
            for text in bytes_column(batch.column("text")):
                own = shingles(text, words, cache)
                sizes.append(len(own))
                prints.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                lists.append(band_hashes(signature(own, bands * rows), bands, rows) if len(own) else own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), list_column(lists, pa.int64())],
                names=["doc_id", "n", "print", "bands"])

    return small_batches(docs).mapInArrow(run, "doc_id long, n long, print binary, bands array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, items): full shingle sets of the documents whose ids are in ``nodes``."""
    def run(batches):
        cache = word_cache()
        for batch in batches:
            sets = [shingles(t, words, cache).view(np.int64) for t in bytes_column(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_column(sets, pa.int64())], names=["node", "items"])

    ids = cut(nodes.select(F.col("node").alias("doc_id")).distinct())
    wanted = docs.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "doc_id", "left_semi")
    return small_batches(wanted).mapInArrow(run, "node long, items array<long>").where(F.size("items") > 0)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    side = lambda k: sets.select(F.col("node").alias(k), F.col("items").alias(f"s{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return cut(both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b").distinct())


def _similar_size(n: str, m: str, percent: int):
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _prefix_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair of different components that can reach the similarity, for members of open buckets.

    Two sets that do share one of their n - ceil(t n) + 1 first shingles in any common order; the
    order by rarity makes passages that many documents share come last. The first common one, at
    places i and j, leaves an overlap of min(n - i, m - j) at most; a pair is formed only where that
    can suffice, so texts around one passage or template are not. Nor are pairs inside a shingle's
    most frequent component.
    """
    nodes = cut(rows.select("node", "n", "label").distinct())
    items = sets.join(nodes.select("node"), "node", "left_semi").select("node", F.explode("items").alias("item")).distinct()
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    ranked = items.join(counts, "item").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("own"))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = cut(ranked.join(nodes, "node").select(
        "node", "n", "label", F.posexplode(F.slice("own", F.lit(1), length.cast("int"))["item"]).alias("at", "item")))
    sizes = prefix.groupBy("item", "label").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("item").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    left = prefix.join(main, "item").where("label <> main").select(
        "item", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("label").alias("xl"), F.col("at").alias("xat"))
    most = F.least(F.col("n") - F.col("at"), F.col("xn") - F.col("xat"))
    same = (F.col("xl") != F.col("label")) & ((100 + percent) * most >= percent * (F.col("n") + F.col("xn")))
    pairs = left.join(prefix.withColumnRenamed("item", "i"), (F.col("item") == F.col("i")) & same)
    return pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 28, rows: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked when 100 * intersection >= percent * union of their shingle sets; the
    component is the smallest doc_id reachable, kept marks it. Candidates share a band of the
    signature: with 28 bands of 5 a pair at exactly 0.8 is missed with a chance of 2e-5, one at 0.85
    of 1e-7. Equal sets are one class and enter once. A bucket is never expanded into all pairs: each member is first compared
    with the most central lead it meets (most copies, then most neighbours), then, while a bucket
    holds different components, with up to ``LEADS`` leads of it. What remains is settled by an exact
    prefix filter between components. So every pair of a bucket is confirmed, refused, or joined.

    Null or empty texts, and texts without words, have no set: component of their own id. Rows that
    share a doc_id are one document with all their links; a row without doc_id takes the component of
    its equal texts and is not kept. No rows give no rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketch = cut(_sketch(docs, words, bands, rows))
    classes = cut(sketch.where("print IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    reps = sketch.join(classes.where("node IS NOT NULL"), "print").where("doc_id = node")
    entries = reps.select("node", "n", "copies", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("low"), F.max("node").alias("top"))
    members = cut(entries.join(shared.where("low <> top").drop("low", "top"), "bucket"))
    sets = cut(_sets(docs, members.select("node"), words))
    # The centre of a family is what most members are near to, though they may not be near each other.
    centre = members.groupBy("node").agg(F.max("copies").alias("c"), F.sum("members").alias("m"))
    members = cut(members.select("bucket", "node", "n").join(centre.select("node", F.struct("c", "m", (-F.col("node")).alias("id")).alias("w")), "node"))

    leads = members.groupBy("bucket").agg(F.max(F.struct("w", "node", "n")).alias("lead"))
    best = members.join(leads, "bucket").groupBy("node", "n").agg(F.max("lead").alias("lead"))
    fits = lambda df: df.where((F.col("lead.node") != F.col("node")) & _similar_size("lead.n", "n", percent)).select(
        F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
    links = _linked(fits(best), sets, percent)

    open_, used = members, None
    for step in range(LEADS + 1):
        labels = components(links)
        open_ = open_.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        mixed = open_.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("bucket")
        open_ = cut(open_.join(mixed, "bucket"))
        if open_.isEmpty():
            break
        if step < LEADS:
            fresh = open_ if used is None else open_.join(used, ["bucket", "node"], "left_anti")
            leads = cut(fresh.groupBy("bucket").agg(F.max(F.struct("w", "node", "n", "label")).alias("lead")))
            used = leads.select("bucket", "lead.node") if used is None else used.unionByName(leads.select("bucket", "lead.node"))
            found = fits(open_.join(leads, "bucket").where("label <> lead.label"))
        else:
            found = _prefix_pairs(open_, sets, percent)
        links = links.unionByName(_linked(found, sets, percent))  # both sides are cut

    label = classes.join(components(links), "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    out = sketch.select("doc_id", "n", "print").join(label, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
