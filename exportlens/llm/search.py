"""Ranked lexical search over an index of documents grouped by equal length normaliser."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exportlens.llm.common import bytes_column, list_column, stored

LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
# Bytes of terms: digits, letters (A-Z lower-cased) and all of non-ASCII characters; the rest separates.
TERM_BYTES = bytes(c if c in LETTERS or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
ITEM_TERMS = 500_000  # terms of the items that are searched for at once; more make more blocks of items
STRATUM_DOCS = 512  # documents of one normaliser that share a bound; a larger stratum has several
SEGMENT = 8_000_000  # postings that a task holds at once


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text, in order."""
    return (text or b"").translate(TERM_BYTES).split()


@dataclass
class Index:
    """Statistics of all documents, weights of the terms, and the written strata.

    ``strata`` has a row per document that holds a term of the vocabulary: doc_id, m, terms (numbers in the vocabulary)
    and tfs. It is written in ranges of (m, doc_id), so a file holds successive strata and a large stratum spans files.
    """

    vocabulary: dict[bytes, int]
    documents: int
    length: int
    weights: np.ndarray
    strata: DataFrame


def build_index(docs: DataFrame, vocabulary: list[bytes]) -> Index:
    """Index of every row of ``docs`` (doc_id, text) by the terms of ``vocabulary``, which has to be of bounded size.

    Texts are read once: a task counts the terms of each text, and what is carried on are numbers. Documents, their
    terms, and the documents of each term are counted over all rows. The normaliser of a document of n terms is
    m = 75 + (25 n N) div L. Null and term-less texts are no documents. Repeated rows count each.
    """
    number = {term: k for k, term in enumerate(sorted(vocabulary))}
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def count(batches):
        get = shared.value.get
        for batch in batches:
            ids, lengths, found, times = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), bytes_column(batch.column(1))):
                words = terms(text)
                if not words:
                    continue
                bag = Counter(map(get, words))
                bag.pop(None, None)
                ids.append(doc_id)
                lengths.append(len(words))
                found.append(np.fromiter(bag.keys(), dtype=np.int32, count=len(bag)))
                times.append(np.fromiter(bag.values(), dtype=np.int32, count=len(bag)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), list_column(found, pa.int32()), list_column(times, pa.int32())],
                                             names=["doc_id", "n", "terms", "tfs"])

    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")
    counted = stored(counted)
    total = counted.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    weights = np.zeros(len(number), dtype=np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the vocabulary
        weights[term] = math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * df + 1)))
    m = F.expr(f"75 + (25 * n * {total['documents']}L) div {max(total['length'], 1)}L")
    strata = counted.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    strata = stored(strata.repartitionByRange("m", "doc_id").sortWithinPartitions("m", "doc_id"))
    return Index(number, total["documents"], total["length"], weights, strata)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    sizes = ends - starts
    if not len(sizes) or not sizes.sum():
        return np.empty(0, dtype=np.int64)
    out = np.ones(sizes.sum(), dtype=np.int64)
    keep = sizes > 0
    starts, ends, sizes = starts[keep], ends[keep], sizes[keep]
    out[0] = starts[0]
    out[np.cumsum(sizes)[:-1]] = starts[1:] - ends[:-1] + 1
    return np.cumsum(out)


class Strata:
    """Documents of a task, sorted by m, as postings by term, stratum and tf.

    A stratum is up to ``STRATUM_DOCS`` documents of one m. A posting's impact depends on m and tf
    alone and is computed once for each pair of them.
    """

    def __init__(self, m: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray):
        first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        since = np.arange(len(m)) - np.repeat(first, np.diff(np.r_[first, len(m)]))
        self.stratum = np.cumsum(since % STRATUM_DOCS == 0) - 1  # of each document
        self.count = int(self.stratum[-1]) + 1 if len(m) else 0
        doc = np.repeat(np.arange(len(m)), sizes)
        wide = int(tf.max(initial=0)) + 1
        pairs, which = np.unique(m[doc] * wide + tf, return_inverse=True)
        impact = 1_000_000_000 * (pairs % wide) // (1000 * (pairs % wide) + 12 * (pairs // wide))
        order = np.lexsort((-tf, self.stratum[doc], term))
        self.doc, self.impact = doc[order], impact[which][order]
        term, stratum = term[order], self.stratum[self.doc]
        # A run of postings of one term in one stratum begins with its largest tf, hence its largest impact.
        new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])]) if len(term) else np.empty(0, dtype=np.int64)
        self.start, self.end = new, np.r_[new[1:], len(term)].astype(np.int64)[: len(new)]
        self.run_stratum, self.most = stratum[new], self.impact[new]
        self.run_term = term[new]
        self.scores = np.zeros(len(m), dtype=np.int64)

    def best(self, query: np.ndarray, weight: np.ndarray, k: int, floor: int):
        """Documents with scores that can be among the ``k`` best, given that ``k`` others reach ``floor``.

        ``query`` are sorted term numbers, ``weight`` their weights times their repeats. Strata are visited
        by falling bound, the sum of each term's weight and largest impact there, a few first and then ever
        more; those whose bound is below the k-th score found so far hold no result.
        """
        a, b = np.searchsorted(self.run_term, query), np.searchsorted(self.run_term, query, side="right")
        runs, weight = _ranges(a, b), np.repeat(weight, b - a)
        bound = np.zeros(self.count, dtype=np.int64)
        stratum = self.run_stratum[runs]
        np.add.at(bound, stratum, weight * self.most[runs])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] >= max(floor, 1)]
        found, at, step = [], 0, 4
        while at < len(order):
            visit = np.zeros(self.count, dtype=bool)
            visit[order[at : at + step]] = True
            chosen = visit[stratum]
            starts, ends = self.start[runs[chosen]], self.end[runs[chosen]]
            postings = _ranges(starts, ends)
            docs = self.doc[postings]
            np.add.at(self.scores, docs, np.repeat(weight[chosen], ends - starts) * self.impact[postings])
            docs = np.unique(docs)
            scores = self.scores[docs]
            self.scores[docs] = 0
            keep = scores >= max(floor, 1)
            found += zip(scores[keep].tolist(), docs[keep].tolist())
            if len(found) >= k:
                floor = max(floor, heapq.nlargest(k, (s for s, _ in found))[-1])
                found = [x for x in found if x[0] >= floor]
            at += step
            step *= 2
            rest = order[at:]
            order = np.r_[order[:at], rest[bound[rest] >= floor]]
        return found


def search(index: Index, items: list[tuple[int, list[tuple[int, int]]]], spark, k: int = 20) -> DataFrame:
    """(query, doc_id, score, rank): the ``k`` best documents of each query with a score above 0.

    ``items`` are (query, [(term number, repeats)]), a bounded number of them. A task visits the strata of its
    part of the index and returns ``k`` documents a query at most; equal scores go by doc_id, nulls first.
    """
    ready = []
    for query, bag in items:
        bag = sorted((t, n) for t, n in bag if index.weights[t] > 0)
        if bag:
            number = np.array([t for t, _ in bag], dtype=np.int64)
            ready.append((query, number, np.array([n for _, n in bag], dtype=np.int64) * index.weights[number]))
    shared = spark.sparkContext.broadcast(ready)

    def visit(batches):
        queries = shared.value
        best: list[list[tuple]] = [[] for _ in queries]  # of each query: (score, key of doc_id, doc_id)

        def flush():
            column = lambda name: pa.chunked_array([b.column(name) for b in held])
            ids, lists, times = column("doc_id").to_pylist(), column("terms"), column("tfs")
            sizes = np.diff(np.r_[0, np.cumsum(np.concatenate([np.diff(c.offsets.to_numpy()) for c in lists.chunks]))])
            flat = lambda c: np.concatenate([x.flatten().to_numpy() for x in c.chunks]).astype(np.int64)
            strata = Strata(column("m").to_numpy(), sizes, flat(lists), flat(times))
            for known, (_, number, weight) in zip(best, queries):
                floor = known[-1][0] if len(known) >= k else 0
                fresh = [(score, (ids[d] is not None, ids[d] or 0), ids[d]) for score, d in strata.best(number, weight, k, floor)]
                known[:] = heapq.nsmallest(k, known + fresh, key=lambda x: (-x[0], x[1]))

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= SEGMENT:
                flush()
                held, size = [], 0
        if held:
            flush()
        rows = [(query, doc_id, score) for (query, _, _), known in zip(queries, best) for score, _, doc_id in known]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], names=["query", "doc_id", "score"])

    hits = index.strata.mapInArrow(visit, "query long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first()))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, text).

    Terms are runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII characters. A document's score sums, over an item's terms
    with their repeats, w * ((1000000000 tf) div (1000 tf + 12 m)); a term's weight is w = floor(1000 ln((2 N + 2) / (2 df + 1))).
    All documents are indexed and every score is exact; bounds only leave out strata that can't hold a result.

    Null and term-less texts are no documents, and items without terms get no rows. Equal scores: ascending doc_id, nulls
    first. Repeated documents are ranked each; a repeated item is one item, and one id with two texts is searched for twice.
    Empty tables give no rows. Other columns are ignored. Texts of any length are taken whole. Items are searched for in blocks of about ``ITEM_TERMS`` terms, so what
    is broadcast is bounded; every block reads the texts once.
    """
    spark = docs.sparkSession

    def bags(batches):
        for batch in batches:
            counted = [Counter(terms(t)) for t in bytes_column(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([list(c) for c in counted], pa.list_(pa.binary())),
                                              pa.array([list(c.values()) for c in counted], pa.list_(pa.int64()))], names=["item_id", "terms", "repeats"])

    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", F.col("text").cast("string")).distinct()
    asked = stored(asked.mapInArrow(bags, f"item_id {kind}, terms array<binary>, repeats array<bigint>").where(F.size("terms") > 0))
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(size / ITEM_TERMS))
    out = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        index = build_index(docs, list({bytes(t) for r in rows for t in r["terms"]}))
        hits = search(index, [(q, [(index.vocabulary[bytes(t)], n) for t, n in zip(r["terms"], r["repeats"])]) for q, r in enumerate(rows)], spark, k)
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"query long, item_id {kind}")
        hits = hits.join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = hits if out is None else out.unionByName(hits)
    return out
