"""Quality classifier: a factorisation machine over hashed words and structure statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exportlens.llm.common import bytes_column, cut, free_columns, free_name, small_batches, window_hashes, word_cache, word_hashes

BUCKETS = 1 << 13  # hashed words
FACTORS = 8
MOST_ROWS = 6000  # labelled documents that a model is fitted on
MOST_INPUTS = 4_000_000  # distinct words of these documents together, 8 bytes each
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
STATS = ["log_words", "word_length", "capitals", "digits", "symbols", "bangs", "bars", "stops", "distinct", "repeated", "top_word",
         "repeated_lines", "line_length", "capital_words"]


def features(text: bytes, cache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the distinct words, their weights (of length 1 together) and the structure statistics.

    Metadata enters as measured on the text itself: its length and layout. Labels, language, source
    and ids do not.
    """
    words = text.split()
    n = len(words)
    if not n:
        return np.empty(0, np.int32), np.empty(0, np.float32), np.zeros(len(STATS), np.float32)
    hashes = word_hashes(words, cache)
    buckets, counts = np.unique((hashes >> np.uint64(51)).astype(np.int32), return_counts=True)
    weights = np.sqrt(counts / n)
    weights = weights / math.sqrt(weights @ weights)
    chars = len(text.translate(None, CONTINUATION + SPACES))
    count = lambda letters: len(text) - len(text.translate(None, letters))
    pairs = window_hashes(hashes, 3)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    stats = [
        math.log1p(n), chars / n, count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, count(b"0123456789") / chars,
        count(b"#*$%&<>@^~=+") / n, text.count(b"!") / n, text.count(b"|") / n, count(b".,;:") / n,
        len(buckets) / n, 1 - len(np.unique(pairs)) / len(pairs), counts.max() / n,
        1 - len(set(lines)) / len(lines), math.log1p(chars / len(lines)), sum(map(bytes.isupper, words)) / n,
    ]
    return buckets, weights.astype(np.float32), np.array(stats, np.float32)


def _dense(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / spread, -4, 4)


@dataclass
class Model:
    """Weights of a factorisation machine; the last inputs are the statistics."""

    bias: float
    linear: np.ndarray  # BUCKETS + statistics
    factors: np.ndarray  # the same x FACTORS
    mean: np.ndarray
    spread: np.ndarray

    def inputs(self, buckets, weights, stats):
        own = _dense(stats, self.mean, self.spread)
        return np.concatenate([buckets, BUCKETS + np.arange(len(own))]), np.concatenate([weights, own])

    def score(self, buckets, weights, stats) -> float:
        """Chance of label 1. The pairwise part takes linear time: half of (sum of v x)^2 - sum of (v x)^2."""
        at, x = self.inputs(buckets, weights, stats)
        vx = self.factors[at] * x[:, None]
        sums = vx.sum(axis=0)
        z = self.bias + self.linear[at] @ x + 0.5 * (sums @ sums - (vx * vx).sum())
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(z))))))


def fit(rows: list[tuple], epochs: int = 12, step: float = 0.05, decay: float = 1e-4, seed: int = 5) -> Model:
    """A model for (buckets, weights, stats, label) rows, by AdaGrad on the logistic loss. Same rows, same model.

    Without rows the model scores everything 0.5; with one label it learns the bias towards it.
    """
    size = BUCKETS + len(STATS)
    rng = np.random.Generator(np.random.PCG64(seed))
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.01, (size, FACTORS)), np.zeros(len(STATS)), np.ones(len(STATS)))
    if not rows:
        return Model(0.0, model.linear, model.factors * 0, model.mean, model.spread)
    stats = np.stack([r[2] for r in rows])
    model.mean, model.spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    inputs = [model.inputs(*r[:3]) for r in rows]
    labels = np.array([float(r[3]) for r in rows])
    rate = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    model.bias = math.log(rate / (1 - rate))
    bias_sum, linear_sum, factor_sum = 1e-8, np.full(size, 1e-8), np.full((size, FACTORS), 1e-8)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = inputs[i]
            v = model.factors[at]
            vx = v * x[:, None]
            sums = vx.sum(axis=0)
            z = model.bias + model.linear[at] @ x + 0.5 * (sums @ sums - (vx * vx).sum())
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - labels[i]
            g = error * x + decay * model.linear[at]
            linear_sum[at] += g * g
            model.linear[at] -= step * g / np.sqrt(linear_sum[at])
            g = error * (x[:, None] * sums - vx * x[:, None]) + decay * v
            factor_sum[at] += g * g
            model.factors[at] -= step * g / np.sqrt(factor_sum[at])
            bias_sum += error * error
            model.bias -= step * error / math.sqrt(bias_sum)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_ROWS, held_out: int = 5) -> Model:
    """A model learnt from labelled documents outside the held-out fifth (crc32 of the id's text divisible by 5).

    The ``most`` documents with the smallest id hashes are fitted, as far as their distinct words number no more than
    ``MOST_INPUTS``; these bounds keep the sample below about 50 MB on the driver, whatever the texts' length and however often
    an id is repeated, and are the only part that doesn't use all data. Null labels and ids are left out. An id with several labels has the
    largest one, an id with several texts that of the smallest hash.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % held_out != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches):
        cache = word_cache()
        for batch in batches:
            parts = [features(t or b"", cache) for t in bytes_column(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *(
                pa.array([p[k] for p in parts], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.float32(), pa.float32())))],
                names=["doc_id", "label", "at", "x", "stats"])

    # The sample has a proven bound of ``most`` ids.
    joined = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    joined = joined.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")))["text"].alias("text"))
    inputs = cut(small_batches(joined).mapInArrow(run, "doc_id long, label int, at array<int>, x array<float>, stats array<float>"))
    # One row per sampled document, so the running sum is over ``most`` rows.
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    table = inputs.withColumn("upto", F.sum(F.size("at")).over(upto)).where(F.col("upto") <= MOST_INPUTS).orderBy("doc_id").toArrow()
    lists = lambda name: [np.asarray(x.values) for x in table.column(name).combine_chunks()] if table.num_rows else []
    return fit(list(zip(lists("at"), lists("x"), lists("stats"), table.column("label").to_pylist())))


def with_score(docs: DataFrame, model: Model, name: str = "score", least: float | None = None) -> DataFrame:
    """``docs`` with the column ``name``: the chance of label 1, from 0 to 1; with ``least`` only rows that reach it.

    A null text scores as an empty one, by its statistics of 0. Every whole text is read, of any length; rows are not
    moved, repeated rows are scored each, and no rows give no rows. An existing column of that name is replaced.
    """
    stay = free_columns(docs, [name])
    docs = docs.select(*[docs[c] for c in stay], docs["text"].alias(free_name(docs, "_text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        cache, own = word_cache(), shared.value
        for batch in batches:
            scores = pa.array([own.score(*features(t or b"", cache)) for t in bytes_column(batch.column(len(stay)))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(stay)], scores], names=[*stay, name])

    scored = small_batches(docs).mapInArrow(run, T.StructType([*docs.schema.fields[: len(stay)], T.StructField(name, T.DoubleType())]))
    return scored if least is None else scored.where(F.col(name) >= least)
