"""Quality rules with thresholds taken from mergeable quantile sketches per language and source."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from exportlens.llm.common import bytes_column, cut, window_hashes, word_cache, word_hashes

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
WINDOW = 8
FEW_WORDS = 20

# Metric: (expression, whether it has a lower threshold, whether it has an upper one). All of them vary among ordinary
# documents, so that their quartiles lie apart.
METRICS = {
    "punctuation_share": ("n_punctuation / greatest(word_chars, 1)", False, True),
    "capital_share": ("n_capitals / greatest(word_chars, 1)", False, True),
    "word_length": ("word_chars / greatest(n_words, 1)", True, True),
    "word_variety": ("CASE WHEN n_words > 1 THEN ln(greatest(n_distinct, 1)) / ln(n_words) ELSE 1 END", True, False),
}
FENCE = 5.0  # quartile distances from a quartile to its threshold
ACCURACY = 0.001  # relative accuracy of the sketch
LEAST_VALUE = 1e-4  # smaller values count as 0
PRIOR = 10  # documents that a group's language counts for beside its own ones, and all documents beside a language's
LOWEST = -(1 << 20)  # bucket of the values that count as 0


def _counts(text: bytes, cache) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_punctuation, n_capitals, n_distinct."""
    words = text.split()
    chars = len(text.translate(None, CONTINUATION + SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if len(words) > WINDOW:
        windows = window_hashes(word_hashes(words, cache), WINDOW)
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            twice = np.zeros(len(windows), dtype=bool)
            twice[order[1:]] = same
            twice[order[:-1]] |= same
            cover = np.zeros(len(words) + 1, dtype=np.int64)
            at = np.flatnonzero(twice)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            repeated = int((np.cumsum(cover[:-1]) > 0).sum())
    capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    punctuation = len(text) - len(text.translate(None, PUNCTUATION))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, punctuation, capitals, len(set(words))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_punctuation", "n_capitals", "n_distinct"]


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts…, base_failed) for every row of ``docs``; a null text has no words."""
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches):
        cache = word_cache()
        for batch in batches:
            rows = [_counts(t or b"", cache) for t in bytes_column(batch.column("text"))]
            columns = list(zip(*rows)) or [()] * len(COUNTS)
            keep = [batch.column(c) for c in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays([*keep, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "lang", "source", *COUNTS])

    docs = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.col("source").cast("string"))
    return docs.mapInArrow(run, schema).withColumn("base_failed", F.expr(
        f"n_words < {FEW_WORDS} OR 100 * n_repeat_words > 30 * n_words"))


def sketch(values: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, metric, bucket, n): a quantile sketch with logarithmic buckets of bounded relative error.

    Two sketches merge by adding the counts of equal buckets, so partial sketches combine on the map
    side and the result depends on no order. ``values`` has the keys, metric and value.
    """
    step = math.log((1 + ACCURACY) / (1 - ACCURACY))
    bucket = F.when(F.col("value") <= LEAST_VALUE, F.lit(LOWEST)).otherwise(F.ceil(F.log("value") / step)).cast("int")
    return values.groupBy(*keys, "metric", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    """(keys…, metric, total, one column per point): a value within the accuracy of each quantile."""
    step = math.log((1 + ACCURACY) / (1 - ACCURACY))
    value = F.when(F.col("bucket") == LOWEST, 0.0).otherwise(2 * F.exp(F.col("bucket") * step) / (math.exp(step) + 1))
    group = Window.partitionBy(*keys, "metric")
    run = sketches.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "total": F.sum("n").over(group), "value": value})
    return run.groupBy(*keys, "metric").agg(F.max("total").alias("total"), *[
        F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("value"))).alias(name) for name, q in points.items()])


def blended(own: DataFrame, keys: list[str], of: DataFrame, of_keys: list[str]) -> DataFrame:
    """(keys…, metric, total, q1, q3): quartiles of groups, mixed with those of the coarser group that each belongs to.

    A group's sketch and the coarser one's are merged quantile by quantile, with the weights of their documents and of ``PRIOR``
    documents. So a group counts the more the larger it is, without a jump.
    """
    named = of.select(*[F.col(c).alias(f"_{c}") for c in [*of_keys, "metric", "q1", "q3"]])
    same = F.col("metric") == F.col("_metric")
    for c in of_keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    mean = lambda c: ((F.col(c) * F.col("total") + F.col(f"_{c}") * PRIOR) / (F.col("total") + PRIOR)).alias(c)
    return own.join(named, same).select(*keys, "metric", "total", mean("q1"), mean("q3"))


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, low, high) for every language and source of documents that pass the base rules.

    All come from the quartiles of sketches: a threshold lies ``FENCE`` quartile distances outside its quartile. A group's
    quartiles are mixed with those of its language, and a language's with those of all documents (:func:`blended`). A metric
    that does not vary, its quartiles being equal, tells nothing there and has no threshold.
    """
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(e).cast("double").alias("value")) for m, (e, _, _) in METRICS.items()])
    values = measured.select("lang", "source", "base_failed", F.explode(metrics).alias("m")).where("NOT base_failed").select("lang", "source", "m.*")
    groups = cut(sketch(values, ["lang", "source"]))
    quartiles = lambda keys: quantiles(merge(groups, keys), keys, {"q1": 0.25, "q3": 0.75})
    by_lang = blended(quartiles(["lang"]), ["lang"], quartiles([]), [])
    df = blended(quartiles(["lang", "source"]), ["lang", "source"], by_lang, ["lang"]).withColumn("spread", F.col("q3") - F.col("q1"))
    named = lambda which: [m for m, sides in METRICS.items() if sides[which]]
    varies = F.col("spread") > 0
    return df.select("lang", "source", "metric",
                     F.when(varies & F.col("metric").isin(named(1)), F.col("q1") - FENCE * F.col("spread")).alias("low"),
                     F.when(varies & F.col("metric").isin(named(2)), F.col("q3") + FENCE * F.col("spread")).alias("high"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules) per row of ``docs``.

    ``docs`` has doc_id, text, lang and source. A document is kept when it passes the base rules and
    every metric lies within its group's thresholds; failed_rules lists the others. Nulls in lang or
    source form groups of their own. Null and empty texts have no words and fail the base rules, as
    do all documents of under 20 words. Ties: a value equal to a threshold passes. Repeated rows are
    judged each; a table without passing documents has no thresholds and needs none. Texts are read
    once and not shuffled; documents meet the small table of thresholds by language and source.
    """
    measured = cut(measures(docs))
    table = thresholds(measured).groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct(
        "metric", F.struct("low", "high")))).alias("limits"))
    table = table.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    df = measured.join(table, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    rules = []
    for metric, (expression, _, _) in METRICS.items():
        limit, value = F.col("limits")[metric], F.expr(expression)
        outside = F.coalesce(value > limit["high"], F.lit(False)) | F.coalesce(value < limit["low"], F.lit(False))
        rules.append(F.when(outside, F.lit(metric)))
    failed = F.array_compact(F.array(*rules))
    return df.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
                     F.array_join(failed, ",").alias("failed_rules"))
