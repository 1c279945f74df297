"""Line dedup by content-defined chunks of lines. DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.llm.common import cut, free_name

WORD = r"[^\x20\x09-\x0D]+"
ROLL = 1_000_003  # multiplier of the rolling hash
ROLL_BITS = (1 << 40) - 1


def _windows(text: Column, least_words: int) -> Column:
    """Windows of a text: long lines, and pairs of successive lines with words; arrays of (i, j, k, long_i, long_j, rolled, digest).

    i and j are the places of a window's first and last line, k is the place of the line with words after j,
    or the number of lines. Every line is hashed once and the hash is rolled over the lines of the window. The digest is the
    SHA-256 of all bytes from line i to line j, blank lines between included.
    """
    lines = F.split(text, "\n")
    long = lambda x: F.when(F.length(x) >= 2 * least_words - 1, F.regexp_count(x, F.lit(WORD)) >= least_words).otherwise(F.lit(False))
    value = lambda x: F.xxhash64(x).bitwiseAND(F.lit(ROLL_BITS))
    full = lambda l: F.filter(F.transform(l, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), F.struct(  # noqa: E731, E741
        i.alias("i"), long(x).alias("long"), value(x).alias("v")))), lambda x: x.isNotNull())
    digest = lambda l, i, j: F.unhex(F.sha2(F.array_join(F.slice(l, i + 1, j - i + 1), "\n"), 256))  # noqa: E731, E741

    # Each step is bound once by a one-element transform, so later uses don't repeat the work.
    def windows(x):
        def window(w, at, last, rolled):
            return F.struct(w["i"].alias("i"), last["i"].alias("j"), F.coalesce(F.get(x["w"], at)["i"], F.size(x["l"])).alias("k"),
                            w["long"].alias("long_i"), last["long"].alias("long_j"), rolled.alias("rolled"), digest(x["l"], w["i"], last["i"]).alias("digest"))

        single = F.transform(x["w"], lambda w, p: F.when(w["long"], window(w, p + 1, w, w["v"])))
        pair = F.transform(x["w"], lambda w, p: F.when(p + 1 < F.size(x["w"]), window(
            w, p + 2, F.get(x["w"], p + 1), w["v"] * ROLL + F.get(x["w"], p + 1)["v"])))
        return F.filter(F.concat(single, pair), lambda u: u.isNotNull())

    one = F.transform(F.array(F.struct(lines.alias("l"))), lambda x: F.struct(x["l"].alias("l"), full(x["l"]).alias("w")))
    return F.transform(one, windows)[0]


def dedup_lines(docs: DataFrame, least_words: int = 50) -> DataFrame:
    """``docs`` with columns n_lines, n_removed_chunks, n_removed_lines and clean_text.

    A hash is rolled over the hashes of the lines with words, two at a time. Where a rolled value occurs elsewhere too, its
    lines belong to a chunk; a chunk ends where the next rolled value occurs nowhere else. So the boundaries
    depend on the lines alone and not on their place or surroundings, and a chunk is the whole common extent of a
    repeated run. A line of ``least_words`` words or more is a chunk by itself, whatever is next to it.

    Windows with equal rolled values are compared by the SHA-256 of all their bytes, so a chance collision removes
    nothing. Of equal windows anywhere the one in the smallest (doc_id, text hash, place) stays whole. A long line goes if an equal one stays
    elsewhere. A shorter line goes if a window it is in stays elsewhere, unless it is in one that stays here for others: so
    a repeated chunk goes over its whole extent, and every repeated window of short lines is left in one place. A line that
    goes takes the blank lines after it along. n_removed_chunks counts the runs of lines that go.

    Null text: null clean_text and counts of 0. Empty text: one empty line, which stays. A null doc_id sorts first. Rows equal in
    doc_id and text share one fate. No rows give no rows. Other columns stay, but one named as an output is replaced. Texts are
    shuffled once, by document, to meet their removed places; of the windows, rolled values are shuffled, and digests only of those that
    occur twice; a hot window is one state per task.
    """
    own = ["n_lines", "n_removed_chunks", "n_removed_lines", "clean_text"]
    stay = [c for c in docs.columns if c.lower() not in own]
    names = {c: free_name(docs, f"_ld_{c}") for c in ("doc", "hash", "gone", "key")}
    slim = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("h"), "text")
    windows = cut(slim.select("doc_id", "h", F.explode(_windows(F.col("text"), least_words)).alias("u")).select("doc_id", "h", "u.*"))
    often = windows.groupBy("rolled").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rolled")
    windows = windows.join(often, "rolled", "left_semi")
    place = F.struct("doc_id", "h", "i")
    first = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").select("digest", "first")
    again = windows.join(first, "digest").withColumn("stays", place.eqNullSafe(F.col("first")))

    # A line of a window as one number: its place and the place up to which it goes.
    code = lambda at, upto: F.shiftleft(F.col(at).cast("long"), 31) + F.col(upto)
    single = F.col("i") == F.col("j")
    ends = F.when(single, F.array(code("i", "k"))).otherwise(F.array_compact(F.array(
        F.when(~F.col("long_i"), code("i", "j")), F.when(~F.col("long_j"), code("j", "k")))))
    marks = again.select("doc_id", "h", "stays", F.explode(ends).alias("line"))
    marks = marks.groupBy("doc_id", "h").agg(F.collect_set(F.when(F.col("stays"), F.col("line"))).alias("here"), F.collect_set(F.when(~F.col("stays"), F.col("line"))).alias("there"))
    gone = marks.select(F.col("doc_id").alias(names["doc"]), F.col("h").alias(names["hash"]), F.array_sort(F.array_except("there", "here")).alias(names["gone"]))

    places = F.col(names["gone"])
    df = docs.withColumn(names["key"], F.xxhash64("text"))
    df = df.join(gone.where(F.size(places) > 0), F.col("doc_id").eqNullSafe(F.col(names["doc"])) & (F.col(names["key"]) == F.col(names["hash"])), "left")
    begin = lambda c: F.shiftright(c, 31).cast("int")
    end = lambda c: c.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    lines = F.split("text", "\n")
    froms = F.concat(F.array(F.lit(0)), F.transform(places, end))
    tos = F.concat(F.transform(places, begin), F.array(F.size(lines)))
    kept = F.transform(F.array(lines), lambda x: F.flatten(F.zip_with(froms, tos, lambda a, b: F.slice(x, a + 1, b - a))))[0]
    removed = F.aggregate(places, F.lit(0), lambda a, c: a + end(c) - begin(c))
    # A run begins at a line that goes where the one before it does not.
    runs = F.aggregate(places, F.struct(F.lit(-1).alias("at"), F.lit(0).alias("n")), lambda a, c: F.struct(
        end(c).alias("at"), (a["n"] + (begin(c) != a["at"]).cast("int")).alias("n")), lambda a: a["n"])
    untouched = places.isNull()
    return df.select(
        *[F.col(c) for c in stay],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(untouched, F.lit(0)).otherwise(runs).cast("long").alias("n_removed_chunks"),
        F.when(untouched, F.lit(0)).otherwise(removed).cast("long").alias("n_removed_lines"),
        F.when(untouched, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("clean_text"),
    )
