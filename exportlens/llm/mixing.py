"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exportlens.llm.common import Cache, bytes_column, cut, free_columns, free_name, small_batches, stored
from exportlens.operators.series import with_running_total

TOPICS = 8
TOPIC_WORD = 5  # bytes from which a word counts for the topic
MARGINS = ["source", "lang", "topic"]
FEW_CELLS = 100_000  # cells, of some 60 bytes, up to which the driver rakes them in memory
CELLS_OF_A_TASK = 100_000
RARE = 0.01  # part of a margin's target whose values, the rarest ones, don't limit the rate
MISS = 1e-3  # part of a margin's target that chances of 1 in single cells may leave unreached


def with_topic(docs: DataFrame, names: tuple[str, str], keep_text: bool = True) -> DataFrame:
    """``docs`` with a text's topic and its number of words in two more columns; without the text itself if that isn't kept.

    The topic is the vocabulary class, of ``TOPICS``, that most of a text's longer words fall into by
    their CRC-32, the lowest of equals; a text without such words has the class of its first word,
    one without words 0. Tokens are words.
    """
    stay = [c for c in docs.columns if keep_text or c.lower() != "text"]
    fields = [T.StructField(names[0], T.IntegerType()), T.StructField(names[1], T.LongType())]

    def run(batches):
        cache = Cache(lambda w: zlib.crc32(w) % TOPICS if len(w) >= TOPIC_WORD else TOPICS)
        for batch in batches:
            topics, tokens = [], []
            for text in bytes_column(batch.column(len(stay))):
                words = (text or b"").split()
                counts = np.bincount(np.fromiter(map(cache.__getitem__, words), np.int64, len(words)), minlength=TOPICS)[:TOPICS]
                topics.append(int(counts.argmax()) if counts.any() else zlib.crc32(words[0]) % TOPICS if words else 0)
                tokens.append(len(words))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(stay)], pa.array(topics, pa.int32()), pa.array(tokens, pa.int64())], names=[*stay, *names])

    taken = docs.select(*[docs[c] for c in stay], docs["text"].cast("string").alias(free_name(docs, "_text")))
    return small_batches(taken).mapInArrow(run, T.StructType([docs.schema[c] for c in stay] + fields))


def _fitted(cells: DataFrame) -> DataFrame:
    """``cells`` in one task per ``CELLS_OF_A_TASK``; the sums and joins of a table that fits one task need no shuffle."""
    return cells.coalesce(1 + cells.count() // CELLS_OF_A_TASK)


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, target): shares in proportion to the margin's tokens to the given power."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    total = sums.agg(F.sum(F.pow("t", F.lit(power)))).first()[0]
    return sums.select(margin, (F.pow("t", F.lit(power)) / total).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-3, sweeps: int = 40, most: float | None = None) -> DataFrame:
    """(margins…, tokens, weight) with weights whose sums by every margin agree with its targets.

    Each sweep scales the weights to one margin after the other, which converges to the weights
    closest to the tokens in relative entropy. A sweep is one job over the cells, which are far fewer than the
    documents; only its largest relative deviation comes to the driver. Targets that no weights can
    reach together, as empty cells may make them, stop when the deviation no longer falls: the margin
    raked last is then exact, the others are as near as they get. Cells of a margin's value without a
    target, or with a target of 0, get no weight. ``most``, if given, is the largest weight of a token: a
    cell that would get more is held there, and a sweep scales the others to what is left of the target.
    """
    names = list(targets)
    cells = cut(cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double")))
    count = cells.count()
    if count <= FEW_CELLS:
        return _rake_few(cells, targets, tolerance, sweeps, most)
    cells = cells.coalesce(1 + count // CELLS_OF_A_TASK)
    last = float("inf")
    table = {m: cut(targets[m].where("target > 0").select(F.col(m).alias("_m"), "target")) for m in names}
    for _ in range(sweeps):
        off = F.lit(0.0)
        for m in names:
            limit = F.lit(float("inf")) if most is None else F.col("tokens") * most
            held = F.col("weight") >= limit * (1 - 1e-12)
            sums = cells.groupBy(F.col(m).alias("_k")).agg(F.sum("weight").alias("_s"), F.sum(F.when(held, F.col("weight")).otherwise(0.0)).alias("_c"))
            scale = sums.join(table[m], F.col("_k").eqNullSafe(F.col("_m"))).select("_k", (F.col("target") / F.col("_s")).alias("_f"), F.when(
                (F.col("target") > F.col("_s")) & (F.col("_s") > F.col("_c")), (F.col("target") - F.col("_c")) / (F.col("_s") - F.col("_c"))).otherwise(F.col("target") / F.col("_s")).alias("_g"))
            cells = cells.join(scale, F.col(m).eqNullSafe(F.col("_k"))).withColumn("weight", F.least(F.col("weight") * F.col("_g"), limit)).withColumn(
                f"_off_{m}", F.abs(F.col("_f") - 1)).drop("_k", "_f", "_g")
            off = F.greatest(off, F.col(f"_off_{m}"))
        cells = cut(cells.withColumn("_off", off).drop(*[f"_off_{m}" for m in names]))
        worst = cells.agg(F.max("_off")).first()[0]
        cells = cells.drop("_off")
        if worst is None or worst <= tolerance or worst > 0.99 * last:
            break
        last = worst
    return cells


def _rake_few(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float, sweeps: int, most: float | None = None) -> DataFrame:
    """The same for cells that are known to be few."""
    table = cells.toPandas()
    weight, margins = table["weight"].to_numpy().copy(), []
    for m, df in targets.items():
        codes, values = pd.factorize(table[m], use_na_sentinel=False)
        aim = {None if pd.isna(r[m]) else r[m]: float(r["target"]) for r in df.where("target > 0").collect()}
        margins.append((codes, np.array([aim.get(None if pd.isna(v) else v, 0.0) for v in values])))
    limit = np.inf if most is None else table["tokens"].to_numpy() * most
    last = float("inf")
    for _ in range(sweeps):
        worst = 0.0
        for codes, aim in margins:
            held = np.bincount(codes, weights=np.where(weight >= limit * (1 - 1e-12), weight, 0.0), minlength=len(aim))
            sums = np.bincount(codes, weights=weight, minlength=len(aim))
            scale = np.divide(aim, sums, out=np.zeros_like(aim), where=sums > 0)
            used = (aim > 0) & (sums > 0)
            worst = max(worst, float(np.abs(scale[used] - 1).max(initial=0.0)))
            grow = np.where((aim > sums) & (sums > held), np.divide(aim - held, sums - held, out=np.zeros_like(aim), where=sums > held), scale)
            weight = np.minimum(weight * grow[codes], limit)
        if worst <= tolerance or worst > 0.99 * last:
            break
        last = worst
    table["weight"] = weight
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in table.itertuples(index=False)]
    return cells.sparkSession.createDataFrame(rows, cells.schema).where("weight > 0")


def _shares(weights: DataFrame, aims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """By margin (margin, target, share, reached): parts of the targets, tokens and weights of the values in ``weights``."""
    out = {}
    for m, aim in aims.items():
        sums = weights.groupBy(F.col(m).alias("_k")).agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w"))
        both = cut(sums.join(aim.select(F.col(m).alias("_m"), "target"), F.col("_k").eqNullSafe(F.col("_m"))))
        all_ = both.agg(F.sum("target"), F.sum("t"), F.sum("w")).first()
        out[m] = both.select(F.col("_k").alias(m), *[(F.col(c) / total).alias(n) for c, n, total in zip(("target", "t", "w"), ("target", "share", "reached"), all_)])
    return out


def _ordered(shares: DataFrame, margin: str):
    """target, share, ratio, targets, shares: a margin's values by tokens per target, with running sums.

    A margin of up to ``FEW_CELLS`` values is one array each; the running sums of more values are spread over tasks.
    """
    df = shares.where("target > 0").select(F.col(margin).cast("string").alias("_v"), "target", "share", (F.col("share") / F.col("target")).alias("ratio"))
    if df.count() <= FEW_CELLS:
        table = df.toPandas().sort_values(["ratio", "_v"], na_position="first").drop(columns="_v").reset_index(drop=True)
        return table.assign(targets=table["target"].cumsum(), shares=table["share"].cumsum())
    df = with_running_total(df, [], ["ratio", "_v"], "target", "targets")
    return cut(with_running_total(df, [], ["ratio", "_v"], "share", "shares").drop("_v"))


def _largest_rate(ordered) -> float:
    """Rate up to which a margin's values have enough tokens, but for those hardest to reach that hold ``RARE`` of the target."""
    if isinstance(ordered, pd.DataFrame):
        return min(1.0, float(ordered.loc[ordered["targets"] > RARE, "ratio"].min() if (ordered["targets"] > RARE).any() else 1.0))
    ratio = ordered.where(F.col("targets") > RARE).agg(F.min("ratio")).first()[0]
    return 1.0 if ratio is None else min(1.0, ratio)


def _reachable(ordered, rate: float) -> float:
    """Factor of the targets of which each value gets as much as it has, so that all is dealt.

    The values with the fewest tokens per target get all they have; the factor is what is left over what the others ask for. It is settled
    by the first value that has enough for it.
    """
    if isinstance(ordered, pd.DataFrame):
        t = ordered
        enough = np.flatnonzero(t["ratio"] / rate * (1 - t["targets"]) + t["shares"] / rate >= 1 - 1e-12)
        row = t.iloc[int(enough[0]) if len(enough) else len(t) - 1]
        return float((1 - (row["shares"] - row["share"]) / rate) / (1 - (row["targets"] - row["target"])))
    enough = F.col("ratio") / rate * (1 - F.col("targets")) + F.col("shares") / rate >= 1 - 1e-12
    spare = (1 - (F.col("shares") - F.col("share")) / rate) / (1 - (F.col("targets") - F.col("target")))
    row = ordered.select("ratio", "targets", enough.alias("enough"), spare.alias("spare")).agg(
        F.min_by(F.when(F.col("enough"), F.col("spare")), F.when(F.col("enough"), F.struct("ratio", "targets"))).alias("first"),
        F.max_by("spare", F.struct("ratio", "targets")).alias("last")).first()
    return row["first"] if row["first"] is not None else row["last"]


def _limited(weights: DataFrame, aims: dict[str, DataFrame], rate: float | None) -> tuple[DataFrame, float]:
    """The raked weights where no chance exceeds 1, and the rate; weights within the limits stay as they are."""
    tokens, whole, steepest = weights.agg(F.sum("tokens"), F.sum("weight"), F.max(F.col("weight") / F.col("tokens"))).first()
    least = min(1.0, whole / (tokens * steepest))  # up to here no cell is held
    if rate is not None and rate <= least:
        return weights, rate
    margins = _shares(weights, aims)
    unreached = F.sum(F.abs(F.col("target") - F.col("reached"))) / 2
    start = {m: df.agg(unreached).first()[0] for m, df in margins.items()}
    ordered = {m: _ordered(df, m) for m, df in margins.items()}
    now = max(least, min(map(_largest_rate, ordered.values()))) if rate is None else rate
    bare = weights.drop("weight")
    while now > least:
        scale = {m: _reachable(df, now) for m, df in ordered.items()}
        goals = {m: margins[m].select(m, F.least(F.col("target") * scale[m], F.col("share") / now).alias("target")) for m in margins}
        found = _fitted(cut(rake(bare, goals, most=1 / (tokens * now))))
        missed = {m: df.agg(unreached).first()[0] for m, df in _shares(found, goals).items()}
        if rate is not None or all(missed[m] <= start[m] + MISS for m in missed):
            return found, now
        now = max(least, now * 0.95)
    return weights, least


def uniform(doc_id: Column, seed: int) -> Column:
    """The same number from 0 to below 1 for the same id."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11) / float(1 << 53)


def mix(docs: DataFrame, power: float = 0.7, rate: float | None = None, seed: int = 17, targets=None, keep_text: bool = True) -> DataFrame:
    """``docs`` with columns mix_topic, mix_tokens, mix_probability and mix_sampled.

    The token weights of the (source, language, topic) cells are raked to the marginal targets: by
    default each margin's own token shares to the power 0.7, which lifts rare sources, languages and
    topics; ``targets`` gives other tables (margin, target) by margin. A document is sampled with probability
    rate * raked share / own share of its cell, so the sample's expected tokens have the target
    margins. A cell too small for its weight is sampled whole, and the others are raked to what is left of the
    targets. ``rate`` is the sample's expected part of all tokens; a rate above 1 raises. None takes the largest
    that the values of every margin have the tokens for, but for the rarest ones that together hold less than
    ``RARE`` of its target: these are sampled whole, as far as the margins allow, and set no limit to the others. The rate
    falls until single cells leave at most ``MISS`` of a margin unreached. The draw is a hash of doc_id and the
    seed: it depends on no order, and a retry draws the same. Topics are those of :func:`with_topic`.

    A document without words has no weight and topic 0; it is sampled with the probability 1. Nulls in source or
    language are values of their own. Rows that share a doc_id share the draw; a null doc_id counts as one
    id. No rows give no rows. Texts of any length are taken whole, and each is measured once: the measured rows are written to the shared
    folder, without the texts if ``keep_text`` is false. They meet their cells' chances in place where the cells are up to ``FEW_CELLS``. Other columns stay, but one named as an output is replaced. Tables of
    cells and of a margin's values stay distributed; up to ``FEW_CELLS`` cells are raked in the driver's memory.
    """
    own = ["mix_topic", "mix_tokens", "mix_probability", "mix_sampled"]
    if rate is not None and rate > 1:
        raise ValueError(f"a rate of {rate} asks for more than all documents")
    docs = docs.select(*free_columns(docs, own))
    topic, count = free_name(docs, "_mix_topic"), free_name(docs, "_mix_tokens")
    measured = stored(with_topic(docs, (topic, count), keep_text))
    cells = _fitted(cut(measured.groupBy("source", "lang", F.col(topic).alias("topic")).agg(F.sum(count).alias("tokens"))))
    aims = {m: tempered(cells, m, power) for m in MARGINS if cells.agg(F.sum("tokens")).first()[0]}
    aims |= targets or {}
    weights = rake(cells, aims) if aims else cells.withColumn("weight", F.lit(0.0)).where("tokens > 0")
    weights = _fitted(cut(weights))
    total = weights.agg(F.sum("tokens"), F.sum("weight")).first()
    if total[0]:
        weights, rate = _limited(weights, aims, rate)
        total = weights.agg(F.sum("tokens"), F.sum("weight")).first()
        chance = F.least(F.lit(1.0), F.col("weight") / F.col("tokens") * (rate * total[0] / total[1]))
    else:
        chance = F.lit(1.0)
    keys = {c: free_name(measured, f"_mix_{c}") for c in ("s", "l", "t", "p")}
    table = weights.select(F.col("source").alias(keys["s"]), F.col("lang").alias(keys["l"]), F.col("topic").alias(keys["t"]), chance.alias(keys["p"]))
    if table.count() <= FEW_CELLS:  # the documents then stay where they are
        table = F.broadcast(table)
    df = measured.join(table, F.col("source").eqNullSafe(F.col(keys["s"])) & F.col("lang").eqNullSafe(F.col(keys["l"])) & (F.col(topic) == F.col(keys["t"])), "left")
    probability = F.when(F.col(count) == 0, F.lit(1.0)).otherwise(F.coalesce(keys["p"], F.lit(0.0)))
    stay = [c for c in measured.columns if c not in (topic, count)]
    return df.select(*stay, F.col(topic).alias("mix_topic"), F.col(count).alias("mix_tokens"),
                     probability.alias("mix_probability"), (uniform(F.col("doc_id"), seed) < probability).alias("mix_sampled"))
