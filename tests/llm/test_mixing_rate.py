"""Mixing: one rare document sets no limit to the sample; cells too small are sampled whole."""

import random

import numpy as np
from pyspark.sql import functions as F

from exportlens.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string"


def _docs(count):
    rng = random.Random(5)
    words = [f"word{k}abc" for k in range(3000)]
    return [(k, " ".join(rng.choice(words) for _ in range(40)), f"l{k % 4}", f"s{0 if k % 3 == 0 else 1 + rng.randrange(9)}") for k in range(count)]


def _kept(got):
    both = got.agg(F.sum(F.col("mix_tokens") * F.col("mix_probability")), F.sum("mix_tokens")).first()
    return both[0] / both[1]


def test_a_rare_document_leaves_the_rate(spark):
    docs = _docs(2000)
    rare = (9999, docs[0][1], None, "rare")
    without = mixing.mix(spark.createDataFrame(docs, SCHEMA))
    got = mixing.mix(spark.createDataFrame([*docs, rare], SCHEMA)).cache()
    assert _kept(got) > 0.95 * _kept(without) > 0.5
    row = got.where("doc_id = 9999").first()
    assert row["mix_sampled"] and row["mix_probability"] > 0.99
    e = F.col("mix_tokens") * F.col("mix_probability")
    total = got.agg(F.sum(e)).first()[0]
    for margin in ("source", "lang", "mix_topic"):
        rows = got.groupBy(margin).agg(F.sum("mix_tokens").alias("t"), F.sum(e).alias("e")).collect()
        power = sum(r["t"] ** 0.7 for r in rows)
        assert sum(abs(r["e"] / total - r["t"] ** 0.7 / power) for r in rows) / 2 < mixing.RARE + mixing.MISS


def test_a_higher_rate_holds_cells(spark):
    got = mixing.mix(spark.createDataFrame(_docs(1000), SCHEMA), rate=0.9)
    assert abs(_kept(got) - 0.9) < 2e-3 and got.agg(F.max("mix_probability")).first()[0] <= 1


def test_held_cells_agree_in_memory_and_as_joins(spark, monkeypatch):
    rng = np.random.default_rng(4)
    cells = [(f"s{a}" if a else None, f"l{b}", c, int(rng.integers(1, 500))) for a in range(4) for b in range(3) for c in range(3)]
    df = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    aims, total = {m: mixing.tempered(df, m, 0.9) for m in mixing.MARGINS}, sum(c[3] for c in cells)
    most = 1 / (0.97 * total)
    few = {tuple(r)[:3]: r["weight"] for r in mixing.rake(df, aims, most=most, sweeps=6).collect()}
    assert any(abs(w / (most * t) - 1) < 1e-9 for (*k, t) in cells for w in [few[tuple(k)]])
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    many = {tuple(r)[:3]: r["weight"] for r in mixing.rake(df, aims, most=most, sweeps=6).collect()}
    assert few.keys() == many.keys() and all(abs(few[k] / many[k] - 1) < 1e-9 for k in few)
