"""Quality thresholds: a plain version, groups that no fixed cutoff fits, small groups."""

import random

import brute_new
from pyspark.sql import functions as F

from exportlens.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"
SIDES = {m: (low, high) for m, (_, low, high) in quality.METRICS.items()}


def _text(rng, n, sign=0.0):
    words = ["".join(rng.choice("aeionrst") for _ in range(rng.randrange(3, 9))) for _ in range(n)]
    return " ".join(w + ("" if rng.random() > sign else rng.choice("#;{}()=")) for w in words) + "."


def _kept(spark, rows):
    return {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_verdicts_that_no_fixed_cutoff_gives(spark):
    """Code has many signs and prose few: a share of signs between is too much for prose, and what is usual for code is more still."""
    rng = random.Random(1)
    rows = [(k, _text(rng, 120, rng.uniform(0.02, 0.08)), "en", "prose") for k in range(400)]
    rows += [(1000 + k, _text(rng, 120, rng.uniform(0.5, 0.8)), "en", "code") for k in range(400)]
    rows += [(2000 + k, _text(rng, 120, 0.4), "en", "prose") for k in range(8)]
    got = _kept(spark, rows)
    assert not any(got[2000 + k] for k in range(8))
    assert sum(got[k] for k in range(400)) >= 396 and sum(got[1000 + k] for k in range(400)) >= 396


def test_equals_plain_version(spark, documents):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    measured = quality.measures(df).withColumns({m: F.expr(e).cast("double") for m, (e, _, _) in quality.METRICS.items()}).collect()
    rows = [(r["lang"], r["source"], r["base_failed"], {m: r[m] for m in SIDES}) for r in measured]
    want = brute_new.kept_by_quartiles(rows, SIDES, quality.FENCE, quality.PRIOR)
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df).collect()}
    differ = [r["doc_id"] for r, k in zip(measured, want) if got[r["doc_id"]] != k]
    # The sketch rounds a value by a thousandth; only values next to a threshold can fall on its other side.
    assert len(differ) <= 0.01 * len(rows) and any(want) and not all(want)


def test_no_jump_with_the_size_of_a_group(spark):
    """The threshold of a small group moves from its language's to its own by small steps."""
    rng = random.Random(3)
    base = [(k, _text(rng, 100, rng.uniform(0.02, 0.08)), "en", "prose") for k in range(600)]
    code = [(1000 + k, _text(rng, 100, rng.uniform(0.5, 0.8)), "en", "code") for k in range(400)]
    highs = []
    for n in (1, 5, 25, 100, 199, 201, 400):
        measured = quality.measures(spark.createDataFrame(base + code[:n], SCHEMA))
        row = quality.thresholds(measured).where("source = 'code' AND metric = 'punctuation_share'").first()
        highs.append(row["high"])
    # The language's own quartile moves over to code at about 200 documents; it counts for ``PRIOR`` documents of 210.
    near = highs[4] / highs[5]
    assert 0.93 < near < 1.07 and max(highs) / min(highs) > 1.5


def test_metric_without_spread_has_no_threshold(spark):
    rows = [(k, "aaaa bbbb cccc dddd eeee ffff gggg hhhh iiii jjjj kkkk llll mmmm nnnn oooo pppp qqqq rrrr ssss tttt uuuu", "en", "a") for k in range(30)]
    rows.append((99, " ".join(f"Ab{k}C!" for k in range(30)), "en", "a"))
    assert all(_kept(spark, rows).values())
