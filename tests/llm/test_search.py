"""Ranked search against a plain version of the contract."""

import random

import brute_new as brute
import numpy as np
import pytest

from exportlens.llm import queries, search

SMALL = "/root/testdata/sf0.001"


def _hits(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["rank"])):
        hits = out.setdefault(r["item_id"], [])
        hits.append((r["doc_id"], r["score"]))
        assert r["rank"] == len(hits)
    return out


def _want(docs, items):
    return {i: hits for i, hits in brute.ranked(docs, items).items() if hits}


def test_terms():
    text = "Ab-c9_É\x00x\x7fyÄÖ\n{z} 漢 字a'b"
    assert [t.decode() for t in search.terms(text.encode())] == brute.terms(text)


def test_query_equals_brute_version(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert _hits(queries.ranked_search(spark, SMALL)) == _want(documents[1], items)


@pytest.mark.parametrize("stratum, segment, terms", [(512, 8_000_000, 500_000), (2, 40, 500_000), (1, 8_000_000, 12)])
def test_many_ties_and_small_strata(spark, monkeypatch, stratum, segment, terms):
    monkeypatch.setattr(search, "STRATUM_DOCS", stratum)
    monkeypatch.setattr(search, "SEGMENT", segment)
    monkeypatch.setattr(search, "ITEM_TERMS", terms)
    rng = random.Random(stratum)
    words = [f"w{k}" for k in range(30)]
    docs = [(k, " ".join(rng.choices(words, weights=range(1, 31), k=rng.choice([1, 2, 3, 3, 3, 8, 60])))) for k in range(500)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 7)))) for k in range(12)] + [(90, "absent"), (91, "")]
    got = _hits(search.ranked_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == _want(docs, items)


def test_bounds_leave_strata_out():
    """The best strata come first, and those that can't reach the k-th score are not visited."""
    m = np.repeat(np.arange(75, 275), 3)
    term = np.tile([1, 2, 2], 200)
    tf = np.tile([1, 1, 2], 200)
    strata = search.Strata(m, np.ones(len(m), dtype=np.int64), term, tf)
    visited = []
    strata.impact = type("Seen", (), {"__getitem__": lambda self, at, x=strata.impact: (visited.append(len(at)), x[at])[1]})()
    best = strata.best(np.array([1]), np.array([1000]), 5, 0)
    assert len(best) >= 5 and sum(visited) < 40


def test_odd_tables(spark, messy, nothing):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    items = [(1, "one two"), (1, "one two"), (2, None), (3, " .. "), (None, "same LINE"), (4, "é" * 300 + " one one")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS rank", "3 AS score", "4 AS query")
    got = _hits(search.ranked_documents(messy.selectExpr("*", "1 AS m", "2 AS tfs"), frame))
    want = {}
    for item, text in dict.fromkeys(items):
        docs = [(i, t) for i, t in rows]
        ranked = brute.ranked([((i is not None, i or 0), t) for i, t in docs], [(item, text)])[item]
        if ranked:
            want[item] = [(i[1] if i[0] else None, s) for i, s in ranked]
    assert got == want
    assert search.ranked_documents(nothing, frame).collect() == []
    assert search.ranked_documents(messy, frame.where("false")).collect() == []
