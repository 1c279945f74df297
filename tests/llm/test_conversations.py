"""Conversation repair against every edit string, and its prefix tree."""

import random

import brute_new as brute
import pytest

from exportlens.llm import conversations as C
from exportlens.llm import queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _rows(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("modulus", [C.MODULUS, 7, 1])
def test_prefixes_compare_as_strings(modulus):
    rng = random.Random(modulus)
    tree, strings = C.Prefixes(modulus), [""]
    for _ in range(400):
        parent = rng.randrange(len(strings))
        letter = rng.choice("DIKR")
        strings.append(strings[parent] + letter)
        assert tree.add(parent, letter) == len(strings) - 1
    for _ in range(4000):
        a, b = rng.randrange(len(strings)), rng.randrange(len(strings))
        assert tree.less(a, b) == (strings[a] < strings[b])
        assert tree.string(a) == strings[a]


@pytest.mark.parametrize("modulus", [C.MODULUS, 3])
def test_cheapest_edits(modulus):
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), str(k), rng.random() < 0.2, rng.random() < 0.2) for k in range(rng.randrange(6))]
        found = C.best_edits([(role[:1], gone, cut) for role, _, gone, cut in rows], modulus=modulus)
        cost, audit = min(v for (_, end), v in found.items() if end in C.ENDS)
        want = brute.cheapest(rows)
        assert (cost, audit) == want[:2]
        assert list(C.apply_edits(audit, ((r, t) for r, t, *_ in rows))) == want[2]


def test_long_conversation_is_linear():
    rows = [("us"[k % 7 == 0], k % 11 == 0, k % 13 == 0) for k in range(30_000)]
    cost, audit = min(v for (_, end), v in C.best_edits(rows).items() if end in C.ENDS)
    assert len(audit) >= len(rows) and cost > 0


def test_query_equals_brute_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(queries.conversation_repair(spark, SMALL)) == brute.repaired(brute.damaged(rows), rows)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    rows = [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 2, None, None), (2, 5, "", "x."), (2, 5, "", "x."), (2, 5, "tool", "y."), (2, 3, "assistant", "z"),
            (None, 1, "user", "a."), (None, 2, "assistant", "b."), (3, None, None, None), (4, 0, "system", "s."), (5, 7, "user", " \n\t "), (6, 0, "user", "é漢?"), (6, 9, "assistant", "ok!")]
    for conv in range(10, 40):
        rows += [(conv, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", "C!", "D?\n", ""])) for _ in range(rng.randrange(1, 7))]
    return rows


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_odd_rows_in_any_ranges(spark, odd, partitions):
    """Conversations that begin, end or lie across ranges come out the same."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        df = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 AS copies", "'x' AS audit", "0 AS part", "1 AS head")
        got = _rows(C.repair(C.damage(df), "copies"))
        want = brute.repaired(brute.damaged(odd), odd)
        assert got == want
        plain = C.repair(df)
        space = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd]
        assert _rows(plain) == brute.repaired(space, space)
        turns = {}
        for r in sorted(C.repaired_rows(df, plain).collect(), key=lambda r: r["place"]):
            turns.setdefault(r["conv_id"], []).append(r["role"][0])
        assert all(brute._legal("".join(x)) for x in turns.values())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_long_conversation_across_ranges(spark):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "user", "assistant", "system"]), rng.choice([f"text {k}.", f"cut {k}", "same.", ""])) for k in range(3000)]
    rows += [(0, 0, "user", "a."), (2, 0, "user", "a.")] + [(3, 1, "user", "again.")] * 500
    whole = _rows(C.repair(spark.createDataFrame(rows, SCHEMA).coalesce(1)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    enabled = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for partitions in ("1", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert _rows(C.repair(spark.createDataFrame(rows, SCHEMA))) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", enabled)
    assert len(whole[1][6]) >= 3000 and whole[3][6].count("D") >= 499


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair(empty).collect() == []
    assert C.repair(C.damage(empty), "copies").collect() == []
