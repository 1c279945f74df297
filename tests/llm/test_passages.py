"""Line dedup: planted passages in unique surroundings, and a plain version."""

import random
import time

import brute
import pytest

from exportlens.llm import lines


def plain(docs, least_words=50):
    """docs: [(doc_id, text)] with distinct ids. {doc_id: (runs removed, lines removed, text)}"""
    seen, out, parsed = {}, {}, {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        rows = text.split("\n")
        full = [k for k, x in enumerate(rows) if brute.words(x)]
        long = {k for k in full if len(brute.words(rows[k])) >= least_words}
        units = [((k, k), rows[k]) for k in sorted(long)] + [((a, b), "\n".join(rows[a : b + 1])) for a, b in zip(full, full[1:])]
        for (a, b), u in units:
            seen.setdefault(u, []).append((i, a, b))
        parsed[i] = rows, full, long, units
    for i, (rows, full, long, units) in parsed.items():
        here, there = set(), set()
        for (a, b), u in units:
            if len(seen[u]) > 1:
                ends = {a} if a == b else {a, b} - long
                (here if min(seen[u]) == (i, a, b) else there).update(ends)
        gone = set()
        for k, upto in zip(full, full[1:] + [len(rows)]):
            if k in there - here:
                gone |= set(range(k, upto))
        out[i] = sum(k - 1 not in gone for k in gone), len(gone), "\n".join(x for k, x in enumerate(rows) if k not in gone)
    return out


@pytest.mark.parametrize("shape", [(1, 60, ""), (1, 60, "\n"), (2, 30, ""), (3, 20, ""), (4, 15, "\n"), (8, 10, ""), (12, 10, "\n"), (2, 4, "")])
def test_planted_passages_go_from_unique_surroundings(spark, shape):
    count, size, blank = shape
    rng = random.Random(count)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [f"\n{blank}".join(line(size) for _ in range(count)) for _ in range(20)]
    docs = [(k, f"{line(9)}\n{line(9)}\n{passages[k % 20]}\n{blank}{line(9)}\n{line(9)}") for k in range(100)]
    rows = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    for k, text in docs:
        before = text.split("\n")
        assert rows[k]["clean_text"] == (text if k < 20 else "\n".join(before[:2] + before[-2:]))
        assert rows[k]["n_removed_lines"] == (0 if k < 20 else len(before) - 4)
        assert rows[k]["n_removed_chunks"] == (k >= 20)


def test_passages_equal_the_plain_version(spark, documents):
    rng = random.Random(6)
    pool = ["", " ", "a b", "c", "d e f", "x" * 30, "\nb", "\tq", " ".join(f"l{k}" for k in range(50)), " ".join(f"m{k}" for k in range(60))]
    docs = documents[1] + [(50_000 + k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for k in range(300)]
    got = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    want = plain(docs)
    assert {r["doc_id"]: (r["n_removed_chunks"], r["n_removed_lines"], r["clean_text"]) for r in got.collect()} == want
    assert sum(n for n, _, _ in want.values()) > 0


def test_every_repeated_pair_of_short_lines_stays_once(spark):
    rng = random.Random(2)
    docs = [(k, "\n".join(f"t{rng.randrange(12)}" for _ in range(8))) for k in range(60)]
    pairs = lambda text: set(zip(text.split("\n"), text.split("\n")[1:]))
    left = [r["clean_text"] for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    held = set().union(*map(pairs, left))
    repeated = [p for _, t in docs for p in pairs(t) if sum(p in pairs(x) for _, x in docs) > 1]
    assert repeated and set(repeated) <= held


def test_passages_messy(spark, messy, nothing):
    rows = lines.dedup_lines(messy).collect()
    assert len(rows) == messy.count() and all((r["clean_text"] is None) == (r["text"] is None) for r in rows)
    twice = [r for r in rows if r["doc_id"] == 6]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert lines.dedup_lines(nothing).count() == 0
    clash = lines.dedup_lines(messy.selectExpr("*", "1 AS n_lines", "2 AS _ld_gone", "'x' AS h", "3 AS digest", "4 AS stays", "5 AS rolled", "'y' AS clean_text"))
    assert clash.count() == len(rows) and clash.columns.count("n_lines") == 1 and "_ld_gone" in clash.columns


def test_long_texts_take_time_in_proportion(spark):
    """Every line of long equal texts is repeated; each is looked at a fixed number of times."""
    text = "\n".join(f"line {k}" for k in range(8000))
    df = spark.createDataFrame([(k, text) for k in range(4)], "doc_id long, text string")
    lines.dedup_lines(df.limit(1)).collect()
    start = time.time()
    rows = {r["doc_id"]: r for r in lines.dedup_lines(df).collect()}
    assert time.time() - start < 10
    assert [rows[k]["n_removed_lines"] for k in range(4)] == [0, 8000, 8000, 8000] and rows[0]["clean_text"] == text and rows[1]["clean_text"] == ""
