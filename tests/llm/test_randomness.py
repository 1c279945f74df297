"""The secret scan's battery: keys of each encoding among ordinary tokens, a plain version, long texts."""

import random
import time

import brute
import brute_new
import pytest

from exportlens.llm import secrets

ALPHABETS = {
    "HEX": "0123456789ABCDEF", "BASE32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


@pytest.fixture(scope="module")
def ordinary(spark):
    """Five thousand documents with words, paths, identifiers and numbers of 20 characters or more, none of them random."""
    rng = random.Random(1)
    syllables = ["ing", "er", "th", "and", "tion", "ment", "con", "re", "pro", "al", "is", "in", "ous", "de"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    makers = [lambda: word(9), lambda: "/".join(word(2) for _ in range(5)), lambda: "_".join(word(3) for _ in range(3)).upper(),
              lambda: "".join(word(2).title() for _ in range(5)), lambda: f"{word(6)}{rng.randrange(2000, 2025)}", lambda: f"2024{rng.randrange(10):02d}0100000000{rng.randrange(100):04d}"]
    return [(k, f"see {rng.choice(makers)()} here, {word(2)} {rng.choice(makers)()}") for k in range(5000)]


def _found(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    return {r["doc_id"]: [(x["s"], x["e"]) for x in r["random"]] for r in secrets.find_secrets(df).collect()}


# Encoding, length and how many of 40 keys have to be found among 5,000 ordinary documents. Short keys of an encoding that
# 1,600 ordinary tokens share are found in part only.
KEYS = [("HEX", 32, 36), ("HEX", 40, 36), ("HEX", 64, 36), ("BASE32", 32, 36), ("base36", 32, 36), ("base62", 20, 20), ("base62", 40, 36), ("base64", 24, 30)]


def test_rare_keys_among_ordinary_tokens(spark, ordinary):
    docs = list(ordinary)
    for j, (name, length, _) in enumerate(KEYS):
        rng = random.Random(length)
        docs += [(10_000 + 100 * j + k, f"see {''.join(rng.choice(ALPHABETS[name]) for _ in range(length))} here") for k in range(40)]
    got = _found(spark, docs)
    for j, (_, length, least) in enumerate(KEYS):
        assert sum(got[10_000 + 100 * j + k] == [(4, 4 + length)] for k in range(40)) >= least
    assert sum(bool(got[k]) for k, _ in ordinary) <= 6


def test_battery_equals_plain_version(spark, documents, ordinary):
    rng = random.Random(4)
    docs = documents[1] + [(100_000 + i, t) for i, t in ordinary[:800]]
    for k in range(120):
        letters = rng.choice(list(ALPHABETS.values()))
        docs.append((200_000 + k, f"a {''.join(rng.choice(letters) for _ in range(rng.randrange(18, 90)))}{'=' * rng.randrange(3)} b token=abcdefgh{k}xyz"))
    base = {i: brute.secrets(t) for i, t in docs}
    want, got = brute_new.random_tokens(docs, base), _found(spark, docs)
    assert got == want
    assert sum(map(bool, want.values())) > 60


def test_spans_of_long_texts_take_time_in_proportion(spark):
    rng = random.Random(2)
    token = lambda: "".join(rng.choice(ALPHABETS["base62"]) for _ in range(24))
    text = " ".join(f"token={k:09d} {token()} é" for k in range(20_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    secrets.find_secrets(spark.createDataFrame([(1, text[:2000])], "doc_id long, text string")).collect()
    start = time.time()
    row = secrets.find_secrets(df).first()
    assert time.time() - start < 60
    assert [(x["s"], x["e"]) for x in row["base"]] == [(s, e) for _, s, e in brute.secrets(text)] and len(row["base"]) == 20_000
    assert all(text[x["s"] : x["e"]] == x["m"] for x in row["random"]) and len(row["random"]) > 15_000
