"""Embeddings, web archives, mixing, the classifier and the pipeline."""

import base64
import hashlib
import math
import zlib

import brute
import brute_new
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from exportlens.llm import classifier, embeddings, mixing, queries, warc

SMALL = "/root/testdata/sf0.001"


# --- embeddings -------------------------------------------------------------------------------

def _links(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_embedding_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = queries.embedding_near_duplicates(spark, SMALL)
    assert _links(got) == brute.linked_vectors(rows)
    assert got.where("kept <> (vec_id = component_id)").count() == 0


@pytest.mark.parametrize("block", [16, 2048])
def test_embedding_hot_group_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for group in range(5):
        centre = rng.normal(size=24)
        rows += [(len(rows) + k, (centre + 0.08 * rng.normal(size=24)).tolist(), group % 2) for k in range(40)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(30)] + [(2000 + k, [3 * x for x in rows[1][1]], 0) for k in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got, want = _links(embeddings.linked_vectors(df)), brute.linked_vectors(rows)
    near = sum(v[0] for v in want.values())
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want) and sum(v[0] for v in got.values()) >= 0.999 * near


def test_embedding_messy(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1e200, 0.0], 1), (12, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS node", "2 AS copies", "0 AS v", "3 AS size")
    got = embeddings.linked_vectors(df).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[11] == (3, 1, False)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)) and by[None] == (0, None, False)
    assert embeddings.linked_vectors(df.limit(0)).count() == 0


def test_recall_calibration():
    misses = embeddings.allowed_misses(32, 0.4, 0.98, 0.9999)
    hit = math.erf(0.4 / 0.2 / math.sqrt(2))
    tail = lambda m: sum(math.comb(32, k) * hit ** (32 - k) * (1 - hit) ** k for k in range(m + 1))
    assert tail(misses) >= 0.9999 > tail(misses - 1)


# --- archives ---------------------------------------------------------------------------------

def test_arc_versions():
    block = b"HTTP/1.0 200 OK\r\nContent-Length: 30\r\n\r\nURL IP date text/html 5\nhello\n\n"
    for version in (1, 2):
        data = warc.arc_version_block(version, "x.arc", "20010203040506")
        data += warc.arc_record(version, "http://e.org/a b", "20010203040506", "text/html", block) + b"\n"
        data += warc.arc_record(version, "dns:e.org", "2001", "text/dns", b"")
        one, two = warc.read_arc(data)
        assert one.block == block and one.fields["url"] == "http://e.org/a b" and two.block == b"" and two.fields["type"] == "text/dns"
        (fields, body), = warc.read_warc(warc.convert(one, "k") + warc.END)
        assert body == block and fields["warc-type"] == "response" and fields["warc-date"] == "2001-02-03T04:05:06Z"
        payload = block.split(b"\r\n\r\n", 1)[1]
        assert fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        (fields, body), = warc.read_warc(warc.convert(two, "k") + warc.END)
        assert fields["warc-type"] == "resource" and fields["warc-date"] == "2001-01-01T00:00:00Z"
        with pytest.raises(ValueError):
            list(warc.read_arc(data[:-3] + b"9"))
    with pytest.raises(ValueError):
        list(warc.read_arc(b"http://x 0 0 0 0\n"))
    assert warc.record_id("a") == warc.record_id("a") != warc.record_id("b")


def _archive(rows):
    """{page_id: expected row} for distinct ids."""
    first = {}
    for i, _, html in rows:
        first[html or ""] = min(first.get(html or "", i), i)
    out = {}
    for i, _, html in rows:
        data = (html or "").encode()
        low = first[html or ""]
        out[i] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if low == i else "revisit", None if low == i else low)
    return out


def test_archive_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    got = {r["page_id"]: tuple(r)[1:] for r in queries.warc_archive(spark, SMALL).collect()}
    assert got == _archive(rows)


def test_archive_messy(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 2000)
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(k, f"http://e.org/{k} é\n", ["", None, tricky, "same", "é" * 5000, f"own {k}"][k % 6]) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'d' AS digest", "1 AS first", "2 AS page")
    assert {r["page_id"]: tuple(r)[1:] for r in warc.archive_roundtrip(df).collect()} == _archive(rows)
    odd = spark.createDataFrame([(None, None, "z"), (None, None, "z"), (3, None, "z"), (3, "u", "z"), (4, "u", "z"), (None, None, None)], df.schema[:3])
    got = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in warc.archive_roundtrip(odd).collect())
    assert got == [("3", "response", "None"), ("3", "response", "None"), ("4", "revisit", "3"), ("None", "response", "None"),
                   ("None", "revisit", "3"), ("None", "revisit", "3")]
    assert warc.archive_roundtrip(df.limit(0)).count() == 0
    small = {r["page_id"]: r["record_type"] for r in warc.archive_roundtrip(df, least_bytes=5).collect()}
    assert all(t == "response" for i, t in small.items() if rows[i][2] in ("", None, "same"))


# --- mixing -----------------------------------------------------------------------------------

def test_mixing_reaches_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).cache()
    assert got.count() == docs.count() and got.agg(F.max("mix_probability")).first()[0] <= 1
    total = got.agg(F.sum(F.col("mix_tokens") * F.col("mix_probability"))).first()[0]
    for margin in ("source", "lang", "mix_topic"):
        rows = got.groupBy(margin).agg(F.sum("mix_tokens").alias("t"), F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("e")).collect()
        power = sum(r["t"] ** 0.7 for r in rows if r["t"])
        for r in rows:
            assert abs(r["e"] / total - r["t"] ** 0.7 / power) < 2e-3
    share = got.where("mix_sampled").agg(F.sum("mix_tokens")).first()[0]
    assert abs(share / total - 1) < 0.15
    assert sorted(mixing.mix(docs.repartition(5)).select("doc_id", "mix_sampled").collect()) == sorted(got.select("doc_id", "mix_sampled").collect())


def test_raking_of_many_cells_agrees(spark, monkeypatch):
    rng = np.random.default_rng(3)
    cells = [(f"s{a}" if a else None, f"l{b}", c, int(rng.integers(1, 500))) for a in range(4) for b in range(3) for c in range(3)]
    df = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    aims = {m: mixing.tempered(df, m, 0.5) for m in mixing.MARGINS}
    few = {tuple(r)[:3]: r["weight"] for r in mixing.rake(df, aims).collect()}
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    many = {tuple(r)[:3]: r["weight"] for r in mixing.rake(df, aims).collect()}
    assert few.keys() == many.keys() and all(abs(few[k] / many[k] - 1) < 1e-9 for k in few)


def test_mixing_query_equals_brute_version(spark):
    for folder in (SMALL,):
        rows = queries.source_mixing(spark, folder).collect()
        want = brute_new.mixture([(r["doc_id"], r["source"], r["lang"], r["mix_topic"], r["mix_tokens"]) for r in rows], mixing.RARE, mixing.MISS)
        for r in rows:
            assert abs(r["mix_probability"] - want[r["doc_id"]]) < 1e-6
            assert r["mix_sampled"] == (brute_new.draw(r["doc_id"], 17) < r["mix_probability"])


@pytest.mark.parametrize("few", [0, 100_000])
def test_rates_of_many_values(spark, monkeypatch, few):
    """Rate and factor from running sums over tasks, and from arrays, equal those of a plain computation."""
    monkeypatch.setattr(mixing, "FEW_CELLS", few)
    rng = np.random.default_rng(4)
    target, share = rng.pareto(1.0, 300) + 1e-3, rng.pareto(0.8, 300) + 1e-3
    target, share = target / target.sum(), share / share.sum()
    ordered = mixing._ordered(spark.createDataFrame([(f"h{k}", float(t), float(s)) for k, (t, s) in enumerate(zip(target, share))], "source string, target double, share double"), "source")
    order = np.argsort(share / target)
    ratio, t, s = (share / target)[order], target[order], share[order]
    assert abs(mixing._largest_rate(ordered) - min(1.0, ratio[np.searchsorted(np.cumsum(t), mixing.RARE, side="right")])) < 1e-12
    for rate in (0.3, 0.8, 1.0):
        k = int(np.flatnonzero(ratio / rate * (1 - np.cumsum(t)) + np.cumsum(s) / rate >= 1 - 1e-12)[0])
        want = (1 - (np.cumsum(s)[k] - s[k]) / rate) / t[k:].sum()
        assert abs(mixing._reachable(ordered, rate) / want - 1) < 1e-9


def test_mixing_messy(spark, messy, nothing):
    rows = mixing.mix(messy).collect()
    assert len(rows) == messy.count()
    assert all(r["mix_sampled"] and r["mix_probability"] == 1 for r in rows if r["mix_tokens"] == 0)
    assert mixing.mix(nothing).count() == 0 and mixing.mix(messy.where("text IS NULL")).count() == 2
    clash = mixing.mix(messy.selectExpr("*", "1 AS mix_topic", "2 AS _mix_topic", "3 AS _mix_p", "4 AS _text", "'x' AS topic", "5 AS tokens", "6 AS weight"))
    assert clash.count() == len(rows) and clash.columns.count("mix_topic") == 1 and {"_mix_topic", "weight"} <= set(clash.columns)
    with pytest.raises(ValueError):
        mixing.mix(messy, rate=1.5)


# --- classifier -------------------------------------------------------------------------------

def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 50, 6)).astype(np.int32),) for _ in range(40)]
    rows = [(b, rng.random(len(b)).astype(np.float32), rng.random(len(classifier.STATS)).astype(np.float32), int(b[0] % 2)) for (b,) in rows]
    model = classifier.fit(rows)
    for b, w, s, _ in rows[:5]:
        at, x = model.inputs(b, w, s)
        pairs = sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
        z = model.bias + model.linear[at] @ x + pairs
        assert abs(model.score(b, w, s) - 1 / (1 + math.exp(-z))) < 1e-9


def test_classifier_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.quality_classifier(spark, folder).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert len(rows) > 500 and right >= 0.97
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) >= 0.98


def test_classifier_messy(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 1), (6, 1), (6, 0), (99, 1)], "doc_id long, quality int")
    model = classifier.train(messy, labels)
    rows = classifier.with_score(messy, model).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = classifier.train(messy, labels.limit(0))
    assert {r["score"] for r in classifier.with_score(messy, empty).collect()} == {0.5}
    assert classifier.with_score(nothing, model).count() == 0
    clash = classifier.with_score(messy.selectExpr("*", "1 AS score", "2 AS _text"), model)
    assert clash.columns.count("score") == 1 and clash.where("score > 1").count() == 0 and clash.count() == len(rows)


def test_classifier_sample_is_bounded(spark, monkeypatch):
    """Repeated ids, many labels of an id and texts of many words don't make the sample larger."""
    long = " ".join(f"w{k}" for k in range(9000))
    docs = spark.createDataFrame([(1, long)] * 50 + [(k, f"some text number {k}") for k in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)] * 20, "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(classifier, "fit", lambda rows: seen.append(rows))
    classifier.train(docs, labels)
    assert len(seen[0]) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(1, 40))
    monkeypatch.setattr(classifier, "MOST_INPUTS", 60)
    classifier.train(docs, labels)
    assert 0 < sum(len(r[0]) for r in seen[1]) <= 60


def test_classifier_query_equals_brute_version(spark, documents):
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
    want = brute_new.quality_scores(documents[1], labels)
    rows = queries.quality_classifier(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(want)
    for r in rows:
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-4
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3)


# --- pipeline ---------------------------------------------------------------------------------

def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now, sizes = docs, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, folder)
        now = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(now.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert sizes[1] >= 0.7 * sizes[0]
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(ran.select("doc_id", "ids_sha256").collect()) == sorted(now.select("doc_id", "ids_sha256").collect())


def test_pipeline_messy(spark, messy, tmp_path):
    spark.createDataFrame([(6, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (messy, messy.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.count() <= docs.count()
