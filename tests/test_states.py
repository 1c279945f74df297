"""Mergeable distinct counts, orphans from bitmaps, long series, sample and histogram without a second reading."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from exportlens.operators import distinct, quality, relative, series
from exportlens.operators.sampling import sample_orders
from exportlens.plans import analysis, view_builders
from exportlens.registry import loaded_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice(["a", "b"]), rng.choice([None, 0, -1, 1, 32768, 32769, 70000, 10**12, rng.randrange(-10**6, 10**6)])) for _ in range(3000)]
    return spark.createDataFrame(rows, "k int, g string, id long"), rows


def test_distinct_counts_equal_sets_at_every_level(spark, facts):
    df, rows = facts
    states = distinct.distinct_states(df, ["k", "g"], "id")
    for keys in (["k", "g"], ["k"], ["g"], []):
        at = [["k", "g"].index(x) for x in keys]
        want = {}
        for r in rows:
            if r[2] is not None:
                want.setdefault(tuple(r[i] for i in at), set()).add(r[2])
        got = {tuple(r[:-1]): r[-1] for r in distinct.count_states(distinct.merge_distinct(states, keys), keys, "n").collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_distinct_counts_of_text_ids_and_empty_groups(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", 5), (1, "y", 5), (2, None, None)], "k int, t string, i int")
    out = distinct.join_counts(df.groupBy("k").agg(F.count("*").alias("n")), distinct.distinct_counts(df, ["k"], {"texts": "t", "ids": "i"}), ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 3, 2, 1), (2, 1, 0, 0)]
    whole = distinct.join_counts(df.agg(F.count("*").alias("n")), distinct.distinct_counts(df, [], {"ids": "i"}), [])
    assert [tuple(r) for r in whole.collect()] == [(4, 1)]
    assert distinct.join_counts(df.where("false").agg(F.count("*").alias("n")), distinct.distinct_counts(df.where("false"), [], {"ids": "i"}), []).first().ids == 0


def test_counts_of_many_groups_hold_no_bitmaps(spark):
    """A bitmap is 4 KB however few ids a group has, and none is shuffled in parts."""
    df = spark.range(1000).select((F.col("id") % 500).alias("k"), (F.col("id") * 70001).alias("i"))
    counts = distinct.distinct_counts(df, ["k"], {"ids": "i"})[0]
    assert "bitmap" not in plan(counts) and counts.where("ids = 2").count() == 500
    states = plan(distinct.distinct_states(df, ["k"], "i"))
    assert "Exchange" not in states.split("partial_bitmap_construct_agg")[0]


def test_views_with_distinct_counts_repeat_no_rows(spark):
    tables, views = loaded_tables(spark, FOLDER), view_builders("2001-08-01")
    for name in ("executive_revenue", "channel_performance", "master_summary"):
        assert "Expand" not in plan(views[name](tables))


def test_orphans_by_bitmap_equal_anti_join(spark, facts):
    child, rows = facts
    parent = spark.createDataFrame([(x,) for x in (0, -1, 32769, 10**12, None, 5, 5)], "id long")
    want = {}
    for r in rows:
        if r[2] is not None and r[2] not in (0, -1, 32769, 10**12, 5):
            want[r[2]] = want.get(r[2], 0) + 1
    for found in (quality.orphans_by_bitmap, quality.dq_foreign_key):
        assert {r["id"]: r["row_count"] for r in found(child, "id", parent).collect()} == want
    assert quality.orphans_by_bitmap(child, "id", parent.where("false")).count() == len(want) + 4


def test_foreign_keys_keep_their_types(spark):
    from exportlens.sources.schemas import FOREIGN_KEYS

    report = quality.foreign_key_report(loaded_tables(spark, FOLDER), FOREIGN_KEYS)
    assert " as string)" not in plan(report)
    found = {(r.child_table, r.key): (r.orphan_keys, r.orphan_rows) for r in report.collect()}
    assert len(found) == 16 and found["fact_export_orders", "customer_id"][0] > 0 and found["fact_shipment_details", "order_id"] == (0, 0)


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_long_series_equal_plain_windows(spark, partitions):
    rng = random.Random(int(partitions))
    rows = [("hot", i, rng.choice([None, i % 5])) for i in range(400)] + [("b", 1, 4), ("b", 2, None), (None, 1, 3), (None, 9, 1), ("z", 0, 7)]
    df = spark.createDataFrame(rows, "s string, t int, x int")
    window = Window.partitionBy("s").orderBy("t")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        key = lambda r: (r[0] or "", r[1])
        got = sorted((tuple(r) for r in series.with_previous(df, ["s"], ["t"], "x", "p").collect()), key=key)
        assert got == sorted((tuple(r) for r in df.withColumn("p", F.lag("x").over(window)).collect()), key=key)
        got = sorted((tuple(r) for r in series.with_running_total(df, ["s"], ["t"], "x").collect()), key=key)
        want = df.withColumn("r", F.coalesce(F.sum("x").over(window), F.lit(0)))
        assert got == sorted((tuple(r) for r in want.collect()), key=key)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_series_fills_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("one").alias("s"), F.col("id").alias("t"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = series._numbered(df, ["s"], ["t"])
        assert rows.groupBy("_range").count().agg(F.max("count")).first()[0] < 6000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("n", [0, 1, 7, 999, 1000, 1500])
def test_sample_by_threshold(spark, n):
    orders = spark.range(2000).select(F.col("id").alias("order_id"), F.when(F.col("id") % 2 == 0, "Delivered").otherwise("Shipped").alias("order_status"))
    got = {r.order_id for r in sample_orders(orders, n).collect()}
    by_hash = F.substring(F.md5(F.concat(F.lit("42:"), F.col("order_id").cast("string"))), 1, 15)
    want = {r.order_id for r in orders.where("order_status = 'Delivered'").orderBy(by_hash, "order_id").limit(n).collect()}
    assert got == want and len(got) == min(n, 1000)


def test_sample_puts_one_bucket_in_order(spark):
    orders = spark.range(100).select(F.col("id").alias("order_id"), F.lit("Delivered").alias("order_status"))
    lines = [x for x in plan(sample_orders(orders, 5)).splitlines() if "Window" in x]
    assert all("_bucket" in x for x in lines)


def test_histogram_evaluates_its_frame_once(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("decimal(6,1)").alias("x"))
    out = relative.histogram(df.repartition(3), "x", 5)
    assert sum(r.n for r in out.collect()) == 1000
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:  # without adaptive plans, whose text shows a plan several times
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        text = plan(relative.histogram(df.repartition(3), "x", 5))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "ReusedExchange" in text and text.count("Range (0, 1000") == 1


def test_scores_scan_each_fact_once(spark):
    tables, views = loaded_tables(spark, FOLDER), view_builders("2001-08-01")
    scored = analysis.score_markets(views["market_entry_readiness"](tables))
    assert "exportlens/" in plan(scored) and "order_status" not in plan(scored)
    assert scored.count() == 25
