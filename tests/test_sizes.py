"""What grows with the tables: parts of the shuffles, and what is moved for the products."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from test_loading import FOLDER, no_broadcast, plan  # noqa: F401

from exportlens.functions.packing import DAY, INT, Packing
from exportlens.plans import view_builders
from exportlens.registry import loaded_tables
from exportlens.session import FILLED, PARTITIONS, size_shuffles
from exportlens.sources import testdata
from exportlens.sources.warehouse import Warehouse


@pytest.fixture
def partitions(spark):
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, "7")  # whatever earlier tests have raised it to
    yield 7
    spark.conf.set(PARTITIONS, before)


def test_shuffle_partitions_are_raised_and_never_lowered(spark, partitions):
    size_shuffles(spark, partitions - 1)
    assert int(spark.conf.get(PARTITIONS)) == partitions
    size_shuffles(spark, partitions + 5)
    assert int(spark.conf.get(PARTITIONS)) == partitions + 5


@pytest.mark.parametrize("read", [lambda t: t.order_lines, lambda t: t.raw_pricing], ids=["lines", "prices"])
def test_all_shuffles_of_the_lines_grow_with_them(spark, no_broadcast, monkeypatch, partitions, read):  # noqa: F811
    """The joins with the products and the groups of prices too, not only the tables' buckets."""
    monkeypatch.setattr(testdata, "LINES_PER_BUCKET", 500)
    parts = -(-spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() // 500)
    assert parts > partitions
    text = plan(read(testdata.StarTables(spark, FOLDER)))
    assert f", {parts})" in text and f", {partitions})" not in text


@pytest.mark.parametrize("name", ["seasonal_intelligence", "landed_cost_analysis", "returns_analysis"])
def test_names_of_markets_are_not_moved_with_the_facts(spark, no_broadcast, name):  # noqa: F811
    """The join with the products, which may shuffle the facts, comes before that with the markets."""
    text = plan(view_builders("2001-08-01")[name](loaded_tables(spark, FOLDER)))
    assert text.index("hashpartitioning(market_id") < text.index("hashpartitioning(product_id")


def test_shipments_go_back_to_their_buckets_while_narrow(spark, no_broadcast):  # noqa: F811
    """Products that are not broadcast move the lines, and not the texts and figures of the shipments."""
    source = testdata.StarTables(spark, FOLDER)
    house = Warehouse(spark, source, FOLDER)
    source.stage = house.stage
    text = plan(house.source["fact_shipment_details"])
    back = text[text.index("Exchange hashpartitioning(order_id"):]
    assert "weight_kg" in back and "shipping_line" not in back and "freight_cost_usd" not in back
    assert house["fact_shipment_details"].count() > 0


def test_lines_are_moved_without_texts(spark, no_broadcast):  # noqa: F811
    """The shuffle by product has ids, the price and two packed numbers; flags and small figures are not columns of their own."""
    rows = plan(testdata.StarTables(spark, FOLDER).order_lines).splitlines()
    moved = next(i for i, row in enumerate(rows) if "hashpartitioning(l_partkey" in row)
    columns = next(row for row in rows[moved:] if "Project [" in row).partition("Project [")[2]
    assert " AS _placed#" in columns and " AS _terms#" in columns
    taken = {c.strip(" ,[").partition("#")[0] for c in columns.split(", ")}
    assert not {"l_linenumber", "o_orderstatus", "l_linestatus", "l_returnflag"} & taken


def test_packed_numbers_come_back(spark):
    """Extremes of the types, zero and null in every place."""
    some = {"number": [None, 0, 7, *INT], "day": [None, 0, *DAY]}
    rows = [(n, d) for n in some["number"] for d in some["day"]]
    df = spark.createDataFrame(rows, "number int, day int")
    packed = testdata.PLACED.pack({"number": F.col("number"), "day": F.col("day")})
    got = df.select("number", "day", *[testdata.PLACED.get(packed, c).alias(f"_{c}") for c in some]).collect()
    assert len(got) == 20 and all((r.number, r.day) == (r._number, r._day) for r in got)
    terms = {"quantity": F.col("number"), "discount": F.lit(-99999), "status": F.lit(3), "done": F.lit(None).cast("boolean"), "returned": F.lit(True)}
    back = df.select("number", *[testdata.TERMS.get(testdata.TERMS.pack(terms), c).alias(c) for c in terms]).collect()
    assert all(tuple(r) == (r.number, r.number, -99999, 3, None, 1) for r in back)
    with pytest.raises(ValueError):
        Packing(a=INT, b=INT)


def test_lines_with_nulls_keep_them(spark, tmp_path):
    """A line without number, quantity, discount or flags, and an order without date or status, come through as they are."""
    full = dict(l_orderkey=1, l_partkey=1, l_suppkey=1, l_linenumber=2, l_quantity=3.0, l_extendedprice=30.0, l_discount=0.07,
                l_tax=0.0, l_returnflag="R", l_linestatus="F", l_shipdate=None)
    lines = [full, full | {"l_linenumber": None}, full | {"l_linenumber": 3, "l_quantity": None}, full | {"l_linenumber": 4, "l_discount": None},
             full | {"l_linenumber": 9, "l_returnflag": None, "l_linestatus": None}, full | {"l_orderkey": 2, "l_linenumber": 5}]
    orders = [(1, 1, "F", 1.0, dt.datetime(1996, 11, 30), "x"), (2, 1, None, 1.0, None, "x")]
    for name, data in (("lineitem", [tuple(x.values()) for x in lines]), ("orders", orders), ("customer", [(1, "c", 0, 1.0, "s")]),
                       ("part", [(1, "p", "Brand#1", "t", 1, 100.0)]), ("nation", None), ("region", None)):
        like = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        (spark.createDataFrame(data, like.schema) if data else like).write.parquet(f"{tmp_path}/{name}.parquet")
    got = testdata.StarTables(spark, str(tmp_path)).fact_export_orders.select(
        "order_id", "order_date", "quantity_units", "discount_pct", "order_status", "is_repeat_order")
    key = lambda k, n: (k * 8 + n) << testdata.COPY_BITS
    day = dt.date(1996, 11, 30)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (key(1, 2), day, 3, D("7.00"), "Delivered", "Y"),
        (None, day, 3, D("7.00"), "Delivered", "N"),
        (key(1, 3), day, None, D("7.00"), "Delivered", "Y"),
        (key(1, 4), day, 3, None, "Delivered", "Y"),
        (key(1, 9), day, 3, D("7.00"), "Delivered", "N"),
        (key(2, 5), None, 3, D("7.00"), "Processing", "N"),
    ], key=str)
    source = testdata.StarTables(spark, str(tmp_path))
    assert sorted(r.order_id for r in source.raw_shipments.collect() if r.order_id) == [key(1, n) for n in (2, 3, 4)]
    assert sorted(r.order_id for r in source.raw_returns.collect() if r.order_id) == [key(1, n) for n in (2, 3, 4)]


def test_markets_are_broadcast_beside_many_partitions(spark):
    """25 markets fill less than a fifth of 200 partitions; the lines are not shuffled by market for that."""
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = {key: spark.conf.get(key) for key in (PARTITIONS, broadcast, FILLED)}
    try:
        # Estimated larger than this and found smaller, and Spark's default for the share of partitions filled.
        for key, value in ((PARTITIONS, "200"), (broadcast, "20000"), (FILLED, "0.2")):
            spark.conf.set(key, value)
        df = testdata.StarTables(spark, FOLDER).order_lines.select("order_id", "market_id", "exchange_rate_on_date")
        assert "SortMergeJoin [market_id" in plan(df)
        assert len(df.collect()) > 0
        final = plan(df).partition("Initial Plan")[0]
        assert "SortMergeJoin [market_id" not in final and final.count("hashpartitioning(market_id") == 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
