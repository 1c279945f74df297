"""Bucketed tables, batches, scans with rejects, file statistics."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from exportlens.plans import view_builders
from exportlens.registry import QUERIES, loaded_tables
from exportlens.sources import tables as T
from exportlens.sources import testdata
from exportlens.sources.batches import BatchTable
from exportlens.sources.bucketed import write_bucketed
from exportlens.sources.rejects import reject_report, scan_with_rejects
from exportlens.sources.schemas import SCHEMAS
from exportlens.sources.statistics import file_extremes, file_row_counts, footer_scan
from exportlens.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- buckets --------------------------------------------------------------------------------


def test_bucketed_join_moves_no_row(spark, tmp_path, no_broadcast):
    left = write_bucketed(spark.range(1000).withColumn("a", F.col("id") * 2), "left_side", str(tmp_path / "l"), ["id"], 4)
    right = write_bucketed(spark.range(500).withColumn("b", F.col("id") + 1), "right_side", str(tmp_path / "r"), ["id"], 4)
    joined = left.join(right, "id")
    assert "Exchange" not in plan(joined) and joined.count() == 500
    grouped = left.groupBy("id").agg(F.sum("a"))
    assert "Exchange" not in plan(grouped) and grouped.count() == 1000
    again = write_bucketed(spark.range(10).withColumn("a", F.lit(1)), "left_side", str(tmp_path / "l"), ["id"], 4)
    assert again.count() == 10
    with pytest.raises(ValueError):
        write_bucketed(left, "no name; really", str(tmp_path / "x"), ["id"])


def test_fact_joins_by_order_move_no_fact(spark, no_broadcast):
    """Both joins on the order find their rows in place; only the groups and the dimensions are shuffled."""
    tables, views = loaded_tables(spark, FOLDER), view_builders("2001-08-01")
    for name in ("fact_export_orders", "fact_shipment_details", "fact_returns"):
        assert tables[name].count() > 0
    for name in ("landed_cost_analysis", "master_summary"):
        assert "hashpartitioning(order_id" not in plan(views[name](tables))


def test_orders_are_a_projection_of_the_staged_lines(spark):
    tables = loaded_tables(spark, FOLDER)
    assert tables["fact_export_orders"].columns == SCHEMAS["fact_export_orders"].fieldNames()
    assert tables["fact_export_orders"].count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()


def test_lines_are_dealt_once_and_by_their_number(spark, no_broadcast, monkeypatch):
    """Counting, numbering and the join with the orders share one shuffle; parts grow with the lines, not with the session."""
    monkeypatch.setattr(testdata, "LINES_PER_BUCKET", 500)
    source = testdata.StarTables(spark, FOLDER)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert source.buckets == -(-lines // 500) > 8
    assert plan(source.lines).count("Exchange hashpartitioning") == 1
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    joined = plan(source.lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    assert joined.count("Exchange hashpartitioning") == 2
    house = Warehouse(spark, source, FOLDER)
    source.stage = house.stage
    for name in ("fact_export_orders", "fact_shipment_details", "fact_returns"):
        assert f"SelectedBucketsCount: {source.buckets} out of {source.buckets}" in plan(house[name].groupBy("order_id").count())
    assert house["fact_export_orders"].count() == lines == source.lines.count()


def test_row_counts_hold_every_customer(spark):
    """Those that order and are not on file are rows of the source too."""
    counts = {r.table_name: r.row_count for r in QUERIES["row_counts"](spark, FOLDER).collect()}
    assert counts["dim_customers"] == spark.read.parquet(f"{FOLDER}/customer.parquet").count()
    assert counts["fact_export_orders"] == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()


# --- batches --------------------------------------------------------------------------------


def returns(spark, first, last, year=2023):
    columns = {"return_id": F.col("id"), "return_year": F.lit(year), "net_loss_usd": F.lit(D("1.50"))}
    return spark.range(first, last).select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS["fact_returns"].fields])


def test_repeated_and_failed_batches_change_nothing(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "fact_returns")
    assert table.read().count() == 0 and table.row_count().first().row_count == 0
    assert table.append(returns(spark, 0, 10), "2024-01") and table.append(returns(spark, 10, 30), "2024-02")
    assert not table.append(returns(spark, 0, 10), "2024-01") and table.read().count() == 30

    broken = returns(spark, 30, 60).repartition(5).withColumn(
        "return_quantity", F.when(F.col("return_id") == 55, F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).cast("int"))
    with pytest.raises(Exception, match="broken"):
        table.append(broken, "2024-03")
    assert table.read().count() == 30 and table.row_count().first().row_count == 30
    assert table.append(returns(spark, 30, 60), "2024-03")
    assert table.read().select("return_id").distinct().count() == table.read().count() == table.row_count().first().row_count == 60
    assert table.read("2024-02").agg(F.min("return_id"), F.max("return_id")).first()[:] == (10, 29)
    assert sorted(r["batch_id"] for r in table.manifest().collect()) == ["2024-01", "2024-02", "2024-03"]


def test_shipments_and_prices_move_narrow(spark):
    """The HSN code is looked up as narrowly as the weight; products are joined before the prices are dealt, with the figures made after."""
    source = testdata.StarTables(spark, FOLDER)
    width = lambda df: int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    part = source.raw("part")
    text = part.select("p_partkey", F.format_string("%08d", F.col("p_partkey")).alias("hsn_code"))
    number = part.select("p_partkey", testdata._hsn_number(F.col("p_partkey")).alias("hsn_code"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", (width(text) + width(number)) // 2)
        assert "hashpartitioning(product_id" not in plan(source.fact_shipment_details)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        prices = plan(source.fact_competitor_pricing)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt, joined = prices.index("Exchange rangepartitioning"), prices.index("Exchange hashpartitioning(product_id")
    assert dealt < joined  # the deal is nearer the root
    assert "competitor1_price_usd" not in prices[dealt:]


def test_figures_of_a_line_need_its_order_key_in_the_id_only(spark):
    """Keys up to 2^39, line numbers and copies: the order key is had back from the order id."""
    rows = [(k, n, c) for k in (0, 1, 7, 12345, 2**39) for n in (1, 7, 8, 12) for c in (0, 1, testdata.COPIES - 1)]
    df = spark.createDataFrame(rows, "k long, n int, c long")
    order_id = (F.col("k") * 8 + F.col("n")) * testdata.COPIES + F.col("c")
    back = df.select("k", testdata.order_key(order_id, F.col("n")).alias("got"))
    assert all(r.k == r.got for r in back.collect())


def test_batches_of_two_writers_and_odd_names(spark, tmp_path):
    one, two = (BatchTable(spark, str(tmp_path / "t"), "fact_returns") for _ in range(2))
    assert one.append(returns(spark, 0, 5), "b") and not two.append(returns(spark, 0, 5), "b") and two.read().count() == 5
    with pytest.raises(ValueError):
        one.append(returns(spark, 0, 5), "../b")
    assert one.append(returns(spark, 0, 0), "empty") and one.read().count() == 5


# --- rejects --------------------------------------------------------------------------------

RATES = "date,currency_code,currency_pair,rate_to_inr,daily_change_pct,month,year,quarter\n"


def test_scan_with_rejects(spark, tmp_path):
    path = tmp_path / "rates.csv"
    good = ["2024-01-01,USD,USD/INR,83.5,0.0,1,2024,Q1", "2024-01-02,EUR,,,,,,", '2024-01-03,GBP,"GBP, INR",100.25,-0.5,1,2024,Q1']
    bad = {
        "not a date,USD,USD/INR,83.5,0.0,1,2024,Q1": ["date: not a date"],
        ",USD,USD/INR,83.5,0.0,1,2024,Q1": ["date: missing"],
        "2024-02-30,USD,USD/INR,83.5,0.0,1,2024,Q1": ["date: not a date"],
        "2024-01-04,USD,USD/INR,many,0.0,x,2024,Q1": ["rate_to_inr: not a decimal", "month: not a integer"],
        "2024-01-05,USD,USD/INR,12345678.5,0.00001,1,2024,Q1": ["rate_to_inr: does not fit", "daily_change_pct: does not fit"],
        "2024-01-06,DOLLARS,USD/INR,1,0.0,1,2024,Q1": ["currency_code: too long"],
        "2024-01-07,USD": ["fields"],
        "2024-01-08,USD,USD/INR,1,0.0,1,2024,Q1,more": ["fields"],
    }
    path.write_text(RATES + "\n".join([*good, *bad]) + "\n")
    rows, rejects = scan_with_rejects(spark, str(path), "dim_forex_rates")
    got = {r.currency_code: r for r in rows.collect()}
    assert set(got) == {"USD", "EUR", "GBP"} and got["USD"].rate_to_inr == D("83.5000") and got["EUR"].rate_to_inr is None
    assert got["GBP"].currency_pair == "GBP, INR"
    assert [f.dataType for f in rows.schema] == [f.dataType for f in SCHEMAS["dim_forex_rates"]]
    assert {r.line: r.reasons for r in rejects.collect()} == bad
    report = {r.reason: r.row_count for r in reject_report(rejects).collect()}
    assert report["fields"] == 2 and report["date: not a date"] == 2 and sum(report.values()) == 10


def test_scan_with_rejects_of_an_empty_file(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text(RATES)
    rows, rejects = scan_with_rejects(spark, str(path), "dim_forex_rates")
    assert rows.count() == 0 and rejects.count() == 0 and reject_report(rejects).count() == 0


# --- statistics -----------------------------------------------------------------------------


def test_footers_answer_counts_and_extremes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") - 50).cast("int").alias("x"))
    df.repartition(3).write.parquet(path)
    scan = footer_scan(spark, path, df.schema)
    assert "PushedAggregation: [COUNT(*)]" in plan(scan.agg(F.count("*")))
    assert "PushedAggregation: [COUNT(*), COUNT(x), MIN(x), MAX(x)]" in plan(scan.agg(F.count("*"), F.count("x"), F.min("x"), F.max("x")))
    assert [tuple(r) for r in file_row_counts({"t": scan}).collect()] == [("t", 100)]
    assert sorted(tuple(r) for r in file_extremes(scan, ["id", "x"]).collect()) == [("id", 100, 100, 0, 99), ("x", 100, 66, -49, 48)]
    assert "BatchScan" not in plan(spark.read.parquet(path))
    T.write_csv(scan.limit(1), str(tmp_path / "out"))
