"""Views on hand-made rows: missing facts, fan-out, boundaries, ties."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exportlens.plans import analysis as A
from exportlens.plans import labels as L
from exportlens.plans import view_builders
from exportlens.plans import views as V
from exportlens.plans.report import REPORT_ORDER, report_order
from exportlens.sources.schemas import SCHEMAS


def table(spark, name: str, *records: dict) -> DataFrame:
    """Rows of a star table; columns not given are NULL."""
    schema = SCHEMAS[name]
    for field in schema.fields:
        field.nullable = True

    def value(field, record):
        x = record.get(field.name)
        return D(x) if field.dataType.typeName() == "decimal" and x is not None else x

    return spark.createDataFrame([tuple(value(f, r) for f in schema.fields) for r in records], schema)


def order(order_id, **kw):
    base = dict(order_id=order_id, order_date=dt.date(2024, 1, 10), product_id="P1", market_id="M1", customer_id="C1",
                quantity_units=10, discount_pct="0.00", net_fob_price_usd="10.0000", total_fob_value_usd="100.00",
                total_fob_value_inr="8000.00", gross_profit_inr="4000.00", total_cogs_inr="4000.00", gross_margin_pct="50.00",
                exchange_rate_on_date="80.0000", payment_terms_days=30, payment_delay_days=0, payment_status="Paid On Time",
                order_channel="Amazon", order_status="Delivered", fiscal_year=2024, quarter="Q1", month_num=1,
                month_name="January", is_repeat_order="Y")
    return base | kw


def shipment(shipment_id, order_id, **kw):
    base = dict(shipment_id=shipment_id, order_id=order_id, product_id="P1", market_id="M1", customer_id="C1", is_delayed="N",
                delay_days=0, shipping_line="L", port_of_loading="A", port_of_discharge="B", container_type="X", delay_reason="None",
                declared_value_usd="100.00", freight_cost_usd="4.00", insurance_usd="1.00", customs_duty_usd="5.00",
                port_handling_usd="2.00", last_mile_usd="3.00", demurrage_charges_usd="10.00", total_landed_cost_usd="115.00",
                landed_to_fob_ratio="1.1500", total_transit_days=20, customs_clearance_days=3, exporter_net_margin_usd="95.00")
    return base | kw


def ret(return_id, order_id, **kw):
    base = dict(return_id=return_id, order_id=order_id, product_id="P1", market_id="M1", customer_id="C1", return_quantity=1,
                return_reason="Damaged", refund_amount_usd="7.00", return_shipping_cost_usd="1.00", net_loss_usd="8.00", days_to_return=9)
    return base | kw


@pytest.fixture(scope="module")
def dims(spark):
    scores = dict(home_decor_demand_score="8.0", market_entry_ease_score="8.0", regulatory_ease_score="8.0",
                  indian_craft_affinity_score="8.0", ecommerce_maturity_score="8.0", gdp_per_capita_usd=65000,
                  market_size_usd_mn="100.00", avg_customs_duty_pct="5.00", composite_score="8.00", payment_risk_score="3.0")
    return {
        "dim_markets": table(spark, "dim_markets", dict(market_id="M1", country="Here", region="Europe", currency="EUR", **scores),
                             dict(market_id="M2", country="Empty", region="Africa", currency="ZAR", **scores)),
        "dim_products": table(spark, "dim_products", dict(product_id="P1", product_name="Lamp", category="Decor", subcategory="Light"),
                              dict(product_id="P2", product_name="Unsold", category="Decor", subcategory="Light")),
        "dim_customers": table(spark, "dim_customers", dict(customer_id="C1", country="Here"), dict(customer_id="C2", country="Empty")),
    }


def test_dimension_rows_without_facts_stay(spark, dims):
    orders, ships = table(spark, "fact_export_orders", order(1)), table(spark, "fact_shipment_details", shipment(1, 1))
    rets, prices = table(spark, "fact_returns", ret(1, 1)), table(spark, "fact_competitor_pricing")
    empty = V.market_entry_readiness(dims["dim_markets"], orders, ships, rets).where("country = 'Empty'").first()
    assert empty.total_orders == 0 and empty.avg_lc_fob_ratio == 0 and empty.return_loss_usd == 0
    # 8 * 0.92 + 10 * 0.08
    assert empty.weighted_priority_score == D("8.16")
    unsold = V.product_export_scorecard(dims["dim_products"], orders, ships, rets, prices).where("product_id = 'P2'").first()
    assert unsold.total_orders is None and unsold.total_returns == 0 and unsold.export_viability_tag == L.REVIEW_PRODUCT
    lost = V.customer_ltv(dims["dim_customers"], orders, rets, "2024-02-09").where("customer_id = 'C2'").first()
    assert (lost.recency_score, lost.frequency_score, lost.buyer_health_tag) == (1, 1, L.BUYER_STANDARD)
    assert lost.days_since_last_order is None and lost.total_returns == 0
    kept = V.customer_ltv(dims["dim_customers"], orders, rets, "2024-02-09").where("customer_id = 'C1'").first()
    assert kept.days_since_last_order == 30 and kept.recency_score == 5


def test_master_summary_equals_the_row_join(spark):
    """Several shipments and returns per order: the weighted form gives what the plain join gives."""
    orders = table(spark, "fact_export_orders", order(1), order(2, gross_margin_pct="20.00", payment_status="Overdue", customer_id="C2"),
                   order(3, order_status="Cancelled"), order(4, market_id="M2", gross_margin_pct=None), order(5, quantity_units=None))
    ships = table(spark, "fact_shipment_details", *[shipment(i, 1, total_transit_days=10 + i) for i in range(3)],
                  shipment(7, 2, demurrage_charges_usd=None), shipment(8, 3), shipment(9, 4, total_transit_days=None))
    rets = table(spark, "fact_returns", ret(1, 1), ret(2, 1, net_loss_usd="3.00"), ret(3, 2), ret(4, 3))
    joined = (orders.where("order_status != 'Cancelled'")
              .join(ships.select("order_id", "shipment_id", "total_transit_days", "demurrage_charges_usd"), "order_id", "left")
              .join(rets.select("order_id", "return_id", "net_loss_usd"), "order_id", "left"))
    overdue = F.when(F.col("payment_status") == "Overdue", F.col("total_fob_value_usd"))
    want = joined.agg(
        F.sum("total_fob_value_usd"), F.round(F.avg("gross_margin_pct"), 2), F.count("order_id"), F.sum("quantity_units"),
        F.countDistinct("customer_id"), F.count(overdue), F.sum(overdue), F.countDistinct("shipment_id"),
        F.round(F.avg("total_transit_days"), 1), F.sum("demurrage_charges_usd"), F.countDistinct("return_id"), F.sum("net_loss_usd"),
    ).first()
    got = V.master_summary(orders, ships, rets).select(
        "total_revenue_usd", "avg_gross_margin_pct", "total_orders", "total_units_exported", "total_buyers", "overdue_orders",
        "overdue_value_usd", "total_shipments", "avg_transit_days", "total_demurrage_usd", "total_returns", "total_return_loss_usd",
    ).first()
    assert [float(x) for x in got] == [float(x) for x in want]
    assert V.master_summary(orders, ships, rets, label="All").first().summary_level == "All"


def test_landed_cost_guards_and_bands(spark, dims):
    orders = table(spark, "fact_export_orders", order(1), order(2, quantity_units=0), order(3, product_id="P2"))
    ships = table(spark, "fact_shipment_details", shipment(1, 1, landed_to_fob_ratio="1.3000"), shipment(2, 2, landed_to_fob_ratio="1.3000"),
                  shipment(3, 3, product_id="P2", landed_to_fob_ratio="1.3001"))
    got = {r.product_name: r for r in V.landed_cost_analysis(ships, orders, dims["dim_markets"], dims["dim_products"]).collect()}
    lamp = got["Lamp"]
    assert lamp.total_shipments == 2 and lamp.avg_freight_per_unit_usd == D("0.4000")  # zero quantity skipped
    assert lamp.route_efficiency == L.MODERATE_COST and got["Unsold"].route_efficiency == L.HIGH_COST_ROUTE
    assert lamp.avg_exporter_margin_pct == D("95.00") and lamp.freight_pct_of_lc == D("3.5")


def test_delay_bands_use_the_unrounded_rate(spark, dims):
    ships = table(spark, "fact_shipment_details", *[
        shipment(i, 1, container_type=kind, is_delayed="Y" if i % 8 < late else "N", delay_days=4)
        for kind, late in (("a", 2), ("b", 3), ("c", 1), ("d", 0)) for i in range(8)])
    got = {r.container_type: r for r in V.shipment_delay(ships, dims["dim_markets"]).collect()}
    assert [got[k].performance_flag for k in "abcd"] == [L.DELAY_WARNING, L.DELAY_CRITICAL, L.DELAY_WARNING, L.DELAY_FINE]
    assert got["d"].avg_delay_days is None and got["a"].avg_delay_days == D("4.0") and got["a"].delay_rate_pct == D("25.00")


@pytest.mark.parametrize("index, tag", [("115.0", L.FINE_TUNE), ("115.1", L.OVERPRICED), ("110.0", L.OPTIMALLY_PRICED), ("95.0", L.OPTIMALLY_PRICED),
                                        ("94.9", L.FINE_TUNE), ("85.0", L.FINE_TUNE), ("84.9", L.UNDERPRICED)])
def test_price_bands(spark, dims, index, tag):
    price = dict(date=dt.date(2024, 1, 1), product_id="P1", market_id="M1", our_price_usd="10.00", avg_competitor_price_usd="0.00", our_price_index=index)
    row = V.competitor_benchmark(table(spark, "fact_competitor_pricing", price), dims["dim_markets"], dims["dim_products"]).first()
    assert row.pricing_recommendation == tag and row.price_gap_usd == D("10.00") and row.price_gap_pct is None


def test_price_gap_with_missing_competitor(spark, dims):
    base = dict(product_id="P1", market_id="M1", our_price_index="100.0")
    prices = table(spark, "fact_competitor_pricing", dict(base, date=dt.date(2024, 1, 1), our_price_usd="10.00", avg_competitor_price_usd="8.00"),
                   dict(base, date=dt.date(2024, 1, 2), our_price_usd="11.00"))
    row = V.competitor_benchmark(prices, dims["dim_markets"], dims["dim_products"]).first()
    assert (row.price_gap_usd, row.price_gap_pct, row.data_points) == (D("2.50"), D("31.25"), 2)


def test_returns_mode_and_bands(spark, dims):
    orders = table(spark, "fact_export_orders", order(1), order(2, order_status="Shipped"), order(3, product_id="P2"))
    rets = table(spark, "fact_returns", ret(1, 1, return_reason="Wrong"), ret(2, 1, return_reason="Damaged", net_loss_usd="0.00"),
                 ret(3, 3, product_id="P2", net_loss_usd="8.01", return_reason=None), ret(4, 9, market_id="M2"))
    got = {r.product_name: r for r in V.returns_analysis(rets, dims["dim_markets"], dims["dim_products"], orders).collect()}
    assert set(got) == {"Lamp", "Unsold"}  # no delivered order in M2
    lamp = got["Lamp"]
    assert (lamp.total_orders, lamp.total_returns, lamp.return_rate_pct, lamp.top_return_reason) == (1, 2, D("200.00"), "Damaged")
    assert lamp.return_risk_flag == L.RETURNS_ELEVATED and got["Unsold"].return_risk_flag == L.RETURNS_CRITICAL
    assert got["Unsold"].top_return_reason is None


def test_forex_without_rate(spark, dims):
    orders = table(spark, "fact_export_orders", order(1), order(2, market_id="M2"), order(3, month_num=12), order(4, order_status="Cancelled"))
    rates = table(spark, "dim_forex_rates", *[dict(date=dt.date(2024, 1, d), currency_code="EUR", rate_to_inr=r, month=1, year=2024)
                                              for d, r in ((1, "70.0000"), (2, "71.0000"))])
    got = {(r.currency, r.month): r for r in V.forex_impact(orders, dims["dim_markets"], rates).collect()}
    assert len(got) == 3
    assert got["EUR", 1].benchmark_rate == D("70.5000") and got["EUR", 1].forex_gain_loss_inr == D("950.00")
    assert got["EUR", 1].forex_impact_pct == D("13.48") and got["EUR", 1].forex_direction == L.FOREX_GAIN
    for key in (("ZAR", 1), ("EUR", 12)):
        assert got[key].benchmark_rate is None and got[key].forex_direction == L.FOREX_LOSS


def test_payment_bands_and_dso(spark, dims):
    orders = table(spark, "fact_export_orders", order(1, payment_delay_days=-5), order(2, payment_delay_days=25),
                   order(3, market_id="M2", payment_delay_days=20), order(4, market_id="M2", payment_delay_days=21, payment_status="Overdue"))
    got = {r.country: r for r in V.payment_risk(orders, dims["dim_markets"]).collect()}
    assert got["Here"].avg_dso_days == D("42.5") and got["Here"].payment_risk_flag == L.RISK_LOW
    assert got["Empty"].payment_risk_flag == L.RISK_HIGH and got["Empty"].overdue_value_usd == D("100.00")


def test_seasonal_rank_ties(spark, dims):
    orders = table(spark, "fact_export_orders", order(1), order(2, month_num=12, month_name="December"),
                   order(3, month_num=7, month_name="July", total_fob_value_usd="50.00"))
    got = {r.month_num: r for r in V.seasonal_intelligence(orders, dims["dim_markets"], dims["dim_products"]).collect()}
    assert [got[m].revenue_rank_in_year for m in (1, 12, 7)] == [1, 1, 3]
    assert [got[m].season_tag for m in (1, 12, 7)] == [L.SEASON_PEAK, L.SEASON_PEAK, L.SEASON_SLOW]


def test_category_mix(spark, dims):
    orders = table(spark, "fact_export_orders", order(1), order(2, product_id="P2", total_fob_value_usd="200.00"), order(3, order_status="Cancelled"))
    row = V.category_mix(orders, dims["dim_products"]).first()
    assert (row.product_count, row.total_orders, row.revenue_share_pct, row.hhi_contribution) == (2, 2, D("100.00"), D("10000.00"))


def test_analysis_rollups(spark):
    yearly = spark.createDataFrame([(2023, 1, D("100.00"), 1, D("50.00")), (2023, 2, D("100.00"), 1, D("51.00")), (2024, 1, D("150.00"), 2, None),
                                    (None, 1, D("1.00"), 1, D("1.00"))],
                                   "fiscal_year int, month_num int, total_revenue_usd decimal(26,2), total_orders long, avg_gross_margin_pct decimal(10,2)")
    got = [tuple(r) for r in A.yearly_growth(yearly).orderBy("fiscal_year").collect()]
    assert got == [(2023, D("200.00"), 2, 50.5, None), (2024, D("150.00"), 2, None, D("-25.0"))]
    season = spark.createDataFrame([("A", m, n, D(r)) for m, n, r in ((1, "Jan", "5"), (2, "Feb", "9"), (3, "Mar", "1"), (4, "Apr", "7"))] + [("B", 1, "Jan", D("3"))],
                                   "country string, month_num int, month_name string, total_revenue_usd decimal(26,2)")
    months = {r.country: (r.peak_months, r.slow_months) for r in A.peak_slow_months(season, markets=2, k=2).collect()}
    assert months == {"A": ("Feb, Apr", "Jan, Mar"), "B": ("Jan", "Jan")}


def test_report_order(spark):
    assert set(view_builders("2024-12-31")) == set(REPORT_ORDER)
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, total_revenue_usd int")
    ids = lambda name: [r.id for r in report_order(df, name).collect()]
    assert ids("customer_ltv") == [3, 2, 1] and ids("category_mix") == [1, 3, 2]
    assert report_order(df, "master_summary") is df
