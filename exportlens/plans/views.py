"""The fifteen KPI views.

Each view is a function of the tables it reads. Facts are filtered and, where ids are few, aggregated by id before
any dimension is attached; where ids are nearly unique (prices, seasons, landed cost) the names are attached first. The
two fact-to-fact joins (landed cost and master summary) are on the key that the facts are bucketed by. Aggregates are sums and counts, which combine on the map side; that also
defuses a key holding a large part of a fact. Averages divide once, at the end, exactly.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.functions import (
    band,
    count_when,
    days_since,
    dec,
    mean,
    money_sum,
    pct,
    rate_pct,
    round_mean,
    round_ratio,
    scale_units,
    sum_when,
)
from exportlens.operators.aggregates import (
    merge_states,
    mode_of,
    money_ratio_pct,
    sums,
    unit_ratio,
    with_distinct_counts,
    zero_fill,
)
from exportlens.operators.distinct import distinct_counts, join_counts
from exportlens.operators.enrich import GDP_REFERENCE
from exportlens.operators.ranking import rank_over_agg
from exportlens.operators.relative import with_total, with_totals
from exportlens.plans import labels as L
from exportlens.sources.warehouse import written

# Months of the season tags.
PEAK_MONTHS, RAMP_MONTHS, SLOW_MONTHS = (11, 12, 1), (9, 10), (6, 7, 8)

# Weights of the priority score; the GDP term is gdp / 65000 * 10 and may exceed 10.
PRIORITY_WEIGHTS = {
    "home_decor_demand_score": Decimal("0.25"),
    "indian_craft_affinity_score": Decimal("0.20"),
    "market_entry_ease_score": Decimal("0.18"),
    "ecommerce_maturity_score": Decimal("0.17"),
    "regulatory_ease_score": Decimal("0.12"),
}
GDP_WEIGHT = Decimal("0.08")


def _versus(total: Column | str, count: Column | str, limit: str) -> tuple[Column, Column]:
    """Both sides of ``total / count`` against ``limit``, compared without dividing.

    The widths are stated because Spark gives up fraction digits when it widens two large decimals
    to a common type.
    """
    return dec(total, 26, 4), dec(count, 16, 0) * F.lit(Decimal(limit))


def _above(total: Column | str, count: Column | str, limit: str) -> Column:
    ours, bound = _versus(total, count, limit)
    return ours > bound


def _below(total: Column | str, count: Column | str, limit: str) -> Column:
    ours, bound = _versus(total, count, limit)
    return ours < bound


def not_cancelled(orders: DataFrame) -> DataFrame:
    """Orders that count as business; an order without status is left out too."""
    return orders.where("order_status != 'Cancelled'")


def _loss_by(returns: DataFrame, key: str) -> DataFrame:
    return returns.groupBy(key).agg(
        F.count("return_id").alias("total_returns"),
        money_sum("net_loss_usd").alias("return_loss_usd"),
    )


# --- revenue --------------------------------------------------------------------------------


def executive_revenue(orders: DataFrame) -> DataFrame:
    """Monthly revenue dashboard over all orders, cancelled ones included."""
    repeat = F.col("is_repeat_order") == "Y"
    overdue = F.col("payment_status") == "Overdue"
    aggs = [
        F.count("order_id").alias("total_orders"),
        F.sum("quantity_units").alias("total_units_sold"),
        money_sum("total_fob_value_usd").alias("total_revenue_usd"),
        money_sum("total_fob_value_inr").alias("total_revenue_inr"),
        money_sum("total_cogs_inr").alias("total_cogs_inr"),
        money_sum("gross_profit_inr").alias("total_gross_profit_inr"),
        mean("gross_margin_pct", 2).alias("avg_gross_margin_pct"),
        round_mean(F.sum("total_fob_value_usd"), F.count("order_id"), 2).alias("avg_order_value_usd"),
        count_when(repeat).alias("repeat_orders"),
        rate_pct(count_when(repeat), F.count("order_id")).alias("repeat_order_rate_pct"),
        count_when(F.col("order_status") == "Cancelled").alias("cancelled_orders"),
        count_when(overdue).alias("overdue_payments"),
        sum_when(overdue, "total_fob_value_usd").cast("decimal(26,2)").alias("overdue_value_usd"),
    ]
    return with_distinct_counts(
        orders, ["fiscal_year", "quarter", "month_num", "month_name"], aggs,
        {"active_buyers": "customer_id", "markets_active": "market_id"},
    )


def channel_performance(orders: DataFrame) -> DataFrame:
    """Channel by year and quarter, all orders."""
    repeat = F.col("is_repeat_order") == "Y"
    cancelled = F.col("order_status") == "Cancelled"
    aggs = [
        F.count("order_id").alias("total_orders"),
        F.sum("quantity_units").alias("total_units"),
        money_sum("total_fob_value_usd").alias("total_revenue_usd"),
        money_sum("gross_profit_inr").alias("total_gp_inr"),
        mean("gross_margin_pct", 2).alias("avg_margin_pct"),
        mean("discount_pct", 2).alias("avg_discount_pct"),
        round_mean(F.sum("total_fob_value_usd"), F.count("order_id"), 2).alias("avg_order_value_usd"),
        count_when(repeat).alias("repeat_orders"),
        rate_pct(count_when(repeat), F.count("order_id")).alias("repeat_rate_pct"),
        count_when(F.col("payment_status") == "Overdue").alias("overdue_orders"),
        count_when(cancelled).alias("cancelled_orders"),
        rate_pct(count_when(cancelled), F.count("order_id")).alias("cancellation_rate_pct"),
    ]
    return with_distinct_counts(
        orders, ["order_channel", "fiscal_year", "quarter"], aggs,
        {"unique_customers": "customer_id", "markets_reached": "market_id"},
    )


def category_mix(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue share and concentration per category and subcategory.

    Share and concentration both come from the unrounded share.
    """
    live = not_cancelled(orders)
    keys, names = ["category", "subcategory"], products.select("product_id", "category", "subcategory")
    # The fact is reduced to one row per product before it meets a name; the total is that of these rows.
    by_product = written(live.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"), F.count("gross_margin_pct").alias("_margin_n"),
        *sums(total_units="quantity_units", total_revenue_usd="total_fob_value_usd", total_gp_inr="gross_profit_inr", _margin="gross_margin_pct"),
    ))
    grouped = by_product.join(names, "product_id").groupBy(*keys).agg(
        F.count("product_id").alias("product_count"),
        *sums(total_orders="total_orders", total_units="total_units"),
        money_sum("total_revenue_usd").alias("total_revenue_usd"), money_sum("total_gp_inr").alias("total_gp_inr"),
        round_mean(F.sum("_margin"), F.sum("_margin_n"), 2).alias("avg_margin_pct"),
    )
    categorised = live.select("product_id", "market_id", "customer_id").join(names, "product_id")
    grouped = join_counts(grouped, distinct_counts(categorised, keys, {"markets_served": "market_id", "unique_buyers": "customer_id"}), keys)
    with_sum = with_total(grouped, by_product, money_sum("total_revenue_usd"), "_total")
    share = pct("total_revenue_usd", "_total", 2)
    # The squared share keeps 15 digits of the fraction, more than a double square would.
    fraction = round_ratio("total_revenue_usd", "_total", 15)
    hhi = dec(fraction, 17, 15) * dec(fraction, 17, 15) * F.lit(Decimal(10000))
    return with_sum.withColumns({
        "revenue_share_pct": share,
        "hhi_contribution": dec(F.round(hhi, 2), 12, 2),
    }).drop("_total")


def seasonal_intelligence(orders: DataFrame, markets: DataFrame, products: DataFrame) -> DataFrame:
    """Monthly revenue per country and category, ranked inside the year."""
    # Ids are nearly unique per row here, so the names are attached first and one aggregate remains. Products, which may
    # shuffle the orders, come before the markets' names; of the order id only whether there is one is moved.
    live = not_cancelled(orders).select(
        "market_id", "product_id", "month_num", "month_name", "fiscal_year",
        F.when(F.col("order_id").isNotNull(), F.lit(1)).alias("_order"),
        "quantity_units", "total_fob_value_usd", "gross_margin_pct",
    )
    named = live.join(products.select("product_id", "category"), "product_id").join(
        markets.select("market_id", "country", "region"), "market_id"
    )
    keys = ["country", "region", "category", "month_num", "month_name", "fiscal_year"]
    df = named.groupBy(*keys).agg(
        F.count("_order").alias("total_orders"),
        *sums(total_units="quantity_units", total_revenue_usd="total_fob_value_usd", _margin="gross_margin_pct"),
        F.count("gross_margin_pct").alias("_margin_n"),
    )
    df = rank_over_agg(
        df, ["country", "category", "fiscal_year"], F.col("total_revenue_usd").desc_nulls_first(),
        rank="revenue_rank_in_year",
    )
    return df.select(
        *keys, "total_orders", "total_units",
        dec("total_revenue_usd", 26, 2).alias("total_revenue_usd"),
        round_mean("_margin", "_margin_n", 2).alias("avg_margin_pct"),
        "revenue_rank_in_year",
        band(
            [
                (F.col("month_num").isin(*PEAK_MONTHS), L.SEASON_PEAK),
                (F.col("month_num").isin(*RAMP_MONTHS), L.SEASON_RAMP),
                (F.col("month_num").isin(*SLOW_MONTHS), L.SEASON_SLOW),
            ],
            L.SEASON_NORMAL,
        ).alias("season_tag"),
    )


# --- markets, products, customers -----------------------------------------------------------


def priority_score(weights: dict[str, Decimal] = PRIORITY_WEIGHTS, gdp_weight: Decimal = GDP_WEIGHT) -> Column:
    """Weighted score of a market, rounded once over the common denominator of the GDP term."""
    parts = [F.col(c) * F.lit(w) for c, w in weights.items()]
    scores = sum(parts[1:], parts[0])
    reference = F.lit(Decimal(GDP_REFERENCE))
    gdp = dec("gdp_per_capita_usd", 10, 0) * F.lit(gdp_weight * 10)
    return round_ratio(scores * reference + gdp, reference, 2, scale=4)


def market_entry_readiness(
    markets: DataFrame, orders: DataFrame, shipments: DataFrame, returns: DataFrame
) -> DataFrame:
    """Every market with its scores, revenue, logistics and returns; 0 where it has no facts."""
    delayed = F.col("is_delayed") == "Y"
    revenue = not_cancelled(orders).groupBy("market_id").agg(
        F.count("order_id").alias("total_orders"),
        money_sum("total_fob_value_usd").alias("total_revenue_usd"),
        mean("gross_margin_pct", 2).alias("avg_margin_pct"),
        F.countDistinct("customer_id").alias("unique_buyers"),
    )
    logistics = shipments.groupBy("market_id").agg(
        mean("total_transit_days", 1, scale=0).alias("avg_transit_days"),
        mean("landed_to_fob_ratio", 4, scale=4).alias("avg_lc_fob_ratio"),
        money_sum("demurrage_charges_usd").alias("total_demurrage_usd"),
        rate_pct(count_when(delayed), F.count("*")).alias("delay_rate_pct"),
    )
    measures = [
        "total_orders", "total_revenue_usd", "avg_margin_pct", "unique_buyers", "avg_transit_days",
        "avg_lc_fob_ratio", "total_demurrage_usd", "delay_rate_pct", "total_returns", "return_loss_usd",
    ]
    joined = (
        markets.join(revenue, "market_id", "left")
        .join(logistics, "market_id", "left")
        .join(_loss_by(returns, "market_id"), "market_id", "left")
        .withColumn("weighted_priority_score", priority_score())
    )
    return zero_fill(joined, measures).select(
        "market_id", "country", "region", "currency",
        "home_decor_demand_score", "market_entry_ease_score", "regulatory_ease_score",
        "indian_craft_affinity_score", "ecommerce_maturity_score", "avg_customs_duty_pct",
        "gdp_per_capita_usd", "market_size_usd_mn", "primary_marketplace",
        "avg_transit_days_from_india", "composite_score", "market_tier", "weighted_priority_score",
        *measures,
    )


def product_export_scorecard(
    products: DataFrame, orders: DataFrame, shipments: DataFrame, returns: DataFrame, pricing: DataFrame
) -> DataFrame:
    """Every product with orders, logistics, returns, prices and a viability tag.

    Order measures stay NULL for a product never ordered; the others become 0.
    """
    aggs = [
        F.count("order_id").alias("total_orders"),
        F.sum("quantity_units").alias("total_units"),
        money_sum("total_fob_value_usd").alias("total_revenue_usd"),
        money_sum("gross_profit_inr").alias("total_gp_inr"),
        mean("gross_margin_pct", 2).alias("avg_margin_pct"),
        mean("discount_pct", 2).alias("avg_discount_pct"),
        count_when(F.col("order_status") == "Cancelled").alias("cancellations"),
        count_when(F.col("payment_status") == "Overdue").alias("overdue_count"),
    ]
    ordered = with_distinct_counts(
        orders.where("product_id IS NOT NULL"), ["product_id"], aggs,
        {"markets_present": "market_id", "unique_buyers": "customer_id"},
    )
    logistics = shipments.groupBy("product_id").agg(
        mean("landed_to_fob_ratio", 4, scale=4).alias("avg_lc_fob_ratio"),
        mean("exporter_net_margin_usd", 2).alias("avg_exporter_margin_usd"),
        money_sum("demurrage_charges_usd").alias("total_demurrage_usd"),
        rate_pct(count_when(F.col("is_delayed") == "Y"), F.count("*")).alias("delay_rate_pct"),
    )
    prices = pricing.groupBy("product_id").agg(
        mean("our_price_usd", 2).alias("avg_sell_price_usd"),
        mean("avg_competitor_price_usd", 2).alias("avg_comp_price_usd"),
        mean("our_price_index", 1, scale=1).alias("avg_price_index"),
        mean("gross_margin_on_our_price_pct", 2).alias("avg_sell_margin_pct"),
    )
    order_measures = ordered.columns[1:]
    filled = [*logistics.columns[1:], "total_returns", "return_loss_usd", *prices.columns[1:]]
    margin, reach = F.col("avg_margin_pct"), F.col("markets_present")
    tag = band(
        [
            ((margin >= 60) & (reach >= 8), L.STAR_PRODUCT),
            ((margin >= 50) & (reach >= 5), L.GROWTH_PRODUCT),
            (margin >= 35, L.VIABLE_PRODUCT),
        ],
        L.REVIEW_PRODUCT,
    )
    joined = (
        products.join(ordered, "product_id", "left")
        .join(logistics, "product_id", "left")
        .join(_loss_by(returns, "product_id"), "product_id", "left")
        .join(prices, "product_id", "left")
    )
    return zero_fill(joined, filled).select(
        "product_id", "product_name", "category", "subcategory", "fob_price_usd", "cogs_inr",
        "weight_kg", "artisan_cluster", "is_handmade", "is_sustainable",
        *order_measures, *filled, tag.alias("export_viability_tag"),
    )


def customer_ltv(
    customers: DataFrame, orders: DataFrame, returns: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Every buyer with lifetime value, recency, frequency and monetary scores and a health tag."""
    aggs = [
        F.count("order_id").alias("total_orders"),
        F.sum("quantity_units").alias("total_units"),
        money_sum("total_fob_value_usd").alias("total_revenue_usd"),
        money_sum("gross_profit_inr").alias("total_gp_inr"),
        mean("gross_margin_pct", 2).alias("avg_margin_pct"),
        mean("discount_pct", 2).alias("avg_discount"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        count_when(F.col("payment_status").isin("Overdue", "Paid Late")).alias("late_payments"),
        mean("payment_delay_days", 1, scale=0).alias("avg_payment_delay"),
    ]
    bought = with_distinct_counts(
        not_cancelled(orders).where("customer_id IS NOT NULL"), ["customer_id"], aggs,
        {"products_ordered": "product_id", "markets_ordered_from": "market_id"},
    )

    def score(x: Column, limits: list[int], at_most: bool) -> Column:
        out = F
        for points, limit in zip((5, 4, 3, 2), limits):
            out = out.when((x <= limit) if at_most else (x >= limit), F.lit(points))
        return out.otherwise(F.lit(1))

    age = days_since("last_order_date", as_of)
    revenue, delay = F.col("total_revenue_usd"), F.col("avg_payment_delay")
    tag = band(
        [
            (delay > 25, L.BUYER_HIGH_RISK),
            (F.col("total_returns") > 15, L.BUYER_HIGH_RETURNS),
            ((revenue > 200000) & (delay <= 5), L.BUYER_CHAMPION),
            (revenue > 80000, L.BUYER_LOYAL),
        ],
        L.BUYER_STANDARD,
    )
    joined = customers.join(bought, "customer_id", "left").join(
        _loss_by(returns, "customer_id"), "customer_id", "left"
    )
    return zero_fill(joined, ["total_returns", "return_loss_usd"]).select(
        "customer_id", "company_name", "customer_type", "country", "city", "customer_tier",
        "payment_terms_days", "account_manager", "total_orders", "total_units",
        "total_revenue_usd", "total_gp_inr", "avg_margin_pct", "avg_discount", "last_order_date",
        "first_order_date", age.alias("days_since_last_order"), "products_ordered",
        "markets_ordered_from", "late_payments", "avg_payment_delay", "total_returns",
        "return_loss_usd",
        score(age, [30, 60, 90, 180], True).alias("recency_score"),
        score(F.col("total_orders"), [80, 40, 20, 10], False).alias("frequency_score"),
        score(revenue, [300000, 100000, 50000, 10000], False).alias("monetary_score"),
        tag.alias("buyer_health_tag"),
    )


# --- logistics ------------------------------------------------------------------------------

# Result column -> shipment total it is the per-unit mean of.
_PER_UNIT = {
    "avg_freight_per_unit_usd": "freight_cost_usd",
    "avg_insurance_per_unit_usd": "insurance_usd",
    "avg_customs_per_unit_usd": "customs_duty_usd",
    "avg_port_per_unit_usd": "port_handling_usd",
    "avg_lastmile_per_unit_usd": "last_mile_usd",
    "avg_demurrage_per_unit_usd": "demurrage_charges_usd",
    "avg_total_lc_per_unit_usd": "total_landed_cost_usd",
    "avg_exporter_margin_per_unit_usd": "exporter_net_margin_usd",
}
# Result column -> (amount, base, digits) of a mean percentage.
_PERCENT = {
    "avg_exporter_margin_pct": ("exporter_net_margin_usd", "declared_value_usd", 2),
    "freight_pct_of_lc": ("freight_cost_usd", "total_landed_cost_usd", 1),
    "customs_pct_of_lc": ("customs_duty_usd", "total_landed_cost_usd", 1),
    "lastmile_pct_of_lc": ("last_mile_usd", "total_landed_cost_usd", 1),
}


def landed_cost_analysis(
    shipments: DataFrame, orders: DataFrame, markets: DataFrame, products: DataFrame
) -> DataFrame:
    """Per-unit cost means, shares and route efficiency per country and product.

    Means are means of shipment ratios, not ratios of totals. The fact-to-fact join carries only
    the order's quantity and price; adaptive execution splits a skewed order key.
    """
    joined = shipments.join(orders.select("order_id", "quantity_units", "net_fob_price_usd"), "order_id")
    ratios = {name: unit_ratio(col, "quantity_units") for name, col in _PER_UNIT.items()}
    ratios |= {name: money_ratio_pct(a, b) for name, (a, b, _) in _PERCENT.items()}
    aggs = [F.count("shipment_id").alias("total_shipments")]
    for name, ratio in ratios.items():
        aggs += [F.sum(ratio).alias(f"{name}_s"), F.count(ratio).alias(f"{name}_n")]
    for name in ("net_fob_price_usd", "landed_to_fob_ratio"):
        aggs += [F.sum(name).alias(f"{name}_s"), F.count(name).alias(f"{name}_n")]
    aggs.append(money_sum("demurrage_charges_usd").alias("total_demurrage_usd"))
    # Products, which may shuffle the shipments, come before the markets' names.
    named = joined.join(products.select("product_id", "category", "product_name"), "product_id").join(
        markets.select("market_id", "country", "region"), "market_id"
    )
    keys = ["country", "region", "category", "product_name"]
    df = named.groupBy(*keys).agg(*aggs)
    ratio_sum, ratio_n = "landed_to_fob_ratio_s", "landed_to_fob_ratio_n"
    return df.select(
        *keys, "total_shipments",
        round_mean("net_fob_price_usd_s", "net_fob_price_usd_n", 4, scale=4).alias("avg_fob_per_unit_usd"),
        *[round_mean(f"{n}_s", f"{n}_n", 4, scale=13).alias(n) for n in _PER_UNIT],
        *[round_mean(f"{n}_s", f"{n}_n", d, scale=17).alias(n) for n, (_, _, d) in _PERCENT.items()],
        round_mean(ratio_sum, ratio_n, 4, scale=4).alias("avg_lc_fob_ratio"),
        dec("total_demurrage_usd", 26, 2).alias("total_demurrage_usd"),
        band(
            [(_above(ratio_sum, ratio_n, "1.30"), L.HIGH_COST_ROUTE),
             (_above(ratio_sum, ratio_n, "1.15"), L.MODERATE_COST)],
            L.EFFICIENT_ROUTE,
        ).alias("route_efficiency"),
    )


def shipment_delay(shipments: DataFrame, markets: DataFrame) -> DataFrame:
    """Delay and demurrage per country, carrier, ports, container and reason."""
    route = ["shipping_line", "port_of_loading", "port_of_discharge", "container_type", "delay_reason"]
    delayed = F.col("is_delayed") == "Y"
    by_id = shipments.groupBy("market_id", *route).agg(
        F.count("shipment_id").alias("total_shipments"),
        count_when(delayed).alias("delayed_shipments"),
        F.sum(F.when(delayed, F.col("delay_days"))).alias("_delay"),
        F.count(F.when(delayed, F.col("delay_days"))).alias("_delay_n"),
        F.sum("total_transit_days").alias("_transit"),
        F.count("total_transit_days").alias("_transit_n"),
        F.sum("customs_clearance_days").alias("_customs"),
        F.count("customs_clearance_days").alias("_customs_n"),
        F.sum("demurrage_charges_usd").alias("total_demurrage_usd"),
        F.count("demurrage_charges_usd").alias("_demurrage_n"),
        F.sum("freight_cost_usd").alias("total_freight_usd"),
    )
    named = by_id.join(markets.select("market_id", "country", "region"), "market_id")
    keys = ["country", "region", *route]
    df = merge_states(named, keys, by_id.columns[1 + len(route):])
    late, all_ = F.col("delayed_shipments").cast("decimal(20,0)"), "total_shipments"
    return df.select(
        *keys, "total_shipments", "delayed_shipments",
        rate_pct("delayed_shipments", "total_shipments").alias("delay_rate_pct"),
        round_mean("_delay", "_delay_n", 1, scale=0).alias("avg_delay_days"),
        round_mean("_transit", "_transit_n", 1, scale=0).alias("avg_transit_days"),
        round_mean("_customs", "_customs_n", 1, scale=0).alias("avg_customs_days"),
        dec("total_demurrage_usd", 26, 2).alias("total_demurrage_usd"),
        round_mean("total_demurrage_usd", "_demurrage_n", 2).alias("avg_demurrage_per_shipment"),
        dec("total_freight_usd", 26, 2).alias("total_freight_usd"),
        band(
            [(_above(late, all_, "0.25"), L.DELAY_CRITICAL), (_above(late, all_, "0.12"), L.DELAY_WARNING)],
            L.DELAY_FINE,
        ).alias("performance_flag"),
    )


# --- prices, demand -------------------------------------------------------------------------


def competitor_benchmark(pricing: DataFrame, markets: DataFrame, products: DataFrame) -> DataFrame:
    """Mean prices against three competitors per country and product, with a recommendation."""
    # Result column -> (source, scale, digits)
    means = {
        "our_avg_price_usd": ("our_price_usd", 2, 2),
        "comp1_avg_price_usd": ("competitor1_price_usd", 2, 2),
        "comp2_avg_price_usd": ("competitor2_price_usd", 2, 2),
        "comp3_avg_price_usd": ("competitor3_price_usd", 2, 2),
        "avg_market_price_usd": ("avg_competitor_price_usd", 2, 2),
        "avg_price_index": ("our_price_index", 1, 1),
        "avg_landed_cost_usd": ("landed_cost_usd", 4, 4),
        "avg_gross_margin_pct": ("gross_margin_on_our_price_pct", 2, 2),
    }
    aggs = [F.count("*").alias("data_points")]
    for name, (col, _, _) in means.items():
        aggs += [F.sum(col).alias(f"{name}_s"), F.count(col).alias(f"{name}_n")]
    named = pricing.join(markets.select("market_id", "country", "region"), "market_id").join(
        products.select("product_id", "category", "subcategory", "product_name"), "product_id"
    )
    keys = ["country", "region", "category", "subcategory", "product_name"]
    df = named.groupBy(*keys).agg(*aggs)

    ours, ours_n = dec("our_avg_price_usd_s", 20, 2), F.col("our_avg_price_usd_n")
    theirs, theirs_n = dec("avg_market_price_usd_s", 20, 2), F.col("avg_market_price_usd_n")
    # With equal counts, the usual case, the difference of the means is the difference of the sums.
    gap_mean = dec(ours, 20, 2) / F.nullif(dec(ours_n, 16, 0), F.lit(0)) - dec(theirs, 20, 2) / F.nullif(
        dec(theirs_n, 16, 0), F.lit(0)
    )
    their_mean = theirs / F.nullif(dec(theirs_n, 16, 0), F.lit(0))
    same = ours_n == theirs_n
    gap = F.when(same, round_mean(ours - theirs, ours_n, 2)).otherwise(dec(F.round(gap_mean, 2), 21, 2))
    gap_pct = F.when(same, round_ratio((ours - theirs) * 100, theirs, 2)).otherwise(
        round_ratio(dec(gap_mean, 24, 10) * 100, dec(their_mean, 24, 10), 2, scale=10)
    )
    index, index_n = "avg_price_index_s", "avg_price_index_n"
    return df.select(
        *keys,
        *[round_mean(f"{n}_s", f"{n}_n", d, scale=s).alias(n) for n, (_, s, d) in means.items()],
        gap.alias("price_gap_usd"),
        gap_pct.alias("price_gap_pct"),
        band(
            [
                (_above(index, index_n, "115"), L.OVERPRICED),
                (_below(index, index_n, "85"), L.UNDERPRICED),
                (~_below(index, index_n, "95") & ~_above(index, index_n, "110"), L.OPTIMALLY_PRICED),
            ],
            L.FINE_TUNE,
        ).alias("pricing_recommendation"),
        "data_points",
    )


def demand_intelligence(demand: DataFrame, markets: DataFrame, products: DataFrame) -> DataFrame:
    """Search and demand per country, product and quarter with a growth class."""
    # Result column -> (source, scale, digits)
    means = {
        "avg_trends_score": ("google_trends_score", 1, 1),
        "avg_yoy_growth_pct": ("yoy_search_growth_pct", 2, 2),
        "avg_amazon_bsr": ("amazon_bsr", 0, 0),
        "avg_seasonality_index": ("seasonality_index", 3, 3),
    }
    totals = {
        "total_search_volume": "daily_search_volume",
        "total_social_mentions": "social_media_mentions",
        "total_demand_units": "estimated_demand_units",
    }
    aggs = sums(**totals)
    for name, (col, _, _) in means.items():
        aggs += [F.sum(col).alias(f"{name}_s"), F.count(col).alias(f"{name}_n")]
    by_id = demand.groupBy("market_id", "product_id", "fiscal_year", "quarter").agg(*aggs)
    named = by_id.join(markets.select("market_id", "country", "region"), "market_id").join(
        products.select("product_id", "category", "product_name"), "product_id"
    )
    keys = ["country", "region", "category", "product_name", "fiscal_year", "quarter"]
    df = merge_states(named, keys, by_id.columns[4:])
    growth = ("avg_yoy_growth_pct_s", "avg_yoy_growth_pct_n")
    return df.select(
        *keys, *totals,
        *[round_mean(f"{n}_s", f"{n}_n", d, scale=s).alias(n) for n, (_, s, d) in means.items()],
        band(
            [(_above(*growth, "25"), L.DEMAND_HIGH), (_above(*growth, "10"), L.DEMAND_GROWING),
             (_above(*growth, "0"), L.DEMAND_STABLE)],
            L.DEMAND_DECLINING,
        ).alias("demand_classification"),
    )


# --- returns, currency, payment -------------------------------------------------------------


def returns_analysis(
    returns: DataFrame, markets: DataFrame, products: DataFrame, orders: DataFrame
) -> DataFrame:
    """Return rate, loss and main reason per country and product that has delivered orders.

    Returns are counted per reason first, so the modal reason needs no list of a group's rows.
    """
    base = orders.where("order_status = 'Delivered'").groupBy("market_id", "product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity_units").alias("total_units_sold"),
        money_sum("total_fob_value_usd").alias("total_revenue_usd"),
    )
    by_reason = returns.groupBy("market_id", "product_id", "return_reason").agg(
        F.count("return_id").alias("total_returns"),
        F.count("*").alias("_rows"),
        F.count("days_to_return").alias("_days_n"),
        *sums(
            total_return_units="return_quantity", total_return_loss_usd="net_loss_usd",
            total_refund_usd="refund_amount_usd", total_return_ship_usd="return_shipping_cost_usd",
            _days="days_to_return",
        ),
    )
    named = (
        by_reason.join(base, ["market_id", "product_id"])
        # Products, which may shuffle the groups, come before the markets' names.
        .join(products.select("product_id", "category", "product_name"), "product_id")
        .join(markets.select("market_id", "country", "region"), "market_id")
    )
    keys = [
        "country", "region", "category", "product_name",
        "total_orders", "total_units_sold", "total_revenue_usd",
    ]
    states = by_reason.columns[3:]
    per_reason = merge_states(named, [*keys, "return_reason"], states)
    df = per_reason.groupBy(*keys).agg(
        *[F.sum(s).alias(s) for s in states],
        mode_of("return_reason", "_rows").alias("top_return_reason"),
    )
    loss, revenue = dec("total_return_loss_usd", 24, 2), dec("total_revenue_usd", 22, 2)
    over = lambda share: (revenue > 0) & (loss > revenue * F.lit(Decimal(share)))
    return df.select(
        *keys[:6], dec("total_revenue_usd", 26, 2).alias("total_revenue_usd"),
        "total_returns", "total_return_units",
        rate_pct("total_returns", "total_orders").alias("return_rate_pct"),
        dec(loss, 26, 2).alias("total_return_loss_usd"),
        dec("total_refund_usd", 26, 2).alias("total_refund_usd"),
        dec("total_return_ship_usd", 26, 2).alias("total_return_ship_usd"),
        round_mean("_days", "_days_n", 1, scale=0).alias("avg_days_to_return"),
        "top_return_reason",
        pct(loss, revenue, 2).alias("return_loss_pct_of_revenue"),
        band([(over("0.08"), L.RETURNS_CRITICAL), (over("0.04"), L.RETURNS_ELEVATED)], L.RETURNS_ACCEPTABLE)
        .alias("return_risk_flag"),
    )


def forex_impact(orders: DataFrame, markets: DataFrame, forex: DataFrame) -> DataFrame:
    """Monthly INR revenue against revenue at the month's mean rate, per currency.

    A currency without rates keeps its row with NULL comparisons.
    """
    monthly_rate = forex.groupBy(
        F.col("currency_code").alias("currency"), "year", "month"
    ).agg(
        mean("rate_to_inr", 4, scale=4).alias("benchmark_rate"),
        dec(F.max("rate_to_inr") - F.min("rate_to_inr"), 12, 4).alias("monthly_volatility"),
    )
    by_id = not_cancelled(orders).groupBy(
        F.col("fiscal_year").alias("year"), F.col("month_num").alias("month"), "market_id"
    ).agg(
        *sums(revenue_usd="total_fob_value_usd", revenue_inr_actual="total_fob_value_inr", _rate="exchange_rate_on_date"),
        F.count("exchange_rate_on_date").alias("_rate_n"),
    )
    named = by_id.join(markets.select("market_id", "currency"), "market_id")
    monthly = merge_states(named, ["year", "month", "currency"], by_id.columns[3:]).select(
        "year", "month", "currency",
        dec("revenue_usd", 20, 2).alias("revenue_usd"),
        dec("revenue_inr_actual", 22, 2).alias("revenue_inr_actual"),
        round_mean("_rate", "_rate_n", 4, scale=4).alias("avg_rate_used"),
    )
    at_benchmark = F.col("revenue_usd") * dec("benchmark_rate", 10, 4)
    gain = dec(F.col("revenue_inr_actual") - at_benchmark, 30, 6)
    return monthly.join(monthly_rate, ["currency", "year", "month"], "left").select(
        "year", "month", "currency", "revenue_usd", "revenue_inr_actual", "avg_rate_used",
        "benchmark_rate", "monthly_volatility",
        dec(F.round(at_benchmark, 2), 26, 2).alias("revenue_inr_at_benchmark"),
        dec(F.round(gain, 2), 26, 2).alias("forex_gain_loss_inr"),
        round_ratio(gain * F.lit(100), at_benchmark, 2, scale=6).alias("forex_impact_pct"),
        band([(gain > 0, L.FOREX_GAIN)], L.FOREX_LOSS).alias("forex_direction"),
    )


def payment_risk(orders: DataFrame, markets: DataFrame) -> DataFrame:
    """Payment behaviour per market, all orders."""
    statuses = {
        "paid_on_time": "Paid On Time", "paid_late": "Paid Late", "pending": "Pending", "overdue": "Overdue",
    }
    dso = F.col("payment_terms_days") + F.greatest(F.col("payment_delay_days"), F.lit(0))
    by_id = orders.groupBy("market_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_fob_value_usd").alias("total_billed_usd"),
        *[count_when(F.col("payment_status") == text).alias(name) for name, text in statuses.items()],
        sum_when(F.col("payment_status") == "Overdue", "total_fob_value_usd").alias("overdue_value_usd"),
        F.sum("payment_delay_days").alias("_delay"),
        F.count("payment_delay_days").alias("_delay_n"),
        F.sum(dso).alias("_dso"),
        F.count(dso).alias("_dso_n"),
    )
    keys = ["country", "region", "payment_risk_score", "primary_marketplace"]
    named = by_id.join(markets.select("market_id", *keys), "market_id")
    df = merge_states(named, keys, by_id.columns[1:])
    delay = (dec("_delay", 20, 0), "_delay_n")
    return df.select(
        *keys, "total_orders", dec("total_billed_usd", 26, 2).alias("total_billed_usd"), *statuses,
        dec("overdue_value_usd", 26, 2).alias("overdue_value_usd"),
        rate_pct("paid_on_time", "total_orders").alias("on_time_rate_pct"),
        round_mean("_delay", "_delay_n", 1, scale=0).alias("avg_delay_days"),
        round_mean("_dso", "_dso_n", 1, scale=0).alias("avg_dso_days"),
        band([(_above(*delay, "20"), L.RISK_HIGH), (_above(*delay, "10"), L.RISK_MODERATE)], L.RISK_LOW)
        .alias("payment_risk_flag"),
    )


# --- master summary -------------------------------------------------------------------------


def master_summary(
    orders: DataFrame, shipments: DataFrame, returns: DataFrame, label: str = "Overall"
) -> DataFrame:
    """One-row KPI summary over orders left-joined to shipments and returns on the order.

    The measures are those of the row join, in which an order with s shipments and r returns
    appears max(s,1) * max(r,1) times. Shipments and returns are first reduced to one row per
    order, so the join cannot multiply rows, and each measure is weighted by the repetitions it
    would have had. Shipment and return ids are counted apart, each repeated id once.
    """
    shipped = shipments.groupBy("order_id").agg(
        F.count("*").alias("_ships"),
        *sums(_transit="total_transit_days", _demurrage="demurrage_charges_usd"),
        F.count("total_transit_days").alias("_transit_n"),
    )
    returned = returns.groupBy("order_id").agg(
        F.count("*").alias("_returns"),
        F.sum("net_loss_usd").alias("_loss"),
    )
    once = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(1))
    live = not_cancelled(orders)
    joined = (
        live
        .join(shipped, "order_id", "left")
        .join(returned, "order_id", "left")
        .withColumns({"_s": dec(once("_ships"), 9, 0), "_r": dec(once("_returns"), 9, 0)})
        .withColumn("_w", dec(F.col("_s") * F.col("_r"), 14, 0))
    )
    w, overdue = F.col("_w"), F.col("payment_status") == "Overdue"
    money = lambda c, weight: F.sum(dec(c, 18, 2) * weight)
    present = lambda c: F.sum(F.when(F.col(c).isNotNull(), w))
    whole = lambda x: F.coalesce(x, F.lit(0)).cast("bigint")
    summary = joined.agg(
        F.lit(label).alias("summary_level"),
        money("total_fob_value_usd", w).cast("decimal(26,2)").alias("total_revenue_usd"),
        scale_units(money("total_fob_value_inr", w), "crore").alias("total_revenue_cr_inr"),
        round_mean(money("gross_margin_pct", w), present("gross_margin_pct"), 2).alias("avg_gross_margin_pct"),
        whole(present("order_id")).alias("total_orders"),
        F.sum(F.col("quantity_units") * w).cast("bigint").alias("total_units_exported"),
        whole(F.sum(F.when(overdue, w))).alias("overdue_orders"),
        F.sum(F.when(overdue, dec("total_fob_value_usd", 18, 2) * w).otherwise(F.lit(0)))
        .cast("decimal(26,2)").alias("overdue_value_usd"),
        round_mean(F.sum(F.col("_transit") * F.col("_r")), F.sum(F.col("_transit_n") * F.col("_r")), 1, scale=0)
        .alias("avg_transit_days"),
        money("_demurrage", F.col("_r")).cast("decimal(26,2)").alias("total_demurrage_usd"),
        money("_loss", F.col("_s")).cast("decimal(26,2)").alias("total_return_loss_usd"),
    )
    # Distinct ids do not depend on the repetitions of the join; they are counted on their own columns.
    of_live = lambda fact, key: fact.select("order_id", key).join(live.select("order_id"), "order_id", "left_semi")
    ids = lambda df, key: df.where(F.col(key).isNotNull()).select(key).distinct()
    # Shipment and return ids are as sparse as order ids, so they are counted as rows.
    summary = with_totals(summary, ids(of_live(shipments, "shipment_id"), "shipment_id"), {"total_shipments": F.count("shipment_id")})
    summary = with_totals(summary, ids(of_live(returns, "return_id"), "return_id"), {"total_returns": F.count("return_id")})
    return join_counts(summary, distinct_counts(
        live, [], {"total_buyers": "customer_id", "markets_active": "market_id", "products_exported": "product_id"}), [])
