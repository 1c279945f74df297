"""Analysis operators on view output: scores, rankings, rollups, trends and chart data.

Every operator takes view DataFrames and returns a DataFrame. Rollups of view rows are deliberately
two-level: they average the already rounded, unweighted rows of the view. Sums run over decimals, so
a mean is one exact sum and one division. Row groups with a NULL key are left out and the sum of
only missing values is 0, as in the report this mirrors. Ranked cuts end with a unique key.

A view used by several operators is worth materialising once by the caller (``load_table`` or
``checkpoint``); its rows number as the dimensions, not as the facts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.functions import (
    as_double,
    band,
    bin_right,
    clamp,
    count_when,
    dec,
    mean,
    mean_double,
    ordered_join,
    pct,
    rate_pct,
    round_half_even,
    round_mean,
    round_ratio,
    scale_units,
    short_text,
    tag_contains,
)
from exportlens.operators.aggregates import arg_max, arg_min, drop_null, pivot, unpivot
from exportlens.operators.enrich import TIER_EDGES
from exportlens.operators.ranking import growth_pct, rank_rollup, running_total, top_k_per, top_n
from exportlens.operators.relative import (
    histogram,
    min_max_scale,
    ratio_to_max,
    ratio_of,
    ratio_to_mean,
    scaled_to,
    share_of_total,
    with_total,
    with_totals,
)
from exportlens.plans import labels as L
from exportlens.sources.warehouse import written
from exportlens.plans.views import (
    GDP_WEIGHT,
    PEAK_MONTHS,
    PRIORITY_WEIGHTS,
    RAMP_MONTHS,
    SLOW_MONTHS,
    not_cancelled,
)

# Score columns and their report labels.
SCORE_LABELS = {
    "home_decor_demand_score": "Demand",
    "indian_craft_affinity_score": "Craft Affinity",
    "market_entry_ease_score": "Entry Ease",
    "ecommerce_maturity_score": "E-comm",
    "regulatory_ease_score": "Regulatory",
}
# Cost components and their report labels.
COMPONENT_LABELS = {
    "avg_freight": "Freight",
    "avg_insurance": "Insurance",
    "avg_customs": "Customs",
    "avg_port": "Port",
    "avg_last_mile": "Last Mile",
}
# Required labels.
STATUS_LABELS = {
    "paid_on_time": "Paid On Time", "paid_late": "Paid Late", "pending": "Pending", "overdue": "Overdue",
}


def _total(x: Column | str) -> Column:
    """Aggregate: sum that is 0 for a group of missing values."""
    return F.coalesce(F.sum(x), F.lit(0))


def _by(df: DataFrame, *keys: str):
    """Group by keys, rows with a missing key left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys)


# --- market scoring -------------------------------------------------------------------------


def score_markets(v2: DataFrame, weights: dict[str, Decimal] = PRIORITY_WEIGHTS) -> DataFrame:
    """Readiness view plus gdp_score, final_score, revenue_potential, priority_score, entry_tier.

    The view is evaluated once and written, one row per market; all set measures come from one pass over that.
    """
    v2 = written(v2)
    gdp, size = dec("gdp_per_capita_usd", 20, 0), dec("market_size_usd_mn", 20, 2)
    df = with_totals(v2, v2, {"_lo": F.min(gdp), "_hi": F.max(gdp), "_most": F.max(size)})
    df = df.withColumn("gdp_score", dec(scaled_to(gdp, F.col("_lo"), F.col("_hi"), 1, 10, digits=2, scale=0), 5, 2))
    parts = [F.col(c) * F.lit(w) for c, w in weights.items()] + [F.col("gdp_score") * F.lit(GDP_WEIGHT)]
    df = df.withColumn("final_score", dec(round_half_even(sum(parts[1:], parts[0]), 2), 5, 2))
    df = df.withColumn("revenue_potential", dec(ratio_of(size, F.col("_most"), 10, digits=2, scale=2), 5, 2)).drop("_lo", "_hi", "_most")
    blend = F.col("final_score") * F.lit(Decimal("0.65")) + F.col("revenue_potential") * F.lit(Decimal("0.35"))
    return df.withColumns({
        "priority_score": dec(round_half_even(blend, 2), 5, 2),
        "entry_tier": bin_right("final_score", TIER_EDGES, L.ENTRY_TIERS),
    })


def market_ranking(scored: DataFrame) -> DataFrame:
    """Markets by falling priority with their position."""
    return rank_rollup(scored, "priority_score", ["market_id"]).select(
        "rank", "market_id", "country", "region", "final_score", "priority_score", "entry_tier",
        "market_size_usd_mn",
    )


def tier_markets(scored: DataFrame, tier: str) -> DataFrame:
    """Markets of one entry tier."""
    return scored.where(F.col("entry_tier") == tier).select(
        "market_id", "country", "entry_tier", "final_score", "home_decor_demand_score",
        "indian_craft_affinity_score", "avg_customs_duty_pct", "market_size_usd_mn",
    )


def best_markets(v2: DataFrame) -> DataFrame:
    """Largest market, best craft affinity, lowest customs duty."""
    return v2.agg(
        arg_max("country", "market_size_usd_mn", "market_id").alias("best_revenue_potential"),
        arg_max("country", "indian_craft_affinity_score", "market_id").alias("best_craft_affinity"),
        arg_min("country", "avg_customs_duty_pct", "market_id").alias("lowest_customs_duty"),
    )


def score_breakdown(scored: DataFrame, n: int = 5) -> DataFrame:
    """Component scores of the n best markets, one row per score."""
    top = top_n(scored, [F.col("priority_score").desc_nulls_last(), F.col("market_id")], n)
    return unpivot(
        top, ["market_id", "country"], SCORE_LABELS, variable="score_name", value="score", value_type="decimal(4,1)"
    )


def score_size_points(scored: DataFrame) -> DataFrame:
    """Score against market size with the bubble size of each point."""
    df = ratio_to_max(scored, "market_size_usd_mn", 1800, plus=80, digits=4, name="bubble_size")
    return df.select("market_id", "country", "final_score", "market_size_usd_mn", "entry_tier", "bubble_size")


def entry_cost_heatmap(v2: DataFrame) -> DataFrame:
    """Customs, transit and score scaled to 0..1 over all markets."""
    df = v2.select("market_id", "country", "avg_customs_duty_pct", "avg_transit_days_from_india", "composite_score")
    return min_max_scale(df, {
        "avg_customs_duty_pct": "customs_scaled",
        "avg_transit_days_from_india": "transit_scaled",
        "composite_score": "score_scaled",
    })


# --- landed cost ----------------------------------------------------------------------------

# Rollup column -> view column
_MARKET_MEANS = {
    "avg_fob": "avg_fob_per_unit_usd",
    "avg_freight": "avg_freight_per_unit_usd",
    "avg_insurance": "avg_insurance_per_unit_usd",
    "avg_customs": "avg_customs_per_unit_usd",
    "avg_port": "avg_port_per_unit_usd",
    "avg_last_mile": "avg_lastmile_per_unit_usd",
    "avg_demurrage": "avg_demurrage_per_unit_usd",
    "avg_total_lc": "avg_total_lc_per_unit_usd",
    "avg_lc_fob_ratio": "avg_lc_fob_ratio",
    "avg_exporter_margin": "avg_exporter_margin_pct",
}
_CATEGORY_MEANS = {
    "avg_fob": "avg_fob_per_unit_usd",
    "avg_total_lc": "avg_total_lc_per_unit_usd",
    "avg_lc_fob_ratio": "avg_lc_fob_ratio",
    "avg_exporter_margin": "avg_exporter_margin_pct",
    "freight_pct": "freight_pct_of_lc",
    "customs_pct": "customs_pct_of_lc",
    "lastmile_pct": "lastmile_pct_of_lc",
}


def margin_band(margin: Column | str, hi: int = 70, lo: int = 60) -> Column:
    """Traffic light of an exporter margin."""
    margin = F.col(margin) if isinstance(margin, str) else margin
    return band([(margin > hi, "green"), (margin > lo, "amber")], "red")


def landed_cost_rollup(v4: DataFrame) -> DataFrame:
    """Market means of the landed-cost rows, four digits, before ranking."""
    return _by(v4, "country", "region").agg(
        *[mean(col, 4, scale=4, even=True).alias(name) for name, col in _MARKET_MEANS.items()],
        _total("total_demurrage_usd").cast("decimal(26,2)").alias("total_demurrage"),
        _total("total_shipments").alias("total_shipments"),
    )


def landed_cost_by_market(v4: DataFrame) -> DataFrame:
    """Market means ranked by exporter margin, with the margin's traffic light."""
    rollup = landed_cost_rollup(v4)
    ranked = rank_rollup(rollup, "avg_exporter_margin", ["country", "region"])
    return ranked.withColumn("margin_band", margin_band("avg_exporter_margin"))


def landed_cost_by_category(v4: DataFrame) -> DataFrame:
    """Category means of the landed-cost rows, two digits."""
    return _by(v4, "category").agg(
        *[mean(col, 2, scale=4, even=True).alias(name) for name, col in _CATEGORY_MEANS.items()]
    )


def demurrage_hotspots(v4: DataFrame, n: int = 5) -> DataFrame:
    """Markets with the largest demurrage."""
    order = [F.col("total_demurrage").desc_nulls_last(), F.col("country"), F.col("region")]
    return top_n(landed_cost_rollup(v4), order, n, rank="rank").select(
        "rank", "country", "region", "total_demurrage", "total_shipments", "avg_demurrage"
    )


def high_cost_routes(v4: DataFrame, n: int = 10) -> DataFrame:
    """Market and product rows with the highest landed-cost ratio."""
    order = [F.col("avg_lc_fob_ratio").desc_nulls_last(), F.col("country"), F.col("product_name")]
    return top_n(v4, order, n, rank="rank").select(
        "rank", "country", "category", short_text("product_name", 28).alias("product_name"),
        "avg_fob_per_unit_usd", "avg_total_lc_per_unit_usd", "avg_lc_fob_ratio", "avg_exporter_margin_pct",
    )


def cost_components(v4: DataFrame, n: int = 10) -> DataFrame:
    """Stacked cost components of the n best-margin markets with the base under each."""
    order = [F.col("avg_exporter_margin").desc_nulls_last(), F.col("country"), F.col("region")]
    top = top_n(landed_cost_rollup(v4), order, n)
    long = unpivot(top, ["country", "region"], COMPONENT_LABELS, variable="component", value="cost",
                   value_type="decimal(18,4)")
    position = F.array_position(F.array(*[F.lit(x) for x in COMPONENT_LABELS.values()]), F.col("component"))
    long = long.withColumn("step", position.cast("int"))
    return running_total(long, "step", "cost", part=["country", "region"], inclusive=False, name="base")


def cost_waterfall(v4: DataFrame) -> DataFrame:
    """Seven steps from FOB to net: bar height and the base it stands on.

    The first and the last bar stand on 0; a cost hangs from the running total before it.
    """
    exact = lambda c: round_mean(F.sum(c), F.count(c), 10, scale=4)
    means = v4.agg(*[exact(_MARKET_MEANS[c]).alias(c) for c in ["avg_fob", *COMPONENT_LABELS]])
    net = F.col("avg_fob")
    for cost in COMPONENT_LABELS:
        net = net - F.col(cost)
    means = means.withColumn("net", net)
    signed = means.select("avg_fob", *[(-F.col(c)).alias(c) for c in COMPONENT_LABELS], "net")
    labels = {"avg_fob": "FOB", **COMPONENT_LABELS, "net": "Net LC"}
    long = unpivot(signed, [], labels, variable="label", value="value", value_type="decimal(24,10)")
    position = F.array_position(F.array(*[F.lit(x) for x in labels.values()]), F.col("label"))
    steps = running_total(long.withColumn("step", position.cast("int")), "step", "value", name="_after")
    edge = F.col("step").isin(1, len(labels))
    # A falling bar stands on the total after it, a rising one on the total before it.
    inner = F.when(F.col("value") < 0, F.col("_after")).otherwise(F.col("_after") - F.col("value"))
    return steps.select(
        "step", "label", as_double("value").alias("value"), as_double(F.abs("value")).alias("height"),
        as_double(F.when(edge, F.lit(0)).otherwise(inner)).alias("base"),
    )


# --- products -------------------------------------------------------------------------------


def top_products(v3: DataFrame, n: int = 15) -> DataFrame:
    """Products by export revenue."""
    order = [F.col("total_revenue_usd").desc_nulls_last(), F.col("product_id")]
    return top_n(v3, order, n, rank="rank").select(
        "rank", "product_id", short_text("product_name", 37).alias("product_name"), "category",
        "total_revenue_usd", "avg_margin_pct", "markets_present", "export_viability_tag",
    )


def viability_list(v3: DataFrame, word: str) -> DataFrame:
    """Products whose viability tag contains a word, such as Star, Growth or Review."""
    return v3.where(tag_contains("export_viability_tag", word)).select(
        "product_id", "product_name", "total_revenue_usd", "avg_margin_pct", "markets_present"
    )


def viability_counts(v3: DataFrame) -> DataFrame:
    """Number of star, growth and review products."""
    has = lambda word: count_when(tag_contains("export_viability_tag", word))
    return v3.agg(
        has("Star").alias("star_products"), has("Growth").alias("growth_products"),
        has("Review").alias("review_products"),
    )


def pricing_counts(v7: DataFrame) -> DataFrame:
    """Number of over-, under- and optimally priced combinations."""
    has = lambda word: count_when(tag_contains("pricing_recommendation", word))
    return v7.agg(
        has("Overpriced").alias("overpriced"), has("Underpriced").alias("underpriced"),
        has("Optimally").alias("optimally_priced"),
    )


def top_underpriced(v7: DataFrame, n: int = 5) -> DataFrame:
    """Underpriced combinations with the largest (least negative) price gap."""
    order = [F.col("price_gap_pct").desc_nulls_last(), F.col("country"), F.col("product_name")]
    low = v7.where(tag_contains("pricing_recommendation", "Underpriced"))
    return top_n(low, order, n, rank="rank").select(
        "rank", "country", short_text("product_name", 30).alias("product_name"), "our_avg_price_usd",
        "avg_market_price_usd", "price_gap_pct",
    )


def margin_revenue_points(v3: DataFrame) -> DataFrame:
    """Margin against revenue with a bubble for the number of markets."""
    df = ratio_to_max(v3, "markets_present", 400, plus=50, digits=4, scale=0, name="bubble_size")
    return df.select(
        "product_id", "avg_margin_pct", "total_revenue_usd", "export_viability_tag", "bubble_size"
    )


def revenue_mix(v14: DataFrame) -> DataFrame:
    """Share of revenue of every category and subcategory row, one digit."""
    df = share_of_total(written(v14), "total_revenue_usd", 1, name="pie_share_pct")
    return df.select(
        "category", "subcategory", "total_revenue_usd", "revenue_share_pct", "avg_margin_pct",
        "product_count", "markets_served", "pie_share_pct",
    )


def price_index_histogram(v7: DataFrame, bins: int = 30) -> DataFrame:
    """Distribution of the mean price index in equal bins."""
    return histogram(drop_null(v7.select("avg_price_index"), "avg_price_index"), "avg_price_index", bins)


def category_margin_bands(v14: DataFrame) -> DataFrame:
    """Margin of each category row with its band, lowest first."""
    margin = F.col("avg_margin_pct")
    return v14.select(
        "category", "subcategory", "avg_margin_pct",
        band([(margin >= 55, "green"), (margin >= 45, "amber")], "red").alias("margin_band"),
    ).orderBy("avg_margin_pct", "category", "subcategory")


# --- demand and seasonality -----------------------------------------------------------------


def season_tag(month: Column | str) -> Column:
    """Season of a month number in the trend report."""
    month = F.col(month) if isinstance(month, str) else month
    return band(
        [(month.isin(*PEAK_MONTHS), L.TREND_PEAK), (month.isin(*RAMP_MONTHS), L.TREND_RAMP),
         (month.isin(*SLOW_MONTHS), L.TREND_SLOW)],
        L.TREND_NORMAL,
    )


def monthly_revenue_trend(orders: DataFrame) -> DataFrame:
    """Monthly revenue, orders, units and mean margin without cancelled orders, with the season."""
    monthly = not_cancelled(orders).groupBy("fiscal_year", "month_num", "month_name", "quarter").agg(
        F.sum("total_fob_value_usd").cast("decimal(26,2)").alias("revenue_usd"),
        F.count("order_id").alias("total_orders"),
        F.sum("quantity_units").alias("total_units"),
        mean_double("gross_margin_pct").alias("avg_margin"),
    )
    return monthly.withColumn("season", season_tag("month_num"))


def _growth_rollup(v11: DataFrame, *keys: str) -> DataFrame:
    return _by(v11, *keys).agg(
        mean_double("avg_yoy_growth_pct").alias("avg_yoy_growth"),
        mean_double("avg_trends_score").alias("avg_trends"),
        _total("total_demand_units").alias("total_demand"),
        _total("total_search_volume").alias("total_search"),
    )


def fastest_growing_markets(v11: DataFrame, n: int = 10) -> DataFrame:
    """Markets by mean search growth."""
    order = [F.col("avg_yoy_growth").desc_nulls_last(), F.col("country"), F.col("region")]
    return top_n(_growth_rollup(v11, "country", "region"), order, n, rank="rank")


def top_seasonal_markets(v13: DataFrame, n: int = 5) -> DataFrame:
    """Countries by revenue over all months and categories."""
    sums_ = _by(v13, "country").agg(_total("total_revenue_usd").cast("decimal(30,2)").alias("total_revenue_usd"))
    return top_n(sums_, [F.col("total_revenue_usd").desc(), F.col("country")], n)


def peak_slow_months(v13: DataFrame, markets: int = 5, k: int = 3) -> DataFrame:
    """Best and worst months of the top markets, as ordered strings.

    One monthly rollup, evaluated once, serves the choice of the markets and both ends of their months.
    """
    monthly = written(_by(v13, "country", "month_num", "month_name").agg(_total("total_revenue_usd").alias("_rev")))
    chosen = top_n(
        monthly.groupBy("country").agg(F.sum("_rev").alias("_all")),
        [F.col("_all").desc(), F.col("country")], markets,
    ).select("country")
    kept = monthly.join(chosen, "country", "left_semi")
    falling = [F.col("_rev").desc(), F.col("month_num")]
    rising = [F.col("_rev").asc(), F.col("month_num").desc()]
    best = top_k_per(kept, ["country"], falling, k).groupBy("country").agg(
        ordered_join("month_name", "rank").alias("peak_months")
    )
    # The tail of the falling order keeps that order, so the worst month comes last.
    worst = top_k_per(kept, ["country"], rising, k).groupBy("country").agg(
        ordered_join("month_name", -F.col("rank")).alias("slow_months")
    )
    return best.join(worst, "country")


def demand_by_category(v11: DataFrame) -> DataFrame:
    """Search growth and demand per category, with the length of its text bar."""
    df = _growth_rollup(v11, "category").select("category", "avg_yoy_growth", "avg_trends", "total_demand")
    bar = clamp((F.col("avg_yoy_growth") / 2).cast("int"), 0, 30)
    return df.withColumn("bar_length", bar)


def revenue_by_month_pivot(trend: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One revenue column per year by month, with the peak-season flag."""
    if years is None:  # the columns are every year of the data; the rollup, a row per month, is evaluated once and read
        trend = written(trend)
        years = trend.agg(F.array_sort(F.collect_set("fiscal_year"))).first()[0]
    wide = pivot(trend, "month_num", "fiscal_year", {y: f"revenue_{y}" for y in years}, F.sum("revenue_usd"))
    return wide.withColumn("is_peak", F.col("month_num").isin(*PEAK_MONTHS))


def seasonality_index(trend: DataFrame) -> DataFrame:
    """Month mean over the mean of the month means, with its band."""
    monthly = _by(trend, "month_num").agg(
        round_mean(F.sum("revenue_usd"), F.count("revenue_usd"), 6).alias("mean_revenue_usd")
    )
    df = ratio_to_mean(monthly, "mean_revenue_usd", name="seasonality_index")
    index = F.col("seasonality_index")
    return df.select(
        "month_num", as_double("mean_revenue_usd").alias("mean_revenue_usd"), "seasonality_index",
        band([(index >= 1.1, "green"), (index >= 0.95, "amber")], "red").alias("index_band"),
    )


def growth_by_country(v11: DataFrame, n: int = 10) -> DataFrame:
    """The n fastest growing countries with their band."""
    grown = _by(v11, "country").agg(mean_double("avg_yoy_growth_pct").alias("avg_yoy"))
    growth = F.col("avg_yoy")
    top = top_n(grown, [growth.desc_nulls_last(), F.col("country")], n)
    return top.withColumn("growth_band", band([(growth > 20, "green"), (growth > 10, "amber")], "orange"))


# --- executive summary ----------------------------------------------------------------------


def yearly_growth(v1: DataFrame) -> DataFrame:
    """Revenue, orders and mean monthly margin per year with growth on the year before."""
    yearly = _by(v1, "fiscal_year").agg(
        _total("total_revenue_usd").cast("decimal(30,2)").alias("revenue"),
        _total("total_orders").alias("orders"),
        mean_double("avg_gross_margin_pct").alias("avg_margin"),
    )
    return growth_pct(yearly, "fiscal_year", "revenue", digits=1, name="growth_pct")


def top_markets(v2: DataFrame, n: int = 5) -> DataFrame:
    """Markets by revenue."""
    order = [F.col("total_revenue_usd").desc_nulls_last(), F.col("market_id")]
    return top_n(v2, order, n, rank="rank").select(
        "rank", "market_id", "country", "region", "total_revenue_usd", "avg_margin_pct", "unique_buyers",
        "delay_rate_pct", "weighted_priority_score",
    )


def channel_rollup(v10: DataFrame) -> DataFrame:
    """Channel revenue and the unweighted means of its quarterly rates."""
    return _by(v10, "order_channel").agg(
        _total("total_revenue_usd").cast("decimal(30,2)").alias("revenue"),
        mean_double("avg_margin_pct").alias("avg_margin"),
        mean_double("avg_order_value_usd").alias("avg_aov"),
        mean_double("repeat_rate_pct").alias("repeat_rate"),
        mean_double("cancellation_rate_pct").alias("cancel_rate"),
    )


def payment_risk_summary(v12: DataFrame) -> DataFrame:
    """Number of high-risk markets, overdue value and mean DSO."""
    return v12.agg(
        count_when(tag_contains("payment_risk_flag", "High")).alias("high_risk_markets"),
        _total("overdue_value_usd").cast("decimal(30,2)").alias("total_overdue_usd"),
        mean_double("avg_dso_days").alias("avg_dso_days"),
    )


def high_risk_markets(v12: DataFrame) -> DataFrame:
    """High-risk markets with overdue value and mean delay."""
    return v12.where(tag_contains("payment_risk_flag", "High")).select(
        "country", "region", "overdue_value_usd", "avg_delay_days"
    )


def return_loss_share(v8: DataFrame, v15: DataFrame) -> DataFrame:
    """Total return loss and its share of master revenue."""
    total = v8.agg(_total("total_return_loss_usd").cast("decimal(28,2)").alias("total_return_loss_usd"))
    df = with_total(total, v15, F.max("total_revenue_usd"), "total_revenue_usd")
    return df.withColumn("loss_pct_of_revenue", pct("total_return_loss_usd", "total_revenue_usd", 2))


def top_return_reasons(v8: DataFrame, n: int = 3) -> DataFrame:
    """Returns by the modal reason of their market and product row."""
    reasons = _by(v8, "top_return_reason").agg(_total("total_returns").alias("total_returns"))
    return top_n(reasons, [F.col("total_returns").desc(), F.col("top_return_reason")], n, rank="rank")


def delay_rollup(v6: DataFrame) -> DataFrame:
    """Shipments, delayed shipments, demurrage and delay rate per country."""
    return _by(v6, "country").agg(
        _total("total_shipments").alias("total_ships"),
        _total("delayed_shipments").alias("delayed_ships"),
        _total("total_demurrage_usd").cast("decimal(30,2)").alias("total_dem"),
    ).withColumn(
        "delay_pct",
        round_mean(F.col("delayed_ships").cast("decimal(18,0)") * 100, "total_ships", 2, scale=0, even=True),
    )


def delay_by_market(v6: DataFrame, n: int = 3) -> DataFrame:
    """The n most delayed countries next to the overall rate and demurrage."""
    top = top_n(delay_rollup(v6), [F.col("delay_pct").desc_nulls_last(), F.col("country")], n, rank="rank")
    late, all_ = _total("delayed_shipments").cast("decimal(18,0)"), _total("total_shipments")
    top = with_total(top, v6, round_mean(late * 100, all_, 1, scale=0, even=True), "overall_delay_pct")
    return with_total(top, v6, _total("total_demurrage_usd").cast("decimal(30,2)"), "overall_demurrage_usd")


def payment_distribution(v12: DataFrame) -> DataFrame:
    """Orders and share per payment status."""
    totals = v12.agg(*[_total(c).alias(c) for c in STATUS_LABELS])
    whole = sum((F.col(c) for c in list(STATUS_LABELS)[1:]), F.col("paid_on_time"))
    totals = totals.withColumn("_all", whole)
    long = unpivot(totals, ["_all"], STATUS_LABELS, variable="payment_status", value="orders", value_type="bigint")
    return long.select("payment_status", "orders", rate_pct("orders", "_all", 1).alias("share_pct"))


def return_loss_by_market(v8: DataFrame, n: int = 10) -> DataFrame:
    """Countries by return loss."""
    losses = _by(v8, "country").agg(
        _total("total_return_loss_usd").cast("decimal(30,2)").alias("total_return_loss_usd")
    )
    return top_n(losses, [F.col("total_return_loss_usd").desc(), F.col("country")], n, rank="rank")


def kpi_tiles(v15: DataFrame) -> DataFrame:
    """Eight headline numbers: label, value scaled to its unit, unit."""
    tiles = [
        ("Total Revenue", scale_units("total_revenue_usd", "billion"), "USD billion"),
        ("Gross Margin", round_ratio("avg_gross_margin_pct", F.lit(1), 1), "%"),
        ("Total Orders", F.col("total_orders"), ""),
        ("Active Markets", F.col("markets_active"), ""),
        ("Active Buyers", F.col("total_buyers"), ""),
        ("Avg Transit", F.col("avg_transit_days"), "days"),
        ("Total Returns", F.col("total_returns"), ""),
        ("Demurrage Cost", scale_units("total_demurrage_usd", "million"), "USD million"),
    ]
    cells = [
        F.struct(F.lit(i).alias("tile"), F.lit(label).alias("label"),
                 value.cast("decimal(24,2)").alias("value"), F.lit(unit).alias("unit"))
        for i, (label, value, unit) in enumerate(tiles, 1)
    ]
    return v15.select(F.inline(F.array(*cells)))
