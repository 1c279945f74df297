"""The fifteen KPI views as CTEs over the integer star tables; results as doubles and bigints."""

from duck_oracle.ints import avg, half_up, real, up, whole
from duck_oracle.star import CTES as STAR
from duck_oracle.star import RECENCY_AS_OF

CTES: dict[str, tuple[list[str], str]] = dict(STAR)

# view name -> CTE
VIEW = {
    "executive_revenue": "v1", "market_entry_readiness": "v2", "product_export_scorecard": "v3",
    "landed_cost_analysis": "v4", "customer_ltv": "v5", "shipment_delay": "v6",
    "competitor_benchmark": "v7", "returns_analysis": "v8", "forex_impact": "v9",
    "channel_performance": "v10", "demand_intelligence": "v11", "payment_risk": "v12",
    "seasonal_intelligence": "v13", "category_mix": "v14", "master_summary": "v15",
}


def money(col: str) -> str:
    return real(f"sum({col})", 2)


def share(pred: str, total: str = "count(*)") -> str:
    return up(f"count(*) FILTER ({pred})*100", total, 2)


def n_if(pred: str) -> str:
    return f"count(*) FILTER ({pred})"


REPEAT, OVERDUE, CANCELLED = "is_repeat = 'Y'", "payment_status = 'Overdue'", "order_status = 'Cancelled'"
LIVE = "order_status <> 'Cancelled'"

CTES["v1"] = (["o"], f"""
SELECT fiscal_year, quarter, month_num, month_name, count(*) AS total_orders, {whole("sum(qty)")} AS total_units_sold,
  {money("usd2")} AS total_revenue_usd, {money("inr2")} AS total_revenue_inr, {money("tcogs2")} AS total_cogs_inr,
  {money("gp2")} AS total_gross_profit_inr, {avg("gm2", 2, 2)} AS avg_gross_margin_pct,
  {avg("usd2", 2, 2)} AS avg_order_value_usd, {n_if(REPEAT)} AS repeat_orders,
  {share(REPEAT)} AS repeat_order_rate_pct, {n_if(CANCELLED)} AS cancelled_orders, {n_if(OVERDUE)} AS overdue_payments,
  coalesce(real_sum, 0) AS overdue_value_usd, active_buyers, markets_active
FROM o JOIN (SELECT fiscal_year, month_num, sum(usd2) FILTER ({OVERDUE})::DOUBLE/1e2 AS real_sum,
    count(DISTINCT customer_id) AS active_buyers, count(DISTINCT market_id) AS markets_active
  FROM o GROUP BY ALL) USING (fiscal_year, month_num)
GROUP BY ALL""")

CTES["v2"] = (["m", "o", "s", "r"], f"""
SELECT market_id, country, region, currency, dem1/1e1 AS home_decor_demand_score, entry1/1e1 AS market_entry_ease_score,
  reg1/1e1 AS regulatory_ease_score, craft1/1e1 AS indian_craft_affinity_score, ecom1/1e1 AS ecommerce_maturity_score,
  duty::DOUBLE AS avg_customs_duty_pct, gdp AS gdp_per_capita_usd, size_mn::DOUBLE AS market_size_usd_mn,
  marketplace AS primary_marketplace, transit AS avg_transit_days_from_india, comp2/1e2 AS composite_score, market_tier,
  {real(half_up("(dem1*25 + craft1*20 + entry1*18 + ecom1*17 + reg1*12)::BIGINT*65000 + gdp::BIGINT*800", "650000"), 2)}
    AS weighted_priority_score,
  coalesce(total_orders, 0) AS total_orders, coalesce(total_revenue_usd, 0) AS total_revenue_usd,
  coalesce(avg_margin_pct, 0) AS avg_margin_pct, coalesce(unique_buyers, 0) AS unique_buyers,
  coalesce(avg_transit_days, 0) AS avg_transit_days, coalesce(avg_lc_fob_ratio, 0) AS avg_lc_fob_ratio,
  coalesce(total_demurrage_usd, 0) AS total_demurrage_usd, coalesce(delay_rate_pct, 0) AS delay_rate_pct,
  coalesce(total_returns, 0) AS total_returns, coalesce(return_loss_usd, 0) AS return_loss_usd
FROM m
LEFT JOIN (SELECT market_id, count(*) AS total_orders, {money("usd2")} AS total_revenue_usd,
    {avg("gm2", 2, 2)} AS avg_margin_pct, count(DISTINCT customer_id) AS unique_buyers
  FROM o WHERE {LIVE} GROUP BY 1) USING (market_id)
LEFT JOIN (SELECT market_id, {avg("transit_days", 0, 1)} AS avg_transit_days, {avg("ratio4", 4, 4)} AS avg_lc_fob_ratio,
    {money("dem2")} AS total_demurrage_usd, {share("is_delayed = 'Y'")} AS delay_rate_pct
  FROM s GROUP BY 1) USING (market_id)
LEFT JOIN (SELECT market_id, count(*) AS total_returns, {money("loss2")} AS return_loss_usd
  FROM r GROUP BY 1) USING (market_id)""")

CTES["v3"] = (["p", "o", "s", "r", "pr"], f"""
SELECT product_id, product_name, category, subcategory, fob4/1e4 AS fob_price_usd, cogs2/1e2 AS cogs_inr,
  w3/1e3 AS weight_kg, artisan_cluster, is_handmade, is_sustainable, total_orders, total_units, total_revenue_usd,
  total_gp_inr, avg_margin_pct, avg_discount_pct, markets_present, unique_buyers, cancellations, overdue_count,
  coalesce(avg_lc_fob_ratio, 0) AS avg_lc_fob_ratio, coalesce(avg_exporter_margin_usd, 0) AS avg_exporter_margin_usd,
  coalesce(total_demurrage_usd, 0) AS total_demurrage_usd, coalesce(delay_rate_pct, 0) AS delay_rate_pct,
  coalesce(total_returns, 0) AS total_returns, coalesce(return_loss_usd, 0) AS return_loss_usd,
  coalesce(avg_sell_price_usd, 0) AS avg_sell_price_usd, coalesce(avg_comp_price_usd, 0) AS avg_comp_price_usd,
  coalesce(avg_price_index, 0) AS avg_price_index, coalesce(avg_sell_margin_pct, 0) AS avg_sell_margin_pct,
  CASE WHEN avg_margin_pct >= 60 AND markets_present >= 8 THEN '⭐ Star Export Product'
       WHEN avg_margin_pct >= 50 AND markets_present >= 5 THEN '📈 Growth Product'
       WHEN avg_margin_pct >= 35 THEN '✅ Viable — Optimize' ELSE '⚠️ Review — Low Margin' END AS export_viability_tag
FROM p
LEFT JOIN (SELECT product_id, count(*) AS total_orders, {whole("sum(qty)")} AS total_units, {money("usd2")} AS total_revenue_usd,
    {money("gp2")} AS total_gp_inr, {avg("gm2", 2, 2)} AS avg_margin_pct, {avg("disc", 0, 2)} AS avg_discount_pct,
    count(DISTINCT market_id) AS markets_present, count(DISTINCT customer_id) AS unique_buyers,
    {n_if(CANCELLED)} AS cancellations, {n_if(OVERDUE)} AS overdue_count
  FROM o GROUP BY 1) USING (product_id)
LEFT JOIN (SELECT product_id, {avg("ratio4", 4, 4)} AS avg_lc_fob_ratio, {avg("net2", 2, 2)} AS avg_exporter_margin_usd,
    {money("dem2")} AS total_demurrage_usd, {share("is_delayed = 'Y'")} AS delay_rate_pct
  FROM s GROUP BY 1) USING (product_id)
LEFT JOIN (SELECT product_id, count(*) AS total_returns, {money("loss2")} AS return_loss_usd FROM r GROUP BY 1) USING (product_id)
LEFT JOIN (SELECT product_id, {avg("our2", 2, 2)} AS avg_sell_price_usd, {avg("avg2", 2, 2)} AS avg_comp_price_usd,
    {avg("index1", 1, 1)} AS avg_price_index, {avg("margin2", 2, 2)} AS avg_sell_margin_pct
  FROM pr GROUP BY 1) USING (product_id)""")

# Row ratios with 18 and 21 digits, more than any engine's division keeps, so that the means don't repeat its rounding.
_UNIT = {"freight": "freight2", "insurance": "ins2", "customs": "cus2", "port": "port2", "lastmile": "lm2",
         "demurrage": "dem2", "total_lc": "lc2", "exporter_margin": "net2"}
_SHARE = {"avg_exporter_margin_pct": ("net2", "usd2", 2), "freight_pct_of_lc": ("freight2", "lc2", 1),
          "customs_pct_of_lc": ("cus2", "lc2", 1), "lastmile_pct_of_lc": ("lm2", "lc2", 1)}
_unit_rows = ", ".join(f"{half_up(f'{c}::HUGEINT*{10**16}', 'qty')} AS u_{k}" for k, c in _UNIT.items())
_share_rows = ", ".join(
    f"{half_up(f'{a}::HUGEINT*{10**21}', b)}*100 AS q_{k}" for k, (a, b, _) in _SHARE.items()
)
CTES["v4"] = (["s", "m", "p"], f"""
SELECT country, region, category, product_name, count(*) AS total_shipments, {avg("net4", 4, 4)} AS avg_fob_per_unit_usd,
  {", ".join(f"{avg('u_' + k, 18, 4)} AS avg_{k}_per_unit_usd" for k in _UNIT)},
  {", ".join(f"{avg('q_' + k, 21, d)} AS {k}" for k, (_, _, d) in _SHARE.items())},
  {avg("ratio4", 4, 4)} AS avg_lc_fob_ratio, {money("dem2")} AS total_demurrage_usd,
  CASE WHEN sum(ratio4) > 13000*count(ratio4) THEN 'High Cost Route'
       WHEN sum(ratio4) > 11500*count(ratio4) THEN 'Moderate Cost' ELSE 'Efficient Route' END AS route_efficiency
FROM (SELECT country, m.region, category, product_name, net4, ratio4, dem2, {_unit_rows}, {_share_rows}
  FROM s JOIN m USING (market_id) JOIN p USING (product_id))
GROUP BY country, region, category, product_name""")


def _score(x: str, limits: list[int], op: str) -> str:
    whens = " ".join(f"WHEN {x} {op} {lim} THEN {pts}" for pts, lim in zip((5, 4, 3, 2), limits))
    return f"CASE {whens} ELSE 1 END"


_AGE = f"datediff('day', last_order_date, DATE '{RECENCY_AS_OF}')"
CTES["v5"] = (["c", "o", "r"], f"""
SELECT customer_id, company_name, customer_type, country, city, customer_tier, terms AS payment_terms_days, account_manager,
  total_orders, total_units, total_revenue_usd, total_gp_inr, avg_margin_pct, avg_discount, last_order_date, first_order_date,
  {_AGE} AS days_since_last_order, products_ordered, markets_ordered_from, late_payments, avg_payment_delay,
  coalesce(total_returns, 0) AS total_returns, coalesce(return_loss_usd, 0) AS return_loss_usd,
  {_score(_AGE, [30, 60, 90, 180], "<=")} AS recency_score, {_score("total_orders", [80, 40, 20, 10], ">=")} AS frequency_score,
  {_score("total_revenue_usd", [300000, 100000, 50000, 10000], ">=")} AS monetary_score,
  CASE WHEN avg_payment_delay > 25 THEN '🔴 High Risk — Payment Issues'
       WHEN coalesce(total_returns, 0) > 15 THEN '🟡 High Returns — Review'
       WHEN total_revenue_usd > 200000 AND avg_payment_delay <= 5 THEN '🟢 Champion Buyer'
       WHEN total_revenue_usd > 80000 THEN '🟢 Loyal Buyer' ELSE '⚪ Standard Buyer' END AS buyer_health_tag
FROM c
LEFT JOIN (SELECT customer_id, count(*) AS total_orders, {whole("sum(qty)")} AS total_units, {money("usd2")} AS total_revenue_usd,
    {money("gp2")} AS total_gp_inr, {avg("gm2", 2, 2)} AS avg_margin_pct, {avg("disc", 0, 2)} AS avg_discount,
    max(order_date) AS last_order_date, min(order_date) AS first_order_date,
    count(DISTINCT product_id) AS products_ordered, count(DISTINCT market_id) AS markets_ordered_from,
    {n_if("payment_status IN ('Overdue', 'Paid Late')")} AS late_payments, {avg("delay", 0, 1)} AS avg_payment_delay
  FROM o WHERE {LIVE} GROUP BY 1) USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS total_returns, {money("loss2")} AS return_loss_usd FROM r GROUP BY 1) USING (customer_id)""")

_LATE = "count(*) FILTER (is_delayed = 'Y')"
CTES["v6"] = (["s", "m"], f"""
SELECT country, m.region, shipping_line, port_of_loading, port_of_discharge, container_type, delay_reason,
  count(*) AS total_shipments, {_LATE} AS delayed_shipments, {share("is_delayed = 'Y'")} AS delay_rate_pct,
  {real(half_up("sum(delay_days) FILTER (is_delayed = 'Y')*10", _LATE), 1)} AS avg_delay_days,
  {avg("transit_days", 0, 1)} AS avg_transit_days, {avg("customs_days", 0, 1)} AS avg_customs_days,
  {money("dem2")} AS total_demurrage_usd, {avg("dem2", 2, 2)} AS avg_demurrage_per_shipment, {money("freight2")} AS total_freight_usd,
  CASE WHEN {_LATE}*100 > 25*count(*) THEN '🔴 Critical — High Delay'
       WHEN {_LATE}*100 > 12*count(*) THEN '🟡 Warning — Monitor' ELSE '🟢 Performing Well' END AS performance_flag
FROM s JOIN m USING (market_id) GROUP BY country, m.region, shipping_line, port_of_loading, port_of_discharge, container_type, delay_reason""")

CTES["v7"] = (["pr", "m", "p"], f"""
SELECT country, region, category, subcategory, product_name, {avg("our2", 2, 2)} AS our_avg_price_usd,
  {avg("c1", 2, 2)} AS comp1_avg_price_usd, {avg("c2", 2, 2)} AS comp2_avg_price_usd, {avg("c3", 2, 2)} AS comp3_avg_price_usd,
  {avg("avg2", 2, 2)} AS avg_market_price_usd, {avg("index1", 1, 1)} AS avg_price_index, {avg("lc4", 4, 4)} AS avg_landed_cost_usd,
  {avg("margin2", 2, 2)} AS avg_gross_margin_pct, {real(half_up("sum(our2)-sum(avg2)", "count(*)"), 2)} AS price_gap_usd,
  {real(half_up("(sum(our2)-sum(avg2))*10000", "sum(avg2)"), 2)} AS price_gap_pct,
  CASE WHEN sum(index1) > 1150*count(*) THEN '⚠️ Overpriced' WHEN sum(index1) < 850*count(*) THEN '⚠️ Underpriced'
       WHEN sum(index1) BETWEEN 950*count(*) AND 1100*count(*) THEN '✅ Optimally Priced' ELSE '🟡 Fine Tune' END
    AS pricing_recommendation,
  count(*) AS data_points
FROM pr JOIN m USING (market_id) JOIN p USING (product_id) GROUP BY country, region, category, subcategory, product_name""")

CTES["r_mode"] = (["r"], """
SELECT market_id, product_id, return_reason AS top_return_reason
FROM (SELECT market_id, product_id, return_reason, count(*) AS n FROM r GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY market_id, product_id ORDER BY n DESC, return_reason) = 1""")
CTES["v8"] = (["r", "r_mode", "m", "p", "o"], f"""
SELECT country, region, category, product_name, total_orders, total_units_sold, rev2/1e2 AS total_revenue_usd,
  count(*) AS total_returns, {whole("sum(rqty)")} AS total_return_units, {up("count(*)*100", "total_orders", 2)} AS return_rate_pct,
  {money("loss2")} AS total_return_loss_usd, {money("refund2")} AS total_refund_usd, {money("ship2")} AS total_return_ship_usd,
  {avg("days", 0, 1)} AS avg_days_to_return, top_return_reason,
  {up("sum(loss2)*100", "rev2", 2)} AS return_loss_pct_of_revenue,
  CASE WHEN sum(loss2)*100 > 8*rev2 THEN '🔴 Critical Return Problem'
       WHEN sum(loss2)*100 > 4*rev2 THEN '🟡 Elevated — Investigate' ELSE '🟢 Acceptable' END AS return_risk_flag
FROM r JOIN (SELECT market_id, product_id, count(*) AS total_orders, {whole("sum(qty)")} AS total_units_sold, sum(usd2)::BIGINT AS rev2
  FROM o WHERE order_status = 'Delivered' GROUP BY ALL) USING (market_id, product_id)
JOIN r_mode USING (market_id, product_id) JOIN m USING (market_id) JOIN p USING (product_id)
GROUP BY country, region, category, product_name, total_orders, total_units_sold, rev2, top_return_reason""")

CTES["v9"] = (["o", "m", "fx"], f"""
SELECT year, month, currency, usd2/1e2 AS revenue_usd, {real("inr2", 2)} AS revenue_inr_actual, avg_rate_used,
  rate4/1e4 AS benchmark_rate, vol4/1e4 AS monthly_volatility, {real(half_up("usd2*rate4", "10000"), 2)} AS revenue_inr_at_benchmark,
  {real(half_up("inr2*10000 - usd2*rate4", "10000"), 2)} AS forex_gain_loss_inr,
  {real(half_up("(inr2*10000 - usd2*rate4)*10000", "usd2*rate4"), 2)} AS forex_impact_pct,
  CASE WHEN inr2*10000 > usd2*rate4 THEN 'Forex Gain' ELSE 'Forex Loss' END AS forex_direction
FROM (SELECT fiscal_year AS year, month_num AS month, currency, sum(usd2)::HUGEINT AS usd2, sum(inr2)::HUGEINT AS inr2,
    {avg("o.fx4", 4, 4)} AS avg_rate_used
  FROM o JOIN m USING (market_id) WHERE {LIVE} GROUP BY ALL)
LEFT JOIN (SELECT currency_code AS currency, year, month, {half_up("sum(rate4)", "count(*)")} AS rate4,
    max(rate4)-min(rate4) AS vol4 FROM fx GROUP BY ALL) USING (currency, year, month)""")

CTES["v10"] = (["o"], f"""
SELECT order_channel, fiscal_year, quarter, count(*) AS total_orders, {whole("sum(qty)")} AS total_units,
  {money("usd2")} AS total_revenue_usd, {money("gp2")} AS total_gp_inr, {avg("gm2", 2, 2)} AS avg_margin_pct,
  {avg("disc", 0, 2)} AS avg_discount_pct, {avg("usd2", 2, 2)} AS avg_order_value_usd,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT market_id) AS markets_reached, {n_if(REPEAT)} AS repeat_orders,
  {share(REPEAT)} AS repeat_rate_pct, {n_if(OVERDUE)} AS overdue_orders, {n_if(CANCELLED)} AS cancelled_orders,
  {share(CANCELLED)} AS cancellation_rate_pct
FROM o GROUP BY order_channel, fiscal_year, quarter""")

CTES["v11"] = (["d", "m", "p"], f"""
SELECT country, region, category, product_name, fiscal_year, quarter, {whole("sum(search)")} AS total_search_volume,
  {whole("sum(social)")} AS total_social_mentions, {whole("sum(demand_units)")} AS total_demand_units,
  {avg("trends1", 1, 1)} AS avg_trends_score, {avg("yoy2", 2, 2)} AS avg_yoy_growth_pct, {avg("bsr", 0, 0)} AS avg_amazon_bsr,
  {avg("season3", 3, 3)} AS avg_seasonality_index,
  CASE WHEN sum(yoy2) > 2500*count(*) THEN '🚀 High Growth' WHEN sum(yoy2) > 1000*count(*) THEN '📈 Growing'
       WHEN sum(yoy2) > 0 THEN '➡️ Stable' ELSE '📉 Declining' END AS demand_classification
FROM d JOIN m USING (market_id) JOIN p USING (product_id) GROUP BY country, region, category, product_name, fiscal_year, quarter""")

CTES["v12"] = (["o", "m"], f"""
SELECT country, region, risk1/1e1 AS payment_risk_score, marketplace AS primary_marketplace, count(*) AS total_orders,
  {money("usd2")} AS total_billed_usd, {n_if("payment_status = 'Paid On Time'")} AS paid_on_time,
  {n_if("payment_status = 'Paid Late'")} AS paid_late, {n_if("payment_status = 'Pending'")} AS pending, {n_if(OVERDUE)} AS overdue,
  coalesce(sum(usd2) FILTER ({OVERDUE}), 0)::DOUBLE/1e2 AS overdue_value_usd,
  {share("payment_status = 'Paid On Time'")} AS on_time_rate_pct, {avg("delay", 0, 1)} AS avg_delay_days,
  {avg("(terms + greatest(delay, 0))", 0, 1)} AS avg_dso_days,
  CASE WHEN sum(delay) > 20*count(*) THEN '🔴 High Risk' WHEN sum(delay) > 10*count(*) THEN '🟡 Moderate Risk'
       ELSE '🟢 Low Risk' END AS payment_risk_flag
FROM o JOIN m USING (market_id) GROUP BY country, region, risk1, marketplace""")

CTES["v13"] = (["o", "m", "p"], f"""
SELECT *, rank() OVER (PARTITION BY country, category, fiscal_year ORDER BY total_revenue_usd DESC) AS revenue_rank_in_year
FROM (SELECT country, region, category, month_num, month_name, fiscal_year, count(*) AS total_orders,
    {whole("sum(qty)")} AS total_units, {money("usd2")} AS total_revenue_usd, {avg("gm2", 2, 2)} AS avg_margin_pct,
    CASE WHEN month_num IN (11, 12, 1) THEN '🎄 Peak Season' WHEN month_num IN (9, 10) THEN '📦 Pre-Peak Ramp'
         WHEN month_num IN (6, 7, 8) THEN '☀️ Summer Slow' ELSE '➡️ Normal' END AS season_tag
  FROM o JOIN m USING (market_id) JOIN p USING (product_id) WHERE {LIVE}
  GROUP BY country, region, category, month_num, month_name, fiscal_year)""")

CTES["v14"] = (["o", "p"], f"""
SELECT category, subcategory, count(DISTINCT product_id) AS product_count, count(*) AS total_orders,
  {whole("sum(qty)")} AS total_units, {money("usd2")} AS total_revenue_usd, {money("gp2")} AS total_gp_inr,
  {avg("gm2", 2, 2)} AS avg_margin_pct, count(DISTINCT market_id) AS markets_served, count(DISTINCT customer_id) AS unique_buyers,
  {real(half_up("sum(usd2)*10000", "any_value(g.total)"), 2)} AS revenue_share_pct,
  {real(half_up("sum(usd2)*sum(usd2)*1000000", "any_value(g.total)*any_value(g.total)"), 2)} AS hhi_contribution
FROM o JOIN p USING (product_id), (SELECT sum(usd2)::HUGEINT AS total FROM o WHERE {LIVE}) g
WHERE {LIVE} GROUP BY category, subcategory""")

CTES["v15"] = (["o", "s", "r"], f"""
SELECT 'Overall' AS summary_level, {money("o.usd2")} AS total_revenue_usd,
  {real(half_up("sum(inr2)", "10000000"), 2)} AS total_revenue_cr_inr, {avg("gm2", 2, 2)} AS avg_gross_margin_pct,
  count(o.order_id) AS total_orders, {whole("sum(o.qty)")} AS total_units_exported,
  count(DISTINCT o.customer_id) AS total_buyers, count(DISTINCT o.market_id) AS markets_active,
  count(DISTINCT o.product_id) AS products_exported, {n_if("o.payment_status = 'Overdue'")} AS overdue_orders,
  coalesce(sum(o.usd2) FILTER (o.payment_status = 'Overdue'), 0)::DOUBLE/1e2 AS overdue_value_usd,
  count(DISTINCT shipment_id) AS total_shipments, {avg("transit_days", 0, 1)} AS avg_transit_days,
  {money("dem2")} AS total_demurrage_usd, count(DISTINCT return_id) AS total_returns, {money("loss2")} AS total_return_loss_usd
FROM o LEFT JOIN s ON s.order_id = o.order_id LEFT JOIN r ON r.order_id = o.order_id WHERE {LIVE}""")
