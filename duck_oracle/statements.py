"""DuckDB statement per registered query; columns carry the names and plain types of the query."""

from duck_oracle.ints import avg, half_even, half_even_signed, half_up, real, units, up, whole
from duck_oracle.star import statement
from duck_oracle.views import CTES, VIEW

STATEMENTS: dict[str, str] = {}


def add(name: str, needs: list[str], body: str) -> None:
    STATEMENTS[name] = statement(body, needs, CTES)


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def mean(col: str, digits: int) -> str:
    """Unrounded mean of view values, from their exact sum."""
    return f"(sum({units(col, digits)})::DOUBLE / 1e{digits}) / count({col})"


def mean_even(col: str, scale: int, digits: int) -> str:
    return real(half_even_signed(f"sum({units(col, scale)}) * {10**digits}", f"count({col}) * {10**scale}"), digits)


def total(col: str, digits: int) -> str:
    return f"coalesce(sum({units(col, digits)}), 0)::DOUBLE / 1e{digits}"


# --- views ----------------------------------------------------------------------------------

for _name, _cte in VIEW.items():
    if _name == "customer_ltv":
        add(_name, [_cte], f"""SELECT * REPLACE ({day("last_order_date")} AS last_order_date,
  {day("first_order_date")} AS first_order_date) FROM v5""")
    else:
        add(_name, [_cte], f"SELECT * FROM {_cte}")

# --- enrichment -----------------------------------------------------------------------------

add("order_economics", ["o"], """SELECT order_id, net4/1e4 AS net_fob_price_usd, usd2/1e2 AS total_fob_value_usd,
  inr2/1e2 AS total_fob_value_inr, unit_cogs2::BIGINT/1e2 AS cogs_inr_per_unit, tcogs2/1e2 AS total_cogs_inr,
  gp2/1e2 AS gross_profit_inr, gm2/1e2 AS gross_margin_pct FROM o""")
add("payment_status", ["o"], f"""SELECT order_id, {day("due_date")} AS payment_due_date,
  {day("received_date")} AS payment_received_date, payment_status FROM o""")
_cal = """year(d)::BIGINT AS fiscal_year, 'Q' || quarter(d) AS quarter, month(d)::BIGINT AS month_num,
  monthname(d) AS month_name, weekofyear(d)::BIGINT AS week_num"""
add("calendar_columns", [], f"""SELECT o_orderkey, {day("d")} AS order_date, {_cal}
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
add("landed_cost", ["s"], """SELECT shipment_id, usd2/1e2 AS declared_value_usd, freight2/1e2 AS freight_cost_usd,
  ins2/1e2 AS insurance_usd, cif2/1e2 AS cif_value_usd, cus2/1e2 AS customs_duty_usd, port2/1e2 AS port_handling_usd,
  lm2/1e2 AS last_mile_usd, lc2/1e2 AS total_landed_cost_usd, ratio4/1e4 AS landed_to_fob_ratio,
  net2/1e2 AS exporter_net_margin_usd FROM s""")
add("shipment_timing", ["s"], f"""SELECT shipment_id, {day("shipment_date")} AS shipment_date, {day("eta")} AS estimated_arrival_date,
  {day("arrival")} AS actual_arrival_date, transit_days AS total_transit_days, is_delayed, shipment_status FROM s""")
add("price_benchmark", ["pr"], f"""SELECT {day("date")} AS date, product_id, market_id::BIGINT AS market_id, our2/1e2 AS our_price_usd,
  avg2/1e2 AS avg_competitor_price_usd, index1/1e1 AS our_price_index,
  CASE WHEN index1 > 1100 THEN 'Premium' WHEN index1 > 900 THEN 'Competitive' ELSE 'Below Market' END AS price_competitiveness,
  lc4/1e4 AS landed_cost_usd, margin2/1e2 AS gross_margin_on_our_price_pct FROM pr""")
add("target_price", ["pr0", "tp"], """SELECT product_id, market_id::BIGINT AS market_id, lc4::DOUBLE/1e4 AS landed_cost_usd,
  premium6::DOUBLE/1e6 AS market_premium, target2::DOUBLE/1e2 AS target_price_usd
FROM (SELECT DISTINCT product_id, market_id FROM pr0) JOIN tp USING (product_id, market_id)""")
add("demand_signals", ["d"], f"""SELECT {day("date")} AS date, product_id, market_id, demand_units AS estimated_demand_units,
  yoy2/1e2 AS yoy_search_growth_pct,
  CASE WHEN yoy2 > 1000 THEN 'Growing' WHEN yoy2 < -500 THEN 'Declining' ELSE 'Stable' END AS demand_trend, bsr AS amazon_bsr FROM d""")
add("seasonality_factor", [], f"""SELECT o_orderkey, {day("d")} AS order_date,
  ([1.20, 0.95, 0.90, 0.88, 0.92, 0.95, 0.98, 1.00, 1.05, 1.10, 1.25, 1.35])[month(d)]::DOUBLE AS factor
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
add("return_economics", ["r"], f"""SELECT return_id, refund2/1e2 AS refund_amount_usd, ship2/1e2 AS return_shipping_cost_usd,
  loss2/1e2 AS net_loss_usd, {day("return_date")} AS return_date, month(return_date)::BIGINT AS return_month,
  year(return_date)::BIGINT AS return_year FROM r""")
add("fx_daily_change", ["fx"], f"""SELECT currency_code, {day("date")} AS date, rate4/1e4 AS rate_to_inr,
  change4::DOUBLE/1e4 AS daily_change_pct, currency_code || '/INR' AS currency_pair FROM fx""")
_base = half_up("sum(rate4)", "count(*)")
add("clamp_to_base", ["fx0"], f"""SELECT currency_code, {day("date")} AS date,
  {half_even("least(greatest(rate4*100, base4*88), base4*112)", "100")}::DOUBLE/1e4 AS rate_to_inr
FROM fx0 JOIN (SELECT currency_code, {_base} AS base4 FROM fx0 GROUP BY 1) USING (currency_code)""")
add("with_lookup", ["c"], """SELECT o_orderkey AS order_key, o_custkey AS customer_id, coalesce(terms, 30)::BIGINT AS payment_terms_days,
  customer_tier FROM orders LEFT JOIN (SELECT * FROM c WHERE customer_tier <> 'Class 4') ON customer_id = o_custkey""")
add("composite_score_tier", ["m"], """SELECT market_id::BIGINT AS market_id, comp2/1e2 AS composite_score, market_tier FROM m""")
add("product_margins", ["p"], """SELECT product_id, sku_code, india1::DOUBLE/1e1 AS gross_margin_pct_india, mrp0::DOUBLE AS india_mrp_inr FROM p""")
add("date_spine", [], f"""SELECT {day("d")} AS date FROM (SELECT unnest(generate_series(min(o_orderdate::DATE)::TIMESTAMP,
  max(o_orderdate::DATE)::TIMESTAMP, INTERVAL 2 DAY)) AS d FROM orders)""")
add("dense_panel", ["d0"], f"""SELECT market_id, {day("d")} AS date, count(*) AS n_products
FROM (SELECT p_partkey FROM part), (SELECT n_nationkey::BIGINT AS market_id FROM nation),
  (SELECT unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 2 DAY)) AS d FROM d0) GROUP BY ALL""")
_cents = "round(l_extendedprice*100)::BIGINT"
add("rounding", ["lines"], f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, printf('L%03d', l_linenumber) AS line_code,
  (({_cents}*5 + 5) // 10)/1e2 AS half_up, {half_even(f"{_cents}*5", "10")}::DOUBLE/1e2 AS half_even,
  CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 20 THEN 'medium' WHEN l_quantity <= 50 THEN 'large' END AS size_bin
FROM lines""")

# --- quality --------------------------------------------------------------------------------

_COUNTED = {"dim_products": "p", "dim_markets": "m", "dim_customers": "c", "dim_forex_rates": "fx", "fact_export_orders": "o",
            "fact_shipment_details": "s", "fact_competitor_pricing": "pr", "fact_market_demand": "d", "fact_returns": "r"}
for _name, _tables in {"row_counts": {**_COUNTED, "dim_customers": "c_all"}, "footer_counts": _COUNTED}.items():
    add(_name, list(_tables.values()),
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {c}" for t, c in _tables.items()))
add("footer_extremes", ["o"], " UNION ALL ".join(f"""SELECT '{name}' AS column_name, count(*) AS row_count, count({c}) AS present,
  min({c})::BIGINT AS min, max({c})::BIGINT AS max FROM o""" for name, c in {"order_id": "order_id", "customer_id": "customer_id", "quantity_units": "qty"}.items()))
add("batch_append", ["r"], """SELECT year(return_date)::BIGINT AS return_year, count(*) AS row_count, sum(loss2)::DOUBLE/1e2 AS net_loss_usd FROM r GROUP BY 1""")
add("csv_round_trip", ["c"], f"""SELECT c.market_id::VARCHAR AS market_id, count(*) AS row_count, sum(round(c_acctbal*100)::BIGINT)::DOUBLE/1e2 AS credit_limit_usd,
  {day("max(DATE '1995-01-01' - (30 + customer_id % 1170)::INT)")} AS last_registration
FROM c JOIN customer ON c_custkey = c.customer_id GROUP BY c.market_id""")
_REASONS = {3: "return_id: missing", 7: "return_date: not a date", 11: "return_quantity: not a integer", 13: "refund_amount_usd: does not fit",
            17: "return_shipping_cost_usd: does not fit", 19: "is_first_return: too long"}
add("csv_rejects", ["r"], f"""SELECT reason, count(*) AS row_count, CASE WHEN reason = 'kept' THEN sum(loss2)::DOUBLE/1e2 END AS net_loss_usd
FROM (SELECT loss2, CASE (return_id // 1048576) % 50 {" ".join(f"WHEN {n} THEN '{text}'" for n, text in _REASONS.items())} ELSE 'kept' END AS reason FROM r)
GROUP BY reason""")
_REPORTS = {"product_export_scorecard": ("v3", "total_revenue_usd DESC NULLS LAST, product_id"),
            "customer_ltv": ("v5", "total_revenue_usd DESC NULLS LAST, customer_id"),
            "landed_cost_analysis": ("v4", "avg_lc_fob_ratio DESC NULLS FIRST, country, region, category, product_name"),
            "payment_risk": ("v12", "overdue_value_usd DESC NULLS FIRST, country, region")}
for _name, (_cte, _order) in _REPORTS.items():
    _days = f"""REPLACE ({day("last_order_date")} AS last_order_date, {day("first_order_date")} AS first_order_date)""" if _name == "customer_ltv" else ""
    add(f"report_{_name}", [_cte], f"SELECT * {_days}, row_number() OVER (ORDER BY {_order}) AS position FROM {_cte}")
add("buyers_by_period", ["o"], " UNION ALL ".join(f"""SELECT '{period}' AS period, {", ".join(
    f"{c}{kind} AS {c}" if k < depth else f"NULL{kind} AS {c}" for k, (c, kind) in enumerate({"fiscal_year": "::BIGINT", "quarter": "::VARCHAR", "month_num": "::BIGINT"}.items()))},
  count(DISTINCT customer_id) AS active_buyers FROM o {"GROUP BY " + ", ".join(["fiscal_year", "quarter", "month_num"][:depth]) if depth else ""}"""
    for depth, period in ((3, "month"), (2, "quarter"), (1, "year"), (0, "all"))))
add("dq_unique", [], """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
add("dq_foreign_key", ["m", "fx"], """SELECT currency, count(*) AS row_count FROM m
WHERE currency NOT IN (SELECT currency_code FROM fx) GROUP BY currency""")
_REFS = [("dim_customers", "market_id"), *[("fact_export_orders", k) for k in ("product_id", "market_id", "customer_id")],
         *[("fact_shipment_details", k) for k in ("order_id", "product_id", "market_id", "customer_id")],
         *[(t, k) for t in ("fact_competitor_pricing", "fact_market_demand") for k in ("product_id", "market_id")],
         *[("fact_returns", k) for k in ("order_id", "product_id", "market_id", "customer_id")]]
_OF = {"product_id": "p", "market_id": "m", "customer_id": "c", "order_id": "o"}
add("foreign_key_report", list(_COUNTED.values()), " UNION ALL ".join(
    f"""SELECT '{t}' AS child_table, '{k}' AS key, count(DISTINCT a.{k}) AS orphan_keys, count(a.{k}) AS orphan_rows
FROM {_COUNTED[t]} a ANTI JOIN {_OF[k]} b ON a.{k} = b.{k}""" for t, k in _REFS))
add("dq_not_null", ["o", "r"], """SELECT unnest(['order_id', 'product_id', 'market_id', 'return_reason', 'return_date']) AS column_name,
  unnest([count(*) - count(o.order_id), count(*) - count(o.product_id), count(*) - count(o.market_id),
    count(*) - count(return_reason), count(*) - count(return_date)]) AS null_count
FROM o LEFT JOIN r ON r.order_id = o.order_id""")


def _profile(table: str, metrics: dict[str, tuple[str, int]]) -> str:
    return " UNION ALL ".join(f"""SELECT '{name}' AS metric, count(*) AS row_count, {real(f"sum({c})", d)} / count({c}) AS mean,
  {real(f"min({c})", d)} AS min, {real(f"max({c})", d)} AS max, {real(f"sum({c})", d)} AS sum,
  count(*) FILTER ({c} < 0) AS negative_count FROM {table}""" for name, (c, d) in metrics.items())


add("dq_profile", ["o"], _profile("o", {"gross_margin_pct": ("gm2", 2), "total_fob_value_usd": ("usd2", 2),
                                        "total_cogs_inr": ("tcogs2", 2), "gross_profit_inr": ("gp2", 2)}))
add("dq_profile_shipments", ["s"], _profile("s", {"landed_to_fob_ratio": ("ratio4", 4), "freight_cost_usd": ("freight2", 2),
                                                  "demurrage_charges_usd": ("dem2", 2)}))
add("dq_profile_returns", ["r"], _profile("r", {"return_quantity": ("rqty", 0), "net_loss_usd": ("loss2", 2)}))


def _range(table: str, name: str, col: str, lo: int, hi: int) -> str:
    return f"""SELECT '{name}' AS column_name, count(*) AS row_count, count(*) FILTER ({col} BETWEEN {lo} AND {hi}) AS inside,
  count(*) FILTER ({col} NOT BETWEEN {lo} AND {hi}) AS outside, count(*) - count({col}) AS missing FROM {table}"""


add("dq_range", ["o"], _range("o", "gross_margin_pct", "gm2", 5500, 8200))
add("dq_range_ratio", ["s"], _range("s", "landed_to_fob_ratio", "ratio4", 10300, 13500))
add("dq_domain", ["o"], """SELECT unnest(['order_channel', 'payment_status', 'total_fob_value_usd', 'net_fob_price_usd', 'gross_margin_pct'])
  AS column_name, unnest([count(*) FILTER (length(order_channel) > 8), count(*) FILTER (length(payment_status) > 20),
  count(*) FILTER (abs(usd2) >= 10000000), count(*) FILTER (abs(net4) >= 1000000000000 OR net4 % 100 <> 0),
  count(*) FILTER (abs(gm2) >= 10000000)]) AS violations FROM o""")
add("dq_domain_declared", ["s"], """SELECT unnest(['shipping_line', 'port_of_loading', 'port_of_discharge', 'container_type', 'hsn_code',
  'product_id', 'market_id', 'customer_id', 'is_delayed', 'shipment_status', 'delay_reason', 'declared_value_usd', 'freight_cost_usd',
  'insurance_usd', 'cif_value_usd', 'customs_duty_usd', 'port_handling_usd', 'last_mile_usd', 'demurrage_charges_usd',
  'total_landed_cost_usd', 'landed_to_fob_ratio', 'exporter_net_margin_usd']) AS column_name,
  unnest([count(*) FILTER (length(shipping_line) > 30), count(*) FILTER (length(port_of_loading) > 50),
  count(*) FILTER (length(port_of_discharge) > 80), count(*) FILTER (length(container_type) > 30),
  count(*) FILTER (length(printf('%08d', product_id * 7919 % 100000000)) > 15),
  count(*) FILTER (length(product_id::VARCHAR) > 10), count(*) FILTER (length(market_id::VARCHAR) > 5),
  count(*) FILTER (length(customer_id::VARCHAR) > 10), count(*) FILTER (length(is_delayed) > 1),
  count(*) FILTER (length(shipment_status) > 20), count(*) FILTER (length(delay_reason) > 50),
  count(*) FILTER (abs(usd2) >= 100000000000000), count(*) FILTER (abs(freight2) >= 1000000000000),
  count(*) FILTER (abs(ins2) >= 1000000000000), count(*) FILTER (abs(cif2) >= 100000000000000),
  count(*) FILTER (abs(cus2) >= 1000000000000), count(*) FILTER (abs(port2) >= 1000000000000),
  count(*) FILTER (abs(lm2) >= 1000000000000), count(*) FILTER (abs(dem2) >= 1000000000000),
  count(*) FILTER (abs(lc2) >= 100000000000000), count(*) FILTER (abs(ratio4) >= 100000000),
  count(*) FILTER (abs(net2) >= 100000000000000)]) AS violations FROM s""")
add("sql_scan", ["o", "m", "v12"], """SELECT v.country, v.payment_risk_flag, count(*) AS big_orders
FROM o JOIN m USING (market_id) JOIN v12 v ON v.country = m.country
WHERE usd2 BETWEEN 5000000 AND 9000000 AND order_status IN ('Delivered', 'Shipped') GROUP BY ALL""")

# --- generic grouped and ranked operators ---------------------------------------------------

add("mode_by", ["r"], """SELECT market_id::BIGINT AS market_id, mode() WITHIN GROUP (ORDER BY return_reason) AS top_reason FROM r GROUP BY 1""")
STATEMENTS["mode_by"] = statement("""SELECT market_id::BIGINT AS market_id, return_reason AS top_reason
FROM (SELECT market_id, return_reason, count(*) AS n FROM r GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY market_id ORDER BY n DESC, return_reason) = 1""", ["r"], CTES)
add("growth_by_currency", ["fx0"], f"""SELECT currency_code, {day("date")} AS date, rate4/1e4 AS rate_to_inr,
  {half_up("(rate4-prev)*1000000", "prev")}::DOUBLE/1e4 AS growth_pct
FROM (SELECT *, lag(rate4) OVER (PARTITION BY currency_code ORDER BY date) AS prev FROM fx0)""")
add("running_total_by_currency", ["fx0"], f"""SELECT currency_code, {day("date")} AS date,
  (sum(rate4) OVER (PARTITION BY currency_code ORDER BY date))::DOUBLE/1e4 AS running_total FROM fx0""")
add("running_events", [], """SELECT event_id, (sum(round(value*100)::BIGINT) OVER (ORDER BY event_id))::DOUBLE/1e2 AS running_total FROM events""")
add("top_orders_per_market", ["o"], """SELECT market_id::BIGINT AS market_id, rank, order_id, usd2/1e2 AS total_fob_value_usd
FROM (SELECT *, row_number() OVER (PARTITION BY market_id ORDER BY usd2 DESC, order_id) AS rank FROM o) WHERE rank <= 3""")
add("sample_orders", ["o"], """SELECT order_id, order_status FROM o WHERE order_status = 'Delivered'
ORDER BY substr(md5('42:' || order_id), 1, 15), order_id LIMIT 1000""")
_KEYS = {
    "dim_products": ("p", "product_id"), "dim_markets": ("m", "market_id"), "dim_customers": ("c", "customer_id"),
    "dim_forex_rates": ("fx", "date, currency_code"), "fact_export_orders": ("o", "order_id"),
    "fact_shipment_details": ("s", "shipment_id"), "fact_competitor_pricing": ("pr", "date, product_id, market_id"),
    "fact_market_demand": ("d", "date, product_id, market_id"), "fact_returns": ("r", "return_id"),
}
add("dq_primary_keys", [cte for cte, _ in _KEYS.values()], "\nUNION ALL ".join(
    f"""SELECT '{table}' AS table_name, count(*)::BIGINT AS duplicate_keys
FROM (SELECT {keys} FROM {cte} GROUP BY {keys} HAVING count(*) > 1)""" for table, (cte, keys) in _KEYS.items()))
add("order_rank", ["o"], """SELECT order_id, usd2/1e2 AS total_fob_value_usd, row_number() OVER (ORDER BY usd2 DESC, order_id) AS rank FROM o""")
add("customer_share", ["o"], f"""SELECT customer_id, rev/1e2 AS revenue_usd, {real(half_up("rev*1000000", "sum(rev) OVER ()"), 4)} AS share_pct
FROM (SELECT customer_id, sum(usd2)::BIGINT AS rev FROM o GROUP BY 1)""")

# --- market scoring -------------------------------------------------------------------------

CTES["p1"] = (["v2"], f"""
SELECT *, {half_even("final2*65 + potential2*35", "100")}::DOUBLE/1e2 AS priority_score,
  CASE WHEN final2 <= 0 OR final2 > 1000 THEN NULL WHEN final2 <= 650 THEN 'Tier 4 - Avoid' WHEN final2 <= 750 THEN 'Tier 3 - Monitor'
       WHEN final2 <= 850 THEN 'Tier 2 - Plan Entry' ELSE 'Tier 1 - Enter Now' END AS entry_tier
FROM (SELECT *, gdp2::DOUBLE/1e2 AS gdp_score, final2/1e2 AS final_score, potential2/1e2 AS revenue_potential
  FROM (SELECT *, {half_even('''(round(home_decor_demand_score*10)*25 + round(indian_craft_affinity_score*10)*20
      + round(market_entry_ease_score*10)*18 + round(ecommerce_maturity_score*10)*17 + round(regulatory_ease_score*10)*12)::BIGINT*10
      + gdp2*8''', "100")}::BIGINT AS final2
    FROM (SELECT *, {half_even("(gdp_per_capita_usd - min(gdp_per_capita_usd) OVER ())::BIGINT*900 + (max(gdp_per_capita_usd) OVER () - min(gdp_per_capita_usd) OVER ())*100",
                               "(max(gdp_per_capita_usd) OVER () - min(gdp_per_capita_usd) OVER ())")}::BIGINT AS gdp2,
      {half_even("round(market_size_usd_mn*100)::BIGINT*1000", "round(max(market_size_usd_mn) OVER ()*100)::BIGINT")}::BIGINT AS potential2
      FROM v2)))""")
add("score_markets", ["p1"], "SELECT * EXCLUDE (gdp2, final2, potential2) FROM p1")
add("market_ranking", ["p1"], """SELECT row_number() OVER (ORDER BY priority_score DESC, market_id) AS rank, market_id::BIGINT AS market_id,
  country, region, final_score, priority_score, entry_tier, market_size_usd_mn FROM p1""")
for _name, _tier in {"tier_markets": "Tier 3 - Monitor", "tier_1_markets": "Tier 1 - Enter Now", "tier_2_markets": "Tier 2 - Plan Entry"}.items():
    add(_name, ["p1"], f"""SELECT market_id::BIGINT AS market_id, country, entry_tier, final_score, home_decor_demand_score,
  indian_craft_affinity_score, avg_customs_duty_pct, market_size_usd_mn FROM p1 WHERE entry_tier = '{_tier}'""")
add("best_markets", ["v2"], """SELECT (SELECT country FROM v2 ORDER BY market_size_usd_mn DESC, market_id LIMIT 1) AS best_revenue_potential,
  (SELECT country FROM v2 ORDER BY indian_craft_affinity_score DESC, market_id LIMIT 1) AS best_craft_affinity,
  (SELECT country FROM v2 ORDER BY avg_customs_duty_pct, market_id LIMIT 1) AS lowest_customs_duty""")
add("score_breakdown", ["p1"], """SELECT market_id::BIGINT AS market_id, country, score_name, score
FROM (SELECT market_id, country, home_decor_demand_score AS "Demand", indian_craft_affinity_score AS "Craft Affinity",
    market_entry_ease_score AS "Entry Ease", ecommerce_maturity_score AS "E-comm", regulatory_ease_score AS "Regulatory"
  FROM p1 ORDER BY priority_score DESC, market_id LIMIT 5)
UNPIVOT (score FOR score_name IN ("Demand", "Craft Affinity", "Entry Ease", "E-comm", "Regulatory"))""")
add("score_size_points", ["p1"], f"""SELECT market_id::BIGINT AS market_id, country, final_score, market_size_usd_mn, entry_tier,
  {half_even("size2*18000000 + top2*800000", "top2")}::DOUBLE/1e4 AS bubble_size
FROM (SELECT *, round(market_size_usd_mn*100)::BIGINT AS size2, round(max(market_size_usd_mn) OVER ()*100)::BIGINT AS top2 FROM p1)""")


def _scaled(col: str) -> str:
    x = f"round({col}*100)::BIGINT"
    lo, hi = f"min({x}) OVER ()", f"max({x}) OVER ()"
    return f"{half_even(f'({x} - {lo})*10000', f'({hi} - {lo})')}::DOUBLE/1e4"


add("entry_cost_heatmap", ["v2"], f"""SELECT market_id::BIGINT AS market_id, country, avg_customs_duty_pct,
  avg_transit_days_from_india, composite_score, {_scaled("avg_customs_duty_pct")} AS customs_scaled,
  {_scaled("avg_transit_days_from_india")} AS transit_scaled, {_scaled("composite_score")} AS score_scaled FROM v2""")

# --- landed cost ----------------------------------------------------------------------------

_MEANS = {"avg_fob": "avg_fob_per_unit_usd", "avg_freight": "avg_freight_per_unit_usd", "avg_insurance": "avg_insurance_per_unit_usd",
          "avg_customs": "avg_customs_per_unit_usd", "avg_port": "avg_port_per_unit_usd", "avg_last_mile": "avg_lastmile_per_unit_usd",
          "avg_demurrage": "avg_demurrage_per_unit_usd", "avg_total_lc": "avg_total_lc_per_unit_usd",
          "avg_lc_fob_ratio": "avg_lc_fob_ratio", "avg_exporter_margin": "avg_exporter_margin_pct"}
CTES["p8"] = (["v4"], f"""
SELECT country, region, {", ".join(f"{mean_even(c, 4, 4)} AS {n}" for n, c in _MEANS.items())},
  {total("total_demurrage_usd", 2)} AS total_demurrage, {whole("sum(total_shipments)")} AS total_shipments
FROM v4 GROUP BY country, region""")
add("landed_cost_by_market", ["p8"], """SELECT *, row_number() OVER (ORDER BY avg_exporter_margin DESC, country, region) AS rank,
  CASE WHEN avg_exporter_margin > 70 THEN 'green' WHEN avg_exporter_margin > 60 THEN 'amber' ELSE 'red' END AS margin_band FROM p8""")
_CAT = {"avg_fob": "avg_fob_per_unit_usd", "avg_total_lc": "avg_total_lc_per_unit_usd", "avg_lc_fob_ratio": "avg_lc_fob_ratio",
        "avg_exporter_margin": "avg_exporter_margin_pct", "freight_pct": "freight_pct_of_lc", "customs_pct": "customs_pct_of_lc",
        "lastmile_pct": "lastmile_pct_of_lc"}
add("landed_cost_by_category", ["v4"], f"""SELECT category, {", ".join(f"{mean_even(c, 4, 2)} AS {n}" for n, c in _CAT.items())}
FROM v4 GROUP BY category""")
for _name, _n in {"demurrage_hotspots": 5, "demurrage_top_10": 10}.items():
    add(_name, ["p8"], f"""SELECT row_number() OVER (ORDER BY total_demurrage DESC, country, region) AS rank, country, region,
  total_demurrage, total_shipments, avg_demurrage FROM p8 QUALIFY rank <= {_n}""")
add("high_cost_routes", ["v4"], """SELECT row_number() OVER (ORDER BY avg_lc_fob_ratio DESC, country, product_name) AS rank, country, category,
  substring(product_name, 1, 28) AS product_name, avg_fob_per_unit_usd, avg_total_lc_per_unit_usd, avg_lc_fob_ratio,
  avg_exporter_margin_pct FROM v4 QUALIFY rank <= 10""")
_PARTS = ["Freight", "Insurance", "Customs", "Port", "Last Mile"]
_cols = ["avg_freight", "avg_insurance", "avg_customs", "avg_port", "avg_last_mile"]
add("cost_components", ["p8"], " UNION ALL ".join(f"""SELECT country, region, '{label}' AS component, {col} AS cost, {i + 1}::BIGINT AS step,
  ({" + ".join(units(c, 4) for c in _cols[:i]) or "0"})::DOUBLE/1e4 AS base
FROM (SELECT * FROM p8 ORDER BY avg_exporter_margin DESC, country, region LIMIT 10)"""
    for i, (label, col) in enumerate(zip(_PARTS, _cols))))
_mean10 = lambda c: half_up(f"sum({units(c, 4)})*1000000", f"count({c})")
add("cost_waterfall", ["v4"], f"""SELECT step::BIGINT AS step, label, v::DOUBLE/1e10 AS value, abs(v)::DOUBLE/1e10 AS height,
  (CASE WHEN step IN (1, 7) THEN 0 WHEN v < 0 THEN after ELSE after - v END)::DOUBLE/1e10 AS base
FROM (SELECT *, sum(v) OVER (ORDER BY step) AS after
  FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS step,
      unnest(['FOB', 'Freight', 'Insurance', 'Customs', 'Port', 'Last Mile', 'Net LC']) AS label,
      unnest([fob, -a, -b, -c, -d, -e, fob - a - b - c - d - e]) AS v
    FROM (SELECT {_mean10("avg_fob_per_unit_usd")} AS fob, {_mean10("avg_freight_per_unit_usd")} AS a,
      {_mean10("avg_insurance_per_unit_usd")} AS b, {_mean10("avg_customs_per_unit_usd")} AS c,
      {_mean10("avg_port_per_unit_usd")} AS d, {_mean10("avg_lastmile_per_unit_usd")} AS e FROM v4)))""")

# --- products -------------------------------------------------------------------------------

add("top_products", ["v3"], """SELECT row_number() OVER (ORDER BY total_revenue_usd DESC NULLS LAST, product_id) AS rank, product_id,
  substring(product_name, 1, 37) AS product_name, category, total_revenue_usd, avg_margin_pct, markets_present,
  export_viability_tag FROM v3 QUALIFY rank <= 15""")
for _name, _word in {"viability_list": "Star", "viability_list_growth": "Growth", "viability_list_review": "Review"}.items():
    add(_name, ["v3"], f"""SELECT product_id, product_name, total_revenue_usd, avg_margin_pct, markets_present FROM v3
WHERE export_viability_tag LIKE '%{_word}%'""")
add("viability_counts", ["v3"], """SELECT count(*) FILTER (export_viability_tag LIKE '%Star%') AS star_products,
  count(*) FILTER (export_viability_tag LIKE '%Growth%') AS growth_products,
  count(*) FILTER (export_viability_tag LIKE '%Review%') AS review_products FROM v3""")
add("pricing_counts", ["v7"], """SELECT count(*) FILTER (pricing_recommendation LIKE '%Overpriced%') AS overpriced,
  count(*) FILTER (pricing_recommendation LIKE '%Underpriced%') AS underpriced,
  count(*) FILTER (pricing_recommendation LIKE '%Optimally%') AS optimally_priced FROM v7""")
add("top_underpriced", ["v7"], """SELECT row_number() OVER (ORDER BY price_gap_pct DESC NULLS LAST, country, product_name) AS rank, country,
  substring(product_name, 1, 30) AS product_name, our_avg_price_usd, avg_market_price_usd, price_gap_pct FROM v7
WHERE pricing_recommendation LIKE '%Underpriced%' QUALIFY rank <= 5""")
add("margin_revenue_points", ["v3"], f"""SELECT product_id, avg_margin_pct, total_revenue_usd, export_viability_tag,
  {half_even("markets_present*4000000 + most*500000", "most")}::DOUBLE/1e4 AS bubble_size
FROM (SELECT *, max(markets_present) OVER () AS most FROM v3)""")
add("revenue_mix", ["v14"], f"""SELECT category, subcategory, total_revenue_usd, revenue_share_pct, avg_margin_pct, product_count,
  markets_served, {half_up("rev2*1000", "sum(rev2) OVER ()")}::DOUBLE/1e1 AS pie_share_pct
FROM (SELECT *, round(total_revenue_usd*100)::BIGINT AS rev2 FROM v14)""")
CTES["index_bins"] = (["v7"], """
SELECT least((x - lo)*30 // (hi - lo), 29) AS bin, count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi
FROM (SELECT x, min(x) OVER () AS lo, max(x) OVER () AS hi FROM (SELECT round(avg_price_index*10)::BIGINT AS x FROM v7)) GROUP BY 1""")
add("price_index_histogram", ["index_bins"], """SELECT b.bin::BIGINT AS bin, e.lo/1e1 + b.bin*((e.hi/1e1 - e.lo/1e1)/30.0::DOUBLE) AS bin_start,
  e.lo/1e1 + (b.bin+1)*((e.hi/1e1 - e.lo/1e1)/30.0::DOUBLE) AS bin_end, coalesce(i.n, 0) AS n
FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN (SELECT any_value(lo) AS lo, any_value(hi) AS hi FROM index_bins) e
LEFT JOIN index_bins i ON i.bin = b.bin""")
add("category_margin_bands", ["v14"], """SELECT category, subcategory, avg_margin_pct,
  CASE WHEN avg_margin_pct >= 55 THEN 'green' WHEN avg_margin_pct >= 45 THEN 'amber' ELSE 'red' END AS margin_band FROM v14""")

# --- demand and seasonality -----------------------------------------------------------------

CTES["p23"] = (["o"], """
SELECT fiscal_year, month_num, month_name, quarter, sum(usd2)::DOUBLE/1e2 AS revenue_usd, count(*) AS total_orders,
  sum(qty)::BIGINT AS total_units, (sum(gm2)::DOUBLE/1e2)/count(gm2) AS avg_margin,
  CASE WHEN month_num IN (11, 12, 1) THEN '🎄 Peak' WHEN month_num IN (9, 10) THEN '📦 Pre-Peak'
       WHEN month_num IN (6, 7, 8) THEN '☀️ Slow' ELSE '➡️  Normal' END AS season
FROM o WHERE order_status <> 'Cancelled' GROUP BY fiscal_year, month_num, month_name, quarter""")
add("monthly_revenue_trend", ["p23"], "SELECT * FROM p23")
_GROWTH = f"""{mean("avg_yoy_growth_pct", 2)} AS avg_yoy_growth, {mean("avg_trends_score", 1)} AS avg_trends,
  {whole("sum(total_demand_units)")} AS total_demand"""
add("fastest_growing_markets", ["v11"], f"""SELECT *, row_number() OVER (ORDER BY avg_yoy_growth DESC, country, region) AS rank
FROM (SELECT country, region, {_GROWTH}, {whole("sum(total_search_volume)")} AS total_search FROM v11 GROUP BY country, region)
QUALIFY rank <= 10""")
CTES["p26"] = (["v13"], f"""
SELECT country, {total("total_revenue_usd", 2)} AS total_revenue_usd FROM v13 GROUP BY country
ORDER BY total_revenue_usd DESC, country LIMIT 5""")
add("top_seasonal_markets", ["p26"], "SELECT * FROM p26")
add("peak_slow_months", ["v13", "p26"], f"""SELECT country,
  string_agg(month_name, ', ' ORDER BY down) FILTER (down <= 3) AS peak_months,
  string_agg(month_name, ', ' ORDER BY down) FILTER (rise <= 3) AS slow_months
FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY rev DESC, month_num) AS down,
    row_number() OVER (PARTITION BY country ORDER BY rev, month_num DESC) AS rise
  FROM (SELECT country, month_num, month_name, sum({units("total_revenue_usd", 2)}) AS rev FROM v13 SEMI JOIN p26 USING (country)
    GROUP BY country, month_num, month_name))
GROUP BY country""")
add("demand_by_category", ["v11"], f"""SELECT *, least(greatest(trunc(avg_yoy_growth/2), 0), 30)::BIGINT AS bar_length
FROM (SELECT category, {_GROWTH} FROM v11 GROUP BY category)""")
_YEARS = range(1995, 2002)
add("revenue_by_month_pivot", ["p23"], f"""SELECT month_num,
  {", ".join(f"sum(revenue_usd) FILTER (fiscal_year = {y}) AS revenue_{y}" for y in _YEARS)},
  month_num IN (11, 12, 1) AS is_peak FROM p23 GROUP BY month_num""")
add("seasonality_index", ["p23"], f"""SELECT month_num, mean_revenue_usd, seasonality_index,
  CASE WHEN seasonality_index >= 1.1::DOUBLE THEN 'green' WHEN seasonality_index >= 0.95::DOUBLE THEN 'amber' ELSE 'red' END AS index_band
FROM (SELECT month_num, m6::DOUBLE/1e6 AS mean_revenue_usd,
    (m6::DOUBLE/1e6) / ((sum(m6) OVER ()::DOUBLE/1e6) / count(*) OVER ()) AS seasonality_index
  FROM (SELECT month_num, {half_up(f"sum({units('revenue_usd', 2)})*10000", "count(*)")} AS m6 FROM p23 GROUP BY month_num))""")
add("growth_by_country", ["v11"], f"""SELECT *, CASE WHEN avg_yoy > 20 THEN 'green' WHEN avg_yoy > 10 THEN 'amber' ELSE 'orange' END AS growth_band
FROM (SELECT country, {mean("avg_yoy_growth_pct", 2)} AS avg_yoy FROM v11 GROUP BY country ORDER BY avg_yoy DESC, country LIMIT 10)""")

# --- executive summary ----------------------------------------------------------------------

add("yearly_growth", ["v1"], f"""SELECT fiscal_year, rev::DOUBLE/1e2 AS revenue, orders, avg_margin,
  {real(half_up("(rev - prev)*1000", "prev"), 1)} AS growth_pct
FROM (SELECT *, lag(rev) OVER (ORDER BY fiscal_year) AS prev
  FROM (SELECT fiscal_year, sum({units("total_revenue_usd", 2)}) AS rev, {whole("sum(total_orders)")} AS orders,
    {mean("avg_gross_margin_pct", 2)} AS avg_margin FROM v1 GROUP BY fiscal_year))""")
add("top_markets", ["v2"], """SELECT row_number() OVER (ORDER BY total_revenue_usd DESC, market_id) AS rank, market_id::BIGINT AS market_id, country, region,
  total_revenue_usd, avg_margin_pct, unique_buyers, delay_rate_pct, weighted_priority_score FROM v2 QUALIFY rank <= 8""")
add("channel_rollup", ["v10"], f"""SELECT order_channel, {total("total_revenue_usd", 2)} AS revenue, {mean("avg_margin_pct", 2)} AS avg_margin,
  {mean("avg_order_value_usd", 2)} AS avg_aov, {mean("repeat_rate_pct", 2)} AS repeat_rate,
  {mean("cancellation_rate_pct", 2)} AS cancel_rate FROM v10 GROUP BY order_channel""")
add("payment_risk_summary", ["v12"], f"""SELECT count(*) FILTER (payment_risk_flag LIKE '%High%') AS high_risk_markets,
  {total("overdue_value_usd", 2)} AS total_overdue_usd, {mean("avg_dso_days", 1)} AS avg_dso_days FROM v12""")
add("high_risk_markets", ["v12"], """SELECT country, region, overdue_value_usd, avg_delay_days FROM v12 WHERE payment_risk_flag LIKE '%High%'""")
add("return_loss_share", ["v8", "v15"], f"""SELECT loss::DOUBLE/1e2 AS total_return_loss_usd, total_revenue_usd,
  {real(half_up("loss*10000", units("total_revenue_usd", 2)), 2)} AS loss_pct_of_revenue
FROM (SELECT coalesce(sum({units("total_return_loss_usd", 2)}), 0) AS loss FROM v8), (SELECT total_revenue_usd FROM v15)""")
add("top_return_reasons", ["v8"], f"""SELECT row_number() OVER (ORDER BY total_returns DESC, top_return_reason) AS rank, *
FROM (SELECT top_return_reason, {whole("sum(total_returns)")} AS total_returns FROM v8 GROUP BY 1) QUALIFY rank <= 3""")
add("delay_by_market", ["v6"], f"""SELECT country, total_ships, delayed_ships, total_dem, delay_pct,
  row_number() OVER (ORDER BY delay_pct DESC, country) AS rank, overall_delay_pct, overall_demurrage_usd
FROM (SELECT country, {whole("sum(total_shipments)")} AS total_ships, {whole("sum(delayed_shipments)")} AS delayed_ships,
    {total("total_demurrage_usd", 2)} AS total_dem, {half_even("sum(delayed_shipments)*10000", "sum(total_shipments)")}::DOUBLE/1e2 AS delay_pct
  FROM v6 GROUP BY country),
  (SELECT {half_even("sum(delayed_shipments)*1000", "sum(total_shipments)")}::DOUBLE/1e1 AS overall_delay_pct,
    {total("total_demurrage_usd", 2)} AS overall_demurrage_usd FROM v6)
QUALIFY rank <= 3""")
add("payment_distribution", ["v12"], f"""SELECT payment_status, orders, {half_up("orders*1000", "sum(orders) OVER ()")}::DOUBLE/1e1 AS share_pct
FROM (SELECT unnest(['Paid On Time', 'Paid Late', 'Pending', 'Overdue']) AS payment_status,
  unnest([sum(paid_on_time), sum(paid_late), sum(pending), sum(overdue)])::BIGINT AS orders FROM v12)""")
add("return_loss_by_market", ["v8"], f"""SELECT row_number() OVER (ORDER BY total_return_loss_usd DESC, country) AS rank, *
FROM (SELECT country, {total("total_return_loss_usd", 2)} AS total_return_loss_usd FROM v8 GROUP BY country) QUALIFY rank <= 10""")
_billion = real(half_up(units("total_revenue_usd", 2), "1000000000"), 2)
_million = real(half_up(units("total_demurrage_usd", 2), "1000000"), 2)
add("kpi_tiles", ["v15"], f"""SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8])::BIGINT AS tile,
  unnest(['Total Revenue', 'Gross Margin', 'Total Orders', 'Active Markets', 'Active Buyers', 'Avg Transit', 'Total Returns', 'Demurrage Cost']) AS label,
  unnest([{_billion}, {real(half_up(units("avg_gross_margin_pct", 2), "10"), 1)}, total_orders::DOUBLE, markets_active::DOUBLE,
    total_buyers::DOUBLE, avg_transit_days, total_returns::DOUBLE, {_million}]) AS value,
  unnest(['USD billion', '%', '', '', '', 'days', '', 'USD million']) AS unit FROM v15""")
