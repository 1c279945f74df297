"""The nine star tables as CTEs over the test tables, money in integer units.

Suffix of a column: number of fraction digits it is scaled by (``usd2`` is cents).
"""

from duck_oracle.ints import half_even, half_even_signed, pick

AS_OF = "2001-06-30"
RECENCY_AS_OF = "2001-08-01"

_MAPPED_REGION = """CASE r_name WHEN 'AMERICA' THEN 'North America' WHEN 'MIDDLE EAST' THEN 'Middle East'
  WHEN 'EUROPE' THEN 'Europe' WHEN 'ASIA' THEN 'Asia Pacific' WHEN 'AFRICA' THEN 'Africa' ELSE r_name END"""


def _numbered(name: str, number: str, count: int) -> str:
    return f"'{name} ' || (({number}) % {count} + 1)"


def _rate(region: str, na: int, me: int, eu: int, ap: int, af: int, other: int) -> str:
    return (
        f"CASE {region} WHEN 'North America' THEN {na} WHEN 'Middle East' THEN {me} WHEN 'Europe' THEN {eu} "
        f"WHEN 'Asia Pacific' THEN {ap} WHEN 'Africa' THEN {af} ELSE {other} END"
    )


def _calendar(day: str) -> str:
    return f"""year({day}) AS fiscal_year, 'Q' || quarter({day}) AS quarter, month({day}) AS month_num,
  monthname({day}) AS month_name, weekofyear({day}) AS week_num"""


def _lifted(score: str) -> str:
    return f"least({score} + CASE WHEN n_nationkey % 8 = 3 THEN 25 ELSE 0 END, 99)"


# name -> (dependencies, SQL)
CTES: dict[str, tuple[list[str], str]] = {}

CTES["m"] = ([], f"""
SELECT *, (dem1+entry1+reg1+craft1+ecom1)*2 AS comp2,
  CASE WHEN (dem1+entry1+reg1+craft1+ecom1)*2 <= 0 THEN NULL
       WHEN (dem1+entry1+reg1+craft1+ecom1)*2 <= 650 THEN 'Tier 4'
       WHEN (dem1+entry1+reg1+craft1+ecom1)*2 <= 750 THEN 'Tier 3'
       WHEN (dem1+entry1+reg1+craft1+ecom1)*2 <= 850 THEN 'Tier 2'
       WHEN (dem1+entry1+reg1+craft1+ecom1)*2 <= 1000 THEN 'Tier 1' END AS market_tier
FROM (SELECT *, {_lifted("50 + n_nationkey*7 % 50")} AS dem1, {_lifted("55 + n_nationkey*13 % 45")} AS entry1, {_lifted("50 + n_nationkey*19 % 42")} AS reg1,
  {_lifted("30 + n_nationkey*11 % 60")} AS craft1, {_lifted("70 + n_nationkey*17 % 28")} AS ecom1
FROM (SELECT n_nationkey, n_nationkey AS market_id, n_name AS country, {_MAPPED_REGION} AS region,
  {pick(["USD", "EUR", "GBP", "AED", "SGD", "ZAR", "JPY"], "n_nationkey")} AS currency,
  600000 + (n_nationkey % 11) * 40375 AS fx4,
  n_nationkey*5 % 21 AS duty, 'Marketplace ' || (n_nationkey % 6) AS marketplace,
  5000 + n_nationkey*3701 % 80000 AS gdp, 280 + n_nationkey*613 % 5000 AS size_mn,
  10 + n_nationkey*7 % 15 AS transit, 20 + n_nationkey*23 % 60 AS risk1
  FROM nation JOIN region ON n_regionkey = r_regionkey))""")

CTES["p"] = ([], f"""
SELECT *, {half_even("cogs2*32", "1000")} AS mrp0,
  {half_even_signed("(fob4*835 - cogs2*1000)*1000", "fob4*835")} AS india1
FROM (SELECT p_partkey AS product_id, printf('SKU-%03d', p_partkey) AS sku_code,
  p_name || ' #' || p_partkey AS product_name, p_type AS category, p_brand AS subcategory,
  p_size::BIGINT*12500 AS w3, round(p_retailprice*100)::BIGINT*(CASE WHEN p_brand LIKE '%3' THEN 70 ELSE 40 END) AS cogs2, round(p_retailprice*100)::BIGINT*200 AS fob4,
  CASE WHEN p_partkey % 7 <> 0 THEN 'Y' ELSE 'N' END AS is_handmade,
  CASE WHEN p_partkey % 5 <> 0 THEN 'Y' ELSE 'N' END AS is_sustainable,
  {_numbered("Cluster", "p_partkey", 10)} AS artisan_cluster
  FROM part)""")

CTES["c"] = (["m"], f"""
SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS customer_type, market_id, country,
  country || ' City ' || (c_custkey % 4) AS city,
  {_numbered("Class", "c_custkey", 4)} AS customer_tier,
  ((c_custkey % 6 + 1) * 14)::INT AS terms, 'Manager ' || (c_custkey % 6) AS account_manager
FROM customer JOIN m ON c_nationkey = market_id WHERE c_custkey % 97 <> 5""")
CTES["c_all"] = (["m"], "SELECT c_custkey AS customer_id FROM customer JOIN m ON c_nationkey = market_id")

CTES["fx0"] = ([], """
SELECT CASE event_type WHEN 'view' THEN 'USD' WHEN 'click' THEN 'EUR' WHEN 'purchase' THEN 'GBP'
    WHEN 'signup' THEN 'AED' WHEN 'error' THEN 'SGD' END AS currency_code,
  make_date((1995 + (event_id // 12) % 7)::INT, (event_id % 12 + 1)::INT, ((event_id // 84) % 28 + 1)::INT) AS date,
  500000 + max(round(value*100)::BIGINT)*10 AS rate4
FROM events GROUP BY ALL""")

CTES["fx"] = (["fx0"], f"""
SELECT currency_code, date, rate4, year(date) AS year, month(date) AS month,
  CASE WHEN prev IS NULL THEN 0 ELSE {half_even_signed("(rate4-prev)*1000000", "prev")} END AS change4
FROM (SELECT *, lag(rate4) OVER (PARTITION BY currency_code ORDER BY date) AS prev FROM fx0)""")

CTES["lines"] = ([], """
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate,
  l_extendedprice, l_quantity, l_discount, l_linestatus, l_returnflag) - 1 AS copy_no FROM lineitem""")

CTES["ol"] = (["lines", "m", "p"], f"""
SELECT (l_orderkey*8 + l_linenumber)*1048576 + copy_no AS order_id, l_orderkey*8 + l_linenumber + copy_no*104729 AS mixed, o_orderdate::DATE AS order_date, l_partkey AS product_id,
  c_nationkey AS market_id, o_custkey AS customer_id, l_quantity::INT AS qty,
  {half_even("round(l_extendedprice*100)::BIGINT*100*(CASE WHEN month(o_orderdate) >= 11 THEN 5 ELSE 4 END)", "l_quantity::INT*4")} AS price4,
  round(l_discount*100)::INT AS disc, fx4, cogs2, ((o_custkey % 6 + 1) * 14)::INT AS terms,
  ((l_orderkey*31 + l_linenumber*7) % (8 + c_nationkey*3) - 5)::INT AS delay,
  {_numbered("Channel", "l_suppkey", 7)} AS order_channel,
  CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Shipped'
    ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'Cancelled' ELSE 'Processing' END END AS order_status,
  CASE WHEN l_linenumber <= 4 THEN 'Y' ELSE 'N' END AS is_repeat, l_linestatus, l_returnflag, l_suppkey
FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
JOIN p ON p.product_id = l_partkey JOIN m ON m.market_id = c_nationkey""")

CTES["o1"] = (["ol"], f"""SELECT *, {half_even("price4*(100-disc)", "100")} AS net4 FROM ol""")
CTES["o2"] = (["o1"], f"""
SELECT *, {half_even("net4*qty", "100")} AS usd2, {half_even("cogs2*112", "100")} AS unit_cogs2 FROM o1""")
CTES["o3"] = (["o2"], f"""
SELECT *, {half_even("usd2*fx4", "10000")}::BIGINT AS inr2, (unit_cogs2*qty)::BIGINT AS tcogs2 FROM o2""")
CTES["o"] = (["o3"], f"""
SELECT * REPLACE (usd2::BIGINT AS usd2, net4::BIGINT AS net4), inr2 - tcogs2 AS gp2,
  CASE WHEN inr2 <= 0 OR inr2 <= tcogs2 THEN 0
       ELSE least({half_even("(inr2-tcogs2)*10000", "inr2")}, 9200) END::BIGINT AS gm2,
  order_date + terms AS due_date, order_date + terms + delay AS received_date,
  CASE WHEN order_date > DATE '{AS_OF}' THEN 'Pending' WHEN delay <= 0 THEN 'Paid On Time'
       WHEN delay <= 15 THEN 'Paid Late' WHEN order_date + terms + delay > DATE '{AS_OF}' THEN 'Pending'
       ELSE 'Overdue' END AS payment_status,
  {_calendar("order_date")}
FROM o3""")

CTES["s0"] = (["o", "p", "m"], f"""
SELECT o.*, region, w3, duty,
  ({_rate("region", 48, 32, 42, 35, 55, 42)}) * w3 * 10 AS freight6, {half_even("net4*10000", "10000")} AS ins6,
  ({_rate("region", 35, 28, 32, 25, 40, 32)}) * 10000 AS lm6,
  {half_even("85000000", "greatest(qty, 1)")} AS port6,
  (CASE WHEN mixed % 10 = 0 THEN 50 + mixed % 350 ELSE 0 END) * 100 AS dem2,
  CASE WHEN mixed % 11 < 2 THEN 1 + mixed % 14 ELSE 0 END AS delay_days,
  ({_rate("region", 22, 10, 23, 13, 18, 20)}) + mixed % 8 - 2 AS planned_days
FROM o JOIN p USING (product_id) JOIN m USING (market_id)
WHERE order_status = 'Delivered' AND l_linestatus = 'F'""")
CTES["s1"] = (["s0"], f"""
SELECT *, net4*100 + freight6 + ins6 AS cif6, {half_even("(net4*100 + freight6 + ins6)*duty", "100")} AS cus6
FROM s0""")
CTES["s2"] = (["s1"], f"""
SELECT *, {half_even("freight6*qty", "10000")}::BIGINT AS freight2, {half_even("ins6*qty", "10000")}::BIGINT AS ins2,
  {half_even("cif6*qty", "10000")}::BIGINT AS cif2, {half_even("cus6*qty", "10000")}::BIGINT AS cus2,
  {half_even("port6*qty", "10000")}::BIGINT AS port2, {half_even("lm6*qty", "10000")}::BIGINT AS lm2,
  {half_even("(cif6+cus6+port6+lm6)*qty + dem2*10000", "10000")}::BIGINT AS lc2
FROM s1""")
CTES["s"] = (["s2"], f"""
SELECT order_id AS shipment_id, order_id, product_id, market_id, customer_id, qty, net4, usd2, region,
  freight2, ins2, cif2, cus2, port2, lm2, dem2, lc2, usd2 - freight2 - ins2 AS net2,
  {half_even("lc2*10000", "greatest(usd2, 1)")}::BIGINT AS ratio4,
  delay_days, CASE WHEN delay_days > 0 THEN 'Y' ELSE 'N' END AS is_delayed,
  (order_date + (1 + mixed % 3)::INT) AS shipment_date,
  (order_date + (1 + mixed % 3 + planned_days)::INT) AS eta,
  (order_date + (1 + mixed % 3 + planned_days + delay_days)::INT) AS arrival,
  (planned_days + delay_days)::BIGINT AS transit_days,
  CASE WHEN delay_days > 0 THEN 'Delayed' WHEN mixed % 20 < 17 THEN 'Delivered' ELSE 'In Transit' END AS shipment_status,
  {_numbered("Carrier", "l_suppkey", 9)} AS shipping_line,
  {_numbered("Port", "l_suppkey", 5)} AS port_of_loading,
  region || ' Port ' || (l_suppkey % 3) AS port_of_discharge,
  {_numbered("Container", "mixed", 6)} AS container_type,
  CASE WHEN mixed % 8 < 5 THEN {_numbered("Delay reason", "mixed % 8", 5)} ELSE 'None' END AS delay_reason,
  1 + mixed % 9 AS customs_days
FROM s2""")

CTES["pr0"] = (["lines"], f"""
SELECT *, {half_even("our2*(85 + product_id % 21 * 3)", "100")} AS c1, {half_even("our2*(65 + market_id % 21 * 3)", "100")} AS c2,
  {half_even("our2*(80 + product_id % 3 * 20)", "100")} AS c3
FROM (SELECT l_shipdate::DATE AS date, l_partkey AS product_id, s_nationkey AS market_id,
  {half_even("max(round(l_extendedprice*100)::BIGINT)*5", "100")} AS our2
  FROM lines JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)""")
# landed cost: ((fob*1.01 + weight*0.42) * (1 + duty) + 0.30) * 300 + 85, over 300
CTES["tp"] = (["p", "m"], f"""
SELECT *, {half_even("lc4*(gdp::BIGINT*3 + 260000)", "130000*100")} AS target2, {half_even("(gdp::BIGINT*3 + 260000)*1000000", "130000")} AS premium6
FROM (SELECT product_id, market_id, gdp,
  {half_even("((fob4*101 + w3*420)*(100+duty) + 30000000)*3 + 85000000", "30000")} AS lc4
  FROM p, m)""")
CTES["pr"] = (["pr0", "tp"], f"""
SELECT date, product_id, market_id, our2::BIGINT AS our2, c1::BIGINT AS c1, c2::BIGINT AS c2, c3::BIGINT AS c3,
  greatest(avg2, 1)::BIGINT AS avg2,
  lc4::BIGINT AS lc4, {half_even("our2*1000", "greatest(avg2, 1)")}::BIGINT AS index1,
  CASE WHEN our2*100 <= lc4 THEN 0 ELSE least({half_even("(our2*100 - lc4)*100", "greatest(our2, 1)")}, 9200) END::BIGINT AS margin2,
  month(date) AS month_num, year(date) AS fiscal_year
FROM (SELECT *, {half_even("c1+c2+c3", "3")} AS avg2 FROM pr0) JOIN tp USING (product_id, market_id)""")

CTES["d0"] = ([], """
SELECT ts::DATE AS date, event_id % (SELECT count(*) FROM part) AS product_id, user_id % (SELECT count(*) FROM nation) AS market_id,
  max(round(value*100)::BIGINT) AS peak2, (sum(round(value*100)::BIGINT) // 100)::BIGINT AS search
FROM events GROUP BY ALL""")
CTES["d"] = (["d0"], f"""
SELECT *, {half_even("least(greatest(peak2, 1000), 10000)", "10")}::BIGINT AS trends1,
  {half_even_signed("peak2*2 - 20000 + CASE market_id % 8 WHEN 7 THEN 35000 WHEN 6 THEN 25000 ELSE 0 END", "10")}::BIGINT AS yoy2, search*3 // 2 AS social, search // 3 AS demand_units,
  greatest(80000 // greatest(search // 3, 1), 1)::BIGINT AS bsr,
  ([1200, 950, 900, 880, 920, 950, 980, 1000, 1050, 1100, 1250, 1350])[month(date)] AS season3,
  {_calendar("date")}
FROM d0""")

CTES["r0"] = (["o"], f"""
SELECT *, greatest({half_even("qty*(5 + mixed % 6)", "100")}, 1)::BIGINT AS rqty, (7 + mixed % 48)::INT AS days
FROM o WHERE order_status = 'Delivered' AND l_returnflag = 'R'""")
CTES["r1"] = (["r0"], f"""SELECT *, {half_even("rqty*net4", "100")}::BIGINT AS refund2 FROM r0""")
CTES["r"] = (["r1"], f"""
SELECT order_id AS return_id, order_id, product_id, market_id, customer_id, order_date + days AS return_date, rqty, days,
  refund2, ship2, refund2 + ship2 AS loss2,
  {_numbered("Return reason", "l_suppkey", 8)} AS return_reason
FROM (SELECT *, {half_even("refund2*(4 + mixed % 7)", "100")}::BIGINT AS ship2 FROM r1)""")


def statement(body: str, needs: list[str], ctes: dict[str, tuple[list[str], str]]) -> str:
    """WITH statement holding the named CTEs and all they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dep in ctes[name][0]:
                visit(dep)
            if name not in ordered:
                ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({ctes[name][1]})" for name in ordered)
    return f"WITH {parts}\n{body}"
