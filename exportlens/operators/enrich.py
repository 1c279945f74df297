"""Row-level business formulas.

All money arithmetic is decimal. Intermediate values are rounded where the business rule rounds
them, half to even. Dimension lookups are plain equi-joins on the dimension's key without a hint:
Spark broadcasts a dimension below ``spark.sql.autoBroadcastJoinThreshold`` (checked on estimated
and, under adaptive execution, on actual size) and otherwise shuffles, splitting skewed keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.functions import band, bin_right, clamp, dec, padded_id, round_half_even, round_ratio
from exportlens.operators.series import with_previous

# Business constants.
FX_BASE = Decimal("83.5")
MRP_FACTOR = Decimal("3.2")
COGS_OVERHEAD = Decimal("1.12")
MARGIN_CAP = Decimal("92")
INSURANCE_RATE = Decimal("0.01")
PORT_FLAT_USD = Decimal("85")
MIN_ORDER_QTY = 300
PANEL_FREIGHT_PER_KG = Decimal("0.42")
PANEL_LAST_MILE = Decimal("0.30")
GDP_REFERENCE = 65000
DEFAULT_TERMS_DAYS = 30
RATE_BAND = (Decimal("0.88"), Decimal("1.12"))

# Freight per kg, last mile per unit and base transit days by region, then defaults.
FREIGHT_PER_KG = {
    "North America": Decimal("0.48"),
    "Middle East": Decimal("0.32"),
    "Europe": Decimal("0.42"),
    "Asia Pacific": Decimal("0.35"),
    "Africa": Decimal("0.55"),
}
LAST_MILE_PER_UNIT = {
    "North America": Decimal("0.35"),
    "Middle East": Decimal("0.28"),
    "Europe": Decimal("0.32"),
    "Asia Pacific": Decimal("0.25"),
    "Africa": Decimal("0.40"),
}
TRANSIT_DAYS = {"North America": 22, "Middle East": 10, "Europe": 23, "Asia Pacific": 13, "Africa": 18}
DEFAULT_FREIGHT = Decimal("0.42")
DEFAULT_LAST_MILE = Decimal("0.32")
DEFAULT_TRANSIT = 20

# Seasonality factor, January to December.
SEASON = [
    Decimal("1.20"), Decimal("0.95"), Decimal("0.90"), Decimal("0.88"), Decimal("0.92"), Decimal("0.95"),
    Decimal("0.98"), Decimal("1.00"), Decimal("1.05"), Decimal("1.10"), Decimal("1.25"), Decimal("1.35"),
]

SCORE_COLUMNS = [
    "home_decor_demand_score", "market_entry_ease_score", "regulatory_ease_score",
    "indian_craft_affinity_score", "ecommerce_maturity_score",
]
TIER_EDGES = [Decimal("0"), Decimal("6.5"), Decimal("7.5"), Decimal("8.5"), Decimal("10")]
TIER_LABELS = ["Tier 4", "Tier 3", "Tier 2", "Tier 1"]


def with_lookup(df: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Attach dimension attributes by key; rows without a partner get the stated defaults."""
    renamed = {c: f"_dim_{c}" for c in defaults}
    side = dim.select(key, *defaults).withColumnsRenamed(renamed)
    out = df.join(side, key, "left")
    filled = {
        c: F.coalesce(F.col(renamed[c]), F.lit(default)) if default is not None else F.col(renamed[c])
        for c, default in defaults.items()
    }
    return out.withColumns(filled).drop(*renamed.values())


def by_region(region: Column | str, rates: Mapping[str, object], default) -> Column:
    """Rate table lookup by region, with the default for any other region."""
    region = F.col(region) if isinstance(region, str) else region
    entries = [x for name, rate in rates.items() for x in (F.lit(name), F.lit(rate))]
    return F.coalesce(F.try_element_at(F.create_map(*entries), region), F.lit(default))


# --- products and markets -------------------------------------------------------------------


def product_margins(products: DataFrame, fx: Decimal = FX_BASE) -> DataFrame:
    """Domestic margin percent on the FOB price in INR, and list price from cost."""
    revenue = dec("fob_price_usd", 10, 4) * F.lit(fx)
    margin = round_ratio((revenue - dec("cogs_inr", 10, 2)) * 100, revenue, 1, scale=6, even=True)
    mrp = round_half_even(dec("cogs_inr", 10, 2) * F.lit(MRP_FACTOR), 0)
    return products.withColumns(
        {"gross_margin_pct_india": dec(margin, 5, 1), "india_mrp_inr": dec(mrp, 10, 2)}
    )


def composite_score(markets: DataFrame, cols: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Mean of the component scores."""
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    score = round_ratio(total, F.lit(len(cols)), 2, scale=1, even=True)
    return markets.withColumn("composite_score", dec(score, 4, 2))


def market_tier(markets: DataFrame) -> DataFrame:
    """Tier of the composite score; a score on an edge belongs to the lower-scored bin."""
    return markets.withColumn("market_tier", bin_right("composite_score", TIER_EDGES, TIER_LABELS))


# --- orders ---------------------------------------------------------------------------------


def order_economics(lines: DataFrame) -> DataFrame:
    """Price, revenue, cost, profit and margin of an order line.

    Needs ``fob_price_usd_per_unit, discount_pct, quantity_units, exchange_rate_on_date, cogs_inr``.
    Margin is 0 without revenue and is then limited to 0..92.
    """
    keep = F.lit(Decimal(100)) - dec("discount_pct", 5, 2)
    net = round_half_even(dec("fob_price_usd_per_unit", 10, 4) * keep * F.lit(Decimal("0.01")), 4)
    out = lines.withColumn("net_fob_price_usd", dec(net, 10, 4))
    usd = round_half_even(F.col("net_fob_price_usd") * dec("quantity_units", 10, 0), 2)
    out = out.withColumn("total_fob_value_usd", dec(usd, 14, 2))
    inr = round_half_even(F.col("total_fob_value_usd") * dec("exchange_rate_on_date", 10, 4), 2)
    unit_cost = round_half_even(dec("cogs_inr", 10, 2) * F.lit(COGS_OVERHEAD), 2)
    out = out.withColumns({
        "total_fob_value_inr": dec(inr, 16, 2),
        "cogs_inr_per_unit": dec(unit_cost, 10, 2),
    })
    out = out.withColumn(
        "total_cogs_inr", dec(F.col("cogs_inr_per_unit") * dec("quantity_units", 10, 0), 16, 2)
    )
    out = out.withColumn(
        "gross_profit_inr", dec(F.col("total_fob_value_inr") - F.col("total_cogs_inr"), 16, 2)
    )
    revenue = F.col("total_fob_value_inr")
    raw = round_half_even(F.col("gross_profit_inr") * F.lit(100) / F.nullif(revenue, F.lit(0)), 2)
    margin = F.when(revenue > 0, raw).otherwise(F.lit(Decimal("0.00")))
    return out.withColumn("gross_margin_pct", dec(clamp(margin, Decimal("0.00"), MARGIN_CAP), 7, 2))


def payment_dates(orders: DataFrame) -> DataFrame:
    """Due date from the terms, received date from the delay."""
    due = F.date_add("order_date", F.col("payment_terms_days"))
    return orders.withColumn("payment_due_date", due).withColumn(
        "payment_received_date", F.date_add("payment_due_date", F.col("payment_delay_days"))
    )


def payment_status(orders: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Paid On Time, Paid Late, Pending or Overdue as seen on ``as_of``."""
    today = F.lit(as_of).cast("date")
    delay = F.col("payment_delay_days")
    status = band(
        [
            (F.col("order_date") > today, "Pending"),
            (delay <= 0, "Paid On Time"),
            (delay <= 15, "Paid Late"),
            (F.col("payment_received_date") > today, "Pending"),
        ],
        "Overdue",
    )
    return orders.withColumn("payment_status", status)


def calendar_columns(df: DataFrame, date_col: str) -> DataFrame:
    """Year, quarter label, month number and name, ISO week."""
    day = F.col(date_col)
    return df.withColumns({
        "fiscal_year": F.year(day),
        "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "week_num": F.weekofyear(day),
    })


# --- shipments ------------------------------------------------------------------------------


def landed_cost(shipments: DataFrame, products: DataFrame | None, markets: DataFrame) -> DataFrame:
    """Freight, insurance, CIF, customs, port, last mile, landed total and LC/FOB ratio.

    Needs ``product_id, market_id, quantity_units, net_fob_price_usd, total_fob_value_usd,
    demurrage_charges_usd``; reads weight from the product, duty and region from the market.
    Without ``products`` the shipments have ``weight_kg`` themselves.
    """
    df = shipments if products is None else with_lookup(shipments, products, "product_id", {"weight_kg": None})
    df = with_lookup(df, markets, "market_id", {"avg_customs_duty_pct": None, "region": None})
    qty = dec("quantity_units", 10, 0)
    df = df.withColumns({
        "_fob": dec("net_fob_price_usd", 10, 4),
        "_freight": by_region("region", FREIGHT_PER_KG, DEFAULT_FREIGHT) * dec("weight_kg", 8, 3),
        "_insurance": round_half_even(dec("net_fob_price_usd", 10, 4) * F.lit(INSURANCE_RATE), 6),
        "_last_mile": by_region("region", LAST_MILE_PER_UNIT, DEFAULT_LAST_MILE),
        "_port": round_half_even(F.lit(PORT_FLAT_USD) / F.greatest(qty, F.lit(1)), 6),
    })
    df = df.withColumn("_cif", dec(F.col("_fob") + F.col("_freight") + F.col("_insurance"), 16, 6))
    duty = dec("avg_customs_duty_pct", 5, 2) * F.lit(Decimal("0.01"))
    df = df.withColumn("_customs", dec(round_half_even(F.col("_cif") * duty, 6), 16, 6))
    unit_total = dec(F.col("_cif") + F.col("_customs") + F.col("_port") + F.col("_last_mile"), 17, 6)
    total = lambda unit: round_half_even(F.col(unit) * qty, 2)
    landed = round_half_even(unit_total * qty + dec("demurrage_charges_usd", 12, 2), 2)
    df = df.withColumns({
        "declared_value_usd": dec("total_fob_value_usd", 14, 2),
        "freight_cost_usd": dec(total("_freight"), 12, 2),
        "insurance_usd": dec(total("_insurance"), 12, 2),
        "cif_value_usd": dec(total("_cif"), 14, 2),
        "customs_duty_usd": dec(total("_customs"), 12, 2),
        "port_handling_usd": dec(total("_port"), 12, 2),
        "last_mile_usd": dec(total("_last_mile"), 12, 2),
        "total_landed_cost_usd": dec(landed, 14, 2),
    })
    base = F.greatest(F.col("declared_value_usd"), F.lit(Decimal("0.01")))
    net = F.col("declared_value_usd") - F.col("freight_cost_usd") - F.col("insurance_usd")
    return df.withColumns({
        "landed_to_fob_ratio": dec(round_half_even(F.col("total_landed_cost_usd") / base, 4), 8, 4),
        "exporter_net_margin_usd": dec(net, 14, 2),
    }).drop("_fob", "_freight", "_insurance", "_last_mile", "_port", "_cif", "_customs")


def shipment_timing(shipments: DataFrame) -> DataFrame:
    """Ship date, ETA, arrival, transit days, delay flag and status.

    Needs ``order_date, handling_days, transit_variation_days, delay_days, region`` and the status
    an undelayed shipment has, ``planned_status``.
    """
    planned = by_region("region", TRANSIT_DAYS, DEFAULT_TRANSIT) + F.col("transit_variation_days")
    df = shipments.withColumns({
        "shipment_date": F.date_add("order_date", F.col("handling_days")),
        "total_transit_days": (planned + F.col("delay_days")).cast("int"),
    })
    late = F.col("delay_days") > 0
    return df.withColumns({
        "estimated_arrival_date": F.date_add("shipment_date", planned.cast("int")),
        "actual_arrival_date": F.date_add("shipment_date", F.col("total_transit_days")),
        "is_delayed": F.when(late, F.lit("Y")).otherwise(F.lit("N")),
        "shipment_status": F.when(late, F.lit("Delayed")).otherwise(F.col("planned_status")),
    })


# --- prices ---------------------------------------------------------------------------------


def target_price(pairs: DataFrame, products: DataFrame, markets: DataFrame) -> DataFrame:
    """Landed cost per unit and the price the market's premium supports, per product and market."""
    df = pairs.join(products.select("product_id", "fob_price_usd", "weight_kg"), "product_id").join(
        markets.select("market_id", "avg_customs_duty_pct", "gdp_per_capita_usd"), "market_id"
    )
    fob = dec("fob_price_usd", 10, 4)
    cif = dec(fob + dec("weight_kg", 8, 3) * F.lit(PANEL_FREIGHT_PER_KG) + fob * F.lit(INSURANCE_RATE), 16, 6)
    dutied = cif * (F.lit(Decimal(100)) + dec("avg_customs_duty_pct", 5, 2)) * F.lit(Decimal("0.01"))
    fixed = dutied + F.lit(PANEL_LAST_MILE)
    qty = F.lit(Decimal(MIN_ORDER_QTY))
    cost = round_ratio(fixed * qty + F.lit(PORT_FLAT_USD), qty, 4, scale=10, even=True)
    df = df.withColumn("landed_cost_usd", dec(cost, 10, 4))
    # premium = gdp / 65000 * 1.5 + 2, kept as a fraction over 2 * 65000
    premium = F.col("gdp_per_capita_usd") * F.lit(3) + F.lit(4 * GDP_REFERENCE)
    whole = F.lit(Decimal(2 * GDP_REFERENCE))
    price = F.col("landed_cost_usd") * dec(premium, 12, 0)
    return df.withColumns({
        "market_premium": round_ratio(dec(premium, 12, 0), whole, 6, scale=0, even=True),
        "target_price_usd": round_ratio(price, whole, 2, scale=4, even=True),
    })


def price_benchmark(pricing: DataFrame) -> DataFrame:
    """Competitor average, price index, class and margin on our price.

    Needs ``our_price_usd, competitor1_price_usd .. competitor3_price_usd, landed_cost_usd``.
    Prices are floored at 0.01.
    """
    cent = F.lit(Decimal("0.01"))
    prices = ["our_price_usd", "competitor1_price_usd", "competitor2_price_usd", "competitor3_price_usd"]
    raw = {c: dec(c, 10, 2) for c in prices}
    average = round_half_even((raw[prices[1]] + raw[prices[2]] + raw[prices[3]]) / F.lit(3), 2)
    ours = raw["our_price_usd"]
    index = round_half_even(ours * F.lit(100) / F.greatest(average, cent), 1)
    margin = round_half_even(
        (ours - dec("landed_cost_usd", 10, 4)) * F.lit(100) / F.greatest(ours, cent), 2
    )
    df = pricing.withColumns({
        "our_price_index": dec(index, 6, 1),
        "gross_margin_on_our_price_pct": dec(clamp(margin, Decimal("0.00"), MARGIN_CAP), 7, 2),
        "avg_competitor_price_usd": dec(F.greatest(average, cent), 10, 2),
        **{c: dec(F.greatest(raw[c], cent), 10, 2) for c in prices},
    })
    return df.withColumn(
        "price_competitiveness",
        band(
            [(F.col("our_price_index") > 110, "Premium"), (F.col("our_price_index") > 90, "Competitive")],
            "Below Market",
        ),
    )


# --- demand ---------------------------------------------------------------------------------


def demand_signals(demand: DataFrame) -> DataFrame:
    """Trend class from search growth, sales rank from demand units."""
    growth = F.col("yoy_search_growth_pct")
    units = F.greatest(F.col("estimated_demand_units"), F.lit(1))
    rank = F.greatest(F.call_function("div", F.lit(80000), units), F.lit(1))
    return demand.withColumns({
        "demand_trend": band([(growth > 10, "Growing"), (growth < -5, "Declining")], "Stable"),
        "amazon_bsr": rank.cast("int"),
    })


def seasonality_factor(date_col: Column | str, factors: Sequence[Decimal] = SEASON) -> Column:
    """Monthly demand factor of a date."""
    return F.element_at(F.array(*[F.lit(f) for f in factors]), F.month(date_col))


# --- returns --------------------------------------------------------------------------------


def return_economics(returns: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Refund, shipping, net loss and calendar of a return.

    Needs ``return_quantity, return_shipping_rate_pct, days_to_return`` and, unless ``orders`` is
    given to look them up by ``order_id``, ``net_fob_price_usd`` and ``order_date``.
    """
    df = returns
    if orders is not None:
        df = df.join(orders.select("order_id", "net_fob_price_usd", "order_date"), "order_id")
    refund = round_half_even(dec("return_quantity", 10, 0) * dec("net_fob_price_usd", 10, 4), 2)
    df = df.withColumn("refund_amount_usd", dec(refund, 12, 2))
    shipping = F.col("refund_amount_usd") * dec("return_shipping_rate_pct", 5, 2) * F.lit(Decimal("0.01"))
    df = df.withColumns({
        "return_shipping_cost_usd": dec(round_half_even(shipping, 2), 10, 2),
        "return_date": F.date_add("order_date", F.col("days_to_return")),
    })
    return df.withColumns({
        "net_loss_usd": dec(F.col("refund_amount_usd") + F.col("return_shipping_cost_usd"), 12, 2),
        "return_month": F.month("return_date"),
        "return_year": F.year("return_date"),
    })


# --- currency rates -------------------------------------------------------------------------


def fx_daily_change(rates: DataFrame) -> DataFrame:
    """Percent change against the currency's previous day; 0 on its first day.

    A currency's series is spread over tasks (``operators.series``), whatever its length.
    """
    df = with_previous(rates, ["currency_code"], ["date"], "rate_to_inr", "_prev")
    change = round_ratio((F.col("rate_to_inr") - F.col("_prev")) * 100, F.col("_prev"), 4, scale=4, even=True)
    change = F.when(F.col("_prev").isNull(), F.lit(Decimal("0.0000"))).otherwise(change)
    return df.withColumn("daily_change_pct", dec(change, 8, 4)).drop("_prev")


def clamp_to_base(
    rates: DataFrame, base: DataFrame, key: str, col: str, base_col: str, band: tuple[Decimal, Decimal] = RATE_BAND
) -> DataFrame:
    """Limit a series to a band around the base value of its key."""
    df = rates.join(base.select(key, base_col), key)
    limited = clamp(F.col(col), F.col(base_col) * F.lit(band[0]), F.col(base_col) * F.lit(band[1]))
    return df.withColumn(col, dec(round_half_even(limited, 4), 10, 4)).drop(base_col)


def currency_pair(code: Column | str) -> Column:
    """Pair label of a currency quoted in rupees."""
    return F.concat(code, F.lit("/INR"))


def sku_code(number: Column | str, prefix: str = "SKU-") -> Column:
    """Stock code from the product number."""
    return padded_id(prefix, number, 3)
