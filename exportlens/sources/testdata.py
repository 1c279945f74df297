"""The nine star tables derived from the supplied TPC-H-like Parquet tables.

Every column is a rule over the given rows: the attributes the test tables lack come from keys by
modular arithmetic, and the money columns go through the same enrichment operators a user would
call. Everything is lazy; a query reads only the columns and tables its plan needs. Ids stay
numeric, which is also the cheaper key type to shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from exportlens.functions import clamp, dec, round_half_even
from exportlens.functions.packing import DAY, INT, Packing
from exportlens.operators import enrich
from exportlens.session import size_shuffles
from exportlens.sources.bucketed import bucket_count
from exportlens.sources.schemas import BUCKET_KEYS, SCHEMAS

# Last day of the order dates' half-year; payments expected after it are pending.
AS_OF = "2001-06-30"
# As-of day of customer recency, the last order date in the data.
RECENCY_AS_OF = "2001-08-01"

# An order id holds the order key, the line number and, in its lowest bits, the copy number.
COPY_BITS = 20
COPIES = 1 << COPY_BITS
# Most order lines that a part holds on average; with all figures they take some 150 MB when they are sorted.
LINES_PER_BUCKET = 1 << 18

# What a line carries through the shuffles by product and by order id besides its ids and price, in two numbers.
ORDER_STATUS = ["Delivered", "Shipped", "Cancelled", "Processing"]
PLACED = Packing(number=INT, day=DAY)
TERMS = Packing(quantity=INT, discount=(-99999, 99999), status=(0, len(ORDER_STATUS) - 1), done=(0, 1), returned=(0, 1))

CURRENCIES = ["USD", "EUR", "GBP", "AED", "SGD", "ZAR", "JPY"]
CURRENCY_OF_EVENT = {"view": "USD", "click": "EUR", "purchase": "GBP", "signup": "AED", "error": "SGD"}
REGION_OF_NAME = {
    "AMERICA": "North America", "MIDDLE EAST": "Middle East", "EUROPE": "Europe",
    "ASIA": "Asia Pacific", "AFRICA": "Africa",
}
# Numbers of distinct values of the attributes that the test tables lack.
CHANNELS, CARRIERS, LOADING_PORTS, CONTAINERS, DELAY_REASONS = 7, 9, 5, 6, 5
RETURN_REASONS, RETURN_TYPES, PROCESSING, CLUSTERS = 8, 4, 6, 10


def _numbered(name: str, number: Column, count: int) -> Column:
    """``name`` and one of ``count`` numbers from 1 on."""
    return F.concat(F.lit(f"{name} "), (number % count + 1).cast("string"))


def _terms(customer: Column) -> Column:
    """Payment terms of a customer in days."""
    return ((customer % 6 + 1) * 14).cast("int")


def _late(number: Column) -> Column:
    """A delay reason for five in eight, else the text None, which is a fixed value."""
    return F.when(number % 8 < DELAY_REASONS, _numbered("Delay reason", number % 8, DELAY_REASONS)).otherwise(F.lit("None"))


def _pick(values: list, number: Column) -> Column:
    """Value at position ``number`` modulo the list length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int") + 1)


def _mixed(order_id: str) -> Column:
    """Number that the attributes of an order line are derived from, without the gaps of its id."""
    o = F.col(order_id)
    return F.shiftright(o, COPY_BITS) + o % COPIES * 104729


def order_key(order_id: Column, number: Column) -> Column:
    """The order key that an order id was made of, given the line number."""
    return F.shiftright(F.shiftright(order_id, COPY_BITS) - number, 3)


def _hsn_number(product: Column) -> Column:
    """The HSN code of a product as a number, which is half as wide as its text."""
    return (product * 7919 % 100000000).cast("int")


def _dear(brand: Column) -> Column:
    """Brands that are dear to make, so that low margins occur: those whose name ends in 3."""
    return brand.endswith("3")


def _yes(pred: Column) -> Column:
    return F.when(pred, F.lit("Y")).otherwise(F.lit("N"))


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*SCHEMAS[table].fieldNames())


class StarTables(Mapping[str, DataFrame]):
    """Mapping of table name to a lazily built DataFrame over one test-data folder.

    ``stage`` (name, frame, keys), if set, writes the order lines with all their figures once; orders, shipments and
    returns are then derived from that table, and orders are a projection of it.
    """

    stage: Callable[[str, DataFrame, list[str]], DataFrame] | None = None

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # Tables that come dealt by the columns they are partitioned by.
    dealt = ("fact_competitor_pricing",)

    @property
    def staged(self) -> tuple[str, ...]:
        """Tables that need no writing of their own."""
        return ("fact_export_orders",) if self.stage else ()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    # --- dimensions -------------------------------------------------------------------------

    @cached_property
    def dim_markets(self) -> DataFrame:
        k = F.col("n_nationkey")
        # One market in eight is better throughout, so that the upper tiers occur.
        lift = F.when(k % 8 == 3, F.lit(25)).otherwise(F.lit(0))
        tenth = lambda base, step, span: dec(F.least(F.lit(base) + k * step % span + lift, F.lit(99)) * F.lit(Decimal("0.1")), 4, 1)
        entries = [F.lit(x) for pair in REGION_OF_NAME.items() for x in pair]
        region = F.coalesce(F.try_element_at(F.create_map(*entries), F.col("r_name")), F.col("r_name"))
        df = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        df = df.select(
            k.alias("market_id"),
            F.col("n_name").alias("country"),
            region.alias("region"),
            _pick(CURRENCIES, k).alias("currency"),
            dec(F.lit(Decimal(60)) + (k % 11) * F.lit(Decimal("4.0375")), 10, 4).alias("exchange_rate_to_inr"),
            tenth(50, 7, 50).alias("home_decor_demand_score"),
            tenth(55, 13, 45).alias("market_entry_ease_score"),
            tenth(50, 19, 42).alias("regulatory_ease_score"),
            tenth(30, 11, 60).alias("indian_craft_affinity_score"),
            tenth(70, 17, 28).alias("ecommerce_maturity_score"),
            (F.lit(100) + k * 37 % 900).alias("monthly_search_volume_k"),
            dec(k * 5 % 21, 5, 2).alias("avg_customs_duty_pct"),
            _yes(k % 3 != 0).alias("amazon_presence"),
            F.concat(F.lit("Marketplace "), (k % 6).cast("string")).alias("primary_marketplace"),
            (F.lit(5000) + k * 3701 % 80000).alias("gdp_per_capita_usd"),
            dec(F.lit(280) + k * 613 % 5000, 10, 2).alias("market_size_usd_mn"),
            dec(F.lit(4) + k * 29 % 340, 8, 2).alias("population_mn"),
            (F.lit(10) + k * 7 % 15).alias("avg_transit_days_from_india"),
            dec(k * 3 % 26, 5, 2).alias("vat_gst_pct"),
            dec((F.lit(20) + k * 23 % 60) * F.lit(Decimal("0.1")), 4, 1).alias("payment_risk_score"),
        )
        return _conform(enrich.market_tier(enrich.composite_score(df)), "dim_markets")

    @cached_property
    def raw_products(self) -> DataFrame:
        """Products before the margin and list-price formulas."""
        k = F.col("p_partkey")
        price = dec("p_retailprice", 10, 2)
        return self.raw("part").select(
            k.alias("product_id"),
            enrich.sku_code(k).alias("sku_code"),
            F.concat("p_name", F.lit(" #"), k.cast("string")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.lit("House").alias("brand_name"),
            # Heavy goods, so that freight tells regions apart.
            dec(F.col("p_size") * F.lit(Decimal("12.5")), 8, 3).alias("weight_kg"),
            dec(price * F.when(_dear(F.col("p_brand")), 70).otherwise(40), 10, 2).alias("cogs_inr"),
            dec(price * 2, 10, 4).alias("fob_price_usd"),
            _numbered("Material", k, 12).alias("primary_material"),
            _yes(k % 7 != 0).alias("is_handmade"),
            _yes(k % 5 != 0).alias("is_sustainable"),
            _yes(k % 10 != 0).alias("is_export_ready"),
            (k % 9 * 75 + 50).cast("int").alias("moq_units"),
            (F.lit(2000) + k * 37 % 10000).cast("int").alias("monthly_capacity_units"),
            (k % 26 + 4).cast("int").alias("lead_time_days"),
            ((k % 9 + 1) * 12).cast("int").alias("shelf_life_months"),
            F.format_string("%08d", _hsn_number(k)).alias("hsn_code"),
            _numbered("Channel", k, CHANNELS).alias("marketplace_presence"),
            F.date_add(F.lit("1994-01-01").cast("date"), (k % 540).cast("int")).alias("product_launch_date"),
            _yes(k % 12 != 0).alias("is_active"),
            _numbered("Cluster", k, CLUSTERS).alias("artisan_cluster"),
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return _conform(enrich.product_margins(self.raw_products), "dim_products")

    @cached_property
    def all_customers(self) -> DataFrame:
        """Every customer, those not on file included."""
        k = F.col("c_custkey")
        df = self.raw("customer").join(
            self.dim_markets.select("market_id", "country"), F.col("c_nationkey") == F.col("market_id")
        )
        return df.select(
            k.alias("customer_id"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("customer_type"),
            "market_id",
            "country",
            F.concat("country", F.lit(" City "), (k % 4).cast("string")).alias("city"),
            _numbered("Class", k, 4).alias("customer_tier"),
            dec("c_acctbal", 12, 2).alias("credit_limit_usd"),
            _terms(k).alias("payment_terms_days"),
            _numbered("Category", k, 6)
            .alias("preferred_categories"),
            _numbered("Channel", k, CHANNELS).alias("primary_platform"),
            F.concat(F.lit("Manager "), (k % 6).cast("string")).alias("account_manager"),
            F.date_sub(F.lit("1995-01-01").cast("date"), (F.lit(30) + k % 1170).cast("int")).alias("registration_date"),
            _yes(k % 8 != 0).alias("is_active"),
            _numbered("Band", k, 5).alias("annual_revenue_band"),
            (F.lit(1) + k % 149).cast("int").alias("lifetime_orders"),
            dec(F.lit(800) + k * 13 % 39200, 12, 2).alias("avg_order_value_usd"),
        )

    @cached_property
    def dim_customers(self) -> DataFrame:
        """Customers on file: some that order are not, so that orphans and missing lookups occur."""
        return self.all_customers.where(F.col("customer_id") % 97 != 5)

    @cached_property
    def raw_forex(self) -> DataFrame:
        """One rate per currency and day, before the daily change."""
        e = F.col("event_id")
        entries = [F.lit(x) for pair in CURRENCY_OF_EVENT.items() for x in pair]
        div = lambda a, b: F.call_function("div", a, F.lit(b))
        day = F.make_date(
            (F.lit(1995) + div(e, 12) % 7).cast("int"),
            (e % 12 + 1).cast("int"),
            (div(e, 84) % 28 + 1).cast("int"),
        )
        return (
            self.raw("events")
            .select(
                F.element_at(F.create_map(*entries), F.col("event_type")).alias("currency_code"),
                day.alias("date"),
                F.col("value"),
            )
            .groupBy("currency_code", "date")
            .agg(F.max(dec("value", 10, 2)).alias("_peak"))
            .select(
                "currency_code", "date",
                dec(F.lit(50) + F.col("_peak") * F.lit(Decimal("0.1")), 10, 4).alias("rate_to_inr"),
            )
        )

    @cached_property
    def dim_forex_rates(self) -> DataFrame:
        df = enrich.fx_daily_change(self.raw_forex)
        df = enrich.calendar_columns(df, "date").withColumnsRenamed({"fiscal_year": "year", "month_num": "month"})
        return _conform(df.withColumn("currency_pair", enrich.currency_pair(F.col("currency_code"))), "dim_forex_rates")

    # --- order lines ------------------------------------------------------------------------

    @cached_property
    def _line_parts(self) -> int:
        return -(-self.raw("lineitem").count() // LINES_PER_BUCKET)

    @property
    def buckets(self) -> int:
        """Parts that the order lines are dealt to: they grow with the lines, so that none outgrows a task's memory."""
        return max(bucket_count(self.spark), self._line_parts)

    def _raw_lines(self) -> DataFrame:
        """The line items; the joins and groupings after them get shuffles of as many parts as the lines fill."""
        size_shuffles(self.spark, self._line_parts)
        return self.raw("lineitem")

    @cached_property
    def lines(self) -> DataFrame:
        """Every line item, with ``copy_no`` 0, 1, … among those of one (order, line number).

        The lines are dealt once by order, which serves the counting of equal lines, their numbering and the join with
        the orders. Repeats of one line are one row in the window. More copies than an id has places for stop the
        load: ids would run into the next line's.
        """
        key = ["l_orderkey", "l_linenumber"]
        rest = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_linestatus", "l_returnflag"]
        # Columns of few values side by side take less room in the shuffle's blocks.
        moved = ["l_orderkey", *rest[:4], "l_linenumber", *rest[4:]]
        dealt = self._raw_lines().select(*moved).repartition(self.buckets, "l_orderkey")
        distinct = dealt.groupBy(*key, *rest).agg(F.count(F.lit(1)).alias("_copies"))
        upto = Window.partitionBy(*key).orderBy(*rest).rowsBetween(Window.unboundedPreceding, 0)
        numbered = distinct.withColumn("_upto", F.sum("_copies").over(upto))
        fits = F.assert_true(F.col("_upto") <= COPIES, F.lit("a line item has more copies than its id has places for"))
        numbers = F.when(fits.isNull(), F.sequence(F.col("_upto") - F.col("_copies"), F.col("_upto") - 1))
        return numbered.select(*key, *rest, F.explode(numbers).alias("copy_no"))

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order lines with the inputs of the order formulas; line attributes keep their names."""
        customers = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("market_id"),
        )
        # Customers meet the orders, which are fewer and narrower than the lines.
        orders = self.raw("orders").select("o_orderkey", "o_orderdate", "o_orderstatus", F.col("o_custkey").alias("customer_id")).join(customers, "customer_id")
        number = F.col("l_linenumber")
        order_id = (F.col("l_orderkey") * 8 + number) * COPIES + F.col("copy_no")
        # Positions in ORDER_STATUS.
        status = (
            F.when(F.col("o_orderstatus") == "F", 0)
            .when(F.col("o_orderstatus") == "O", 1)
            .when(number % 2 == 0, 2)
            .otherwise(3)
        )
        # Prices are a quarter higher in the last two months, so that seasons differ.
        season = F.when(F.month("o_orderdate") >= 11, F.lit(Decimal("1.25"))).otherwise(F.lit(Decimal("1.00")))
        unit_price = dec(dec("l_extendedprice", 14, 2) * season, 16, 4) / F.nullif(dec("l_quantity", 10, 0), F.lit(0))
        placed = self.lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            order_id.alias("order_id"), "l_partkey", "l_suppkey", "customer_id", "market_id",
            PLACED.pack({"number": number, "day": F.unix_date(F.col("o_orderdate").cast("date"))}).alias("_placed"),
            TERMS.pack({
                "quantity": F.col("l_quantity").cast("int"),
                "discount": dec(F.col("l_discount") * 100, 5, 2) * 100,
                "status": status,
                "done": F.col("l_linestatus") == "F",
                "returned": F.col("l_returnflag") == "R",
            }).alias("_terms"),
            dec(round_half_even(unit_price, 4), 10, 4).alias("fob_price_usd_per_unit"),
        ).join(self.raw_products.select(F.col("product_id").alias("l_partkey"), "cogs_inr"), "l_partkey")
        if self.stage:
            # Dealt to the buckets of the table they are written to while they are narrow; the figures are made there.
            placed = placed.repartition(self.buckets, *BUCKET_KEYS["fact_export_orders"])
        term = lambda name: TERMS.get(F.col("_terms"), name)
        # The order key is in the order id and is not moved beside it.
        number = PLACED.get(F.col("_placed"), "number").cast("int")
        key = order_key(F.col("order_id"), number)
        df = placed.select(
            "order_id", F.date_from_unix_date(PLACED.get(F.col("_placed"), "day").cast("int")).alias("order_date"),
            F.col("l_partkey").alias("product_id"),
            "customer_id", "market_id", _terms(F.col("customer_id")).alias("payment_terms_days"), "cogs_inr",
            term("quantity").cast("int").alias("quantity_units"), "fob_price_usd_per_unit",
            dec(dec(term("discount"), 5, 0) * F.lit(Decimal("0.01")), 5, 2).alias("discount_pct"),
            (key * 31 + number * 7).alias("_delay"),
            _numbered("Channel", F.col("l_suppkey"), CHANNELS).alias("order_channel"),
            _pick(ORDER_STATUS, term("status")).alias("order_status"),
            _pick(["FOB", "CIF", "DDP"], number).alias("incoterm"),
            _yes(number <= 4).alias("is_repeat_order"),
            ((key * 13 + number) % 180).cast("int").alias("days_since_last_order"),
            (term("done") == 1).alias("line_done"), (term("returned") == 1).alias("line_returned"), "l_suppkey",
        )
        return (
            df.join(
                self.dim_markets.select(
                    "market_id", F.col("exchange_rate_to_inr").alias("exchange_rate_on_date")
                ),
                "market_id",
            )
            # Payment habits differ by market, so that every risk class occurs.
            .withColumn("payment_delay_days", (F.col("_delay") % (8 + F.col("market_id") * 3) - 5).cast("int"))
            .drop("_delay")
        )

    @cached_property
    def _orders_with_line(self) -> DataFrame:
        df = enrich.order_economics(self.order_lines)
        df = enrich.payment_status(enrich.payment_dates(df), AS_OF)
        df = enrich.calendar_columns(df, "order_date")
        df = df.select(*SCHEMAS["fact_export_orders"].fieldNames(), "line_done", "line_returned", "l_suppkey")
        return self.stage("order_lines", df, BUCKET_KEYS["fact_export_orders"]) if self.stage else df

    @cached_property
    def fact_export_orders(self) -> DataFrame:
        return _conform(self._orders_with_line, "fact_export_orders")

    # --- shipments --------------------------------------------------------------------------

    @cached_property
    def _delivered(self) -> DataFrame:
        return self._orders_with_line.where("order_status = 'Delivered' AND line_done").select(
            "order_id", "product_id", "market_id", "customer_id", "order_date", "quantity_units",
            "net_fob_price_usd", "total_fob_value_usd", "l_suppkey",
        )

    @cached_property
    def raw_shipments(self) -> DataFrame:
        """Delivered lines with the inputs of the landed-cost and timing formulas."""
        return self._shipped(self._delivered)

    @staticmethod
    def _shipped(delivered: DataFrame, *more: str) -> DataFrame:
        """Shipments of delivered lines, which keep the columns ``more``."""
        o = _mixed("order_id")
        supplier = F.col("l_suppkey")
        demurrage = F.when(o % 10 == 0, F.lit(50) + o % 350).otherwise(F.lit(0))
        return delivered.select(
            *more,
            F.col("order_id").alias("shipment_id"),
            "order_id", "product_id", "market_id", "customer_id", "order_date", "quantity_units",
            "net_fob_price_usd", "total_fob_value_usd",
            (F.lit(1) + o % 3).cast("int").alias("handling_days"),
            (o % 8 - 2).cast("int").alias("transit_variation_days"),
            F.when(o % 11 < 2, F.lit(1) + o % 14).otherwise(F.lit(0)).cast("int").alias("delay_days"),
            _numbered("Carrier", supplier, CARRIERS).alias("shipping_line"),
            _numbered("Port", supplier, LOADING_PORTS).alias("port_of_loading"),
            (supplier % 3).alias("_port_no"),
            _numbered("Container", o, CONTAINERS).alias("container_type"),
            _late(o).alias("delay_reason"),
            dec(demurrage, 12, 2).alias("demurrage_charges_usd"),
            (F.lit(1) + o % 9).cast("int").alias("customs_clearance_days"),
            F.when(o % 20 < 17, F.lit("Delivered")).otherwise(F.lit("In Transit")).alias("planned_status"),
        )

    @cached_property
    def fact_shipment_details(self) -> DataFrame:
        # Looked up as a number: the products stay narrow enough to be broadcast for longer, and the shipments where they lie.
        numbers = self.raw("part").select(F.col("p_partkey").alias("product_id"), _hsn_number(F.col("p_partkey")).alias("hsn_code"))
        delivered = enrich.with_lookup(self._delivered, self.raw_products, "product_id", {"weight_kg": None})
        delivered = enrich.with_lookup(delivered, numbers, "product_id", {"hsn_code": None})
        if self.stage:
            # Products that are not broadcast move the lines; these go back to their buckets while they are narrow, before the figures.
            delivered = delivered.repartition(self.buckets, *BUCKET_KEYS["fact_shipment_details"])
        df = enrich.landed_cost(self._shipped(delivered, "weight_kg", "hsn_code"), None, self.dim_markets)
        df = enrich.shipment_timing(df)
        df = df.withColumn("hsn_code", F.when(F.col("hsn_code").isNotNull(), F.format_string("%08d", "hsn_code")))
        port = F.concat("region", F.lit(" Port "), F.col("_port_no").cast("string"))
        return _conform(df.withColumn("port_of_discharge", port), "fact_shipment_details")

    # --- prices -----------------------------------------------------------------------------

    @cached_property
    def _our_prices(self) -> DataFrame:
        """Our price per ship date, product and market."""
        best = F.max(dec("l_extendedprice", 10, 2)) * F.lit(Decimal("0.05"))
        return (
            # The dearest line of a group is the same with and without its copies, so these are not numbered here.
            self._raw_lines().join(self.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(
                F.col("l_shipdate").cast("date").alias("date"),
                F.col("l_partkey").alias("product_id"),
                F.col("s_nationkey").alias("market_id"),
            )
            .agg(dec(round_half_even(best, 2), 10, 2).alias("our_price_usd"))
        )

    @staticmethod
    def _with_competitors(prices: DataFrame) -> DataFrame:
        times = lambda factor: dec(round_half_even(F.col("our_price_usd") * factor, 2), 10, 2)
        hundredth = F.lit(Decimal("0.01"))
        return prices.withColumns({
            "competitor1_price_usd": times(dec(F.lit(85) + F.col("product_id") % 21 * 3, 5, 0) * hundredth),
            "competitor2_price_usd": times(dec(F.lit(65) + F.col("market_id") % 21 * 3, 5, 0) * hundredth),
            "competitor3_price_usd": times(dec(F.lit(80) + F.col("product_id") % 3 * 20, 5, 0) * hundredth),
        })

    @cached_property
    def raw_pricing(self) -> DataFrame:
        """Our and three competitor prices per ship date, product and market."""
        return self._with_competitors(self._our_prices)

    @cached_property
    def fact_competitor_pricing(self) -> DataFrame:
        """Prices with their figures, dealt by ranges of the date while they are narrow: a year lies in few parts, a hot one in many.

        Products are joined before, so that many of them, which are not broadcast, move no other figures and leave the deal as it is.
        """
        parts = max(self.spark.sparkContext.defaultParallelism, self._line_parts)
        costed = enrich.target_price(self._our_prices, self.raw_products, self.dim_markets)
        costed = costed.select("date", "product_id", "market_id", "our_price_usd", "landed_cost_usd")
        dealt = costed.repartitionByRange(parts, "date", "product_id", "market_id")
        df = enrich.calendar_columns(enrich.price_benchmark(self._with_competitors(dealt)), "date")
        return _conform(df, "fact_competitor_pricing")

    # --- demand -----------------------------------------------------------------------------

    @cached_property
    def raw_demand(self) -> DataFrame:
        """Search and demand figures per day, product and market, before the signals.

        An event belongs to one of all parts and nations, by its number and its user's.
        """
        parts, nations = (self.raw(t).agg(F.count("*")).scalar() for t in ("part", "nation"))
        exact = dec("value", 12, 2)
        grouped = (
            self.raw("events")
            .groupBy(
                F.col("ts").cast("date").alias("date"),
                (F.col("event_id") % parts).alias("product_id"),
                (F.col("user_id") % nations).cast("int").alias("market_id"),
            )
            .agg(F.max(exact).alias("_peak"), F.floor(F.sum(exact)).cast("int").alias("daily_search_volume"))
        )
        # Some markets grow faster, so that every growth band occurs.
        faster = F.when(F.col("market_id") % 8 == 7, F.lit(35)).when(F.col("market_id") % 8 == 6, F.lit(25)).otherwise(F.lit(0))
        growth = round_half_even(F.col("_peak") * F.lit(Decimal("0.2")) - F.lit(20) + faster, 2)
        return grouped.withColumns({
            "google_trends_score": dec(round_half_even(clamp("_peak", Decimal("10.00"), Decimal("100.00")), 1), 5, 1),
            "yoy_search_growth_pct": dec(growth, 7, 2),
            "social_media_mentions": F.call_function("div", F.col("daily_search_volume") * 3, F.lit(2)).cast("int"),
            "estimated_demand_units": F.call_function("div", F.col("daily_search_volume"), F.lit(3)).cast("int"),
            "seasonality_index": dec(enrich.seasonality_factor("date"), 5, 3),
        }).drop("_peak")

    @cached_property
    def fact_market_demand(self) -> DataFrame:
        df = enrich.calendar_columns(enrich.demand_signals(self.raw_demand), "date")
        return _conform(df, "fact_market_demand")

    # --- returns ----------------------------------------------------------------------------

    @cached_property
    def raw_returns(self) -> DataFrame:
        """Returned delivered lines with the inputs of the return formulas."""
        o = _mixed("order_id")
        share = dec(F.col("quantity_units") * (F.lit(5) + o % 6), 12, 0) * F.lit(Decimal("0.01"))
        returned = self._orders_with_line.where("order_status = 'Delivered' AND line_returned")
        return returned.select(
            F.col("order_id").alias("return_id"),
            "order_id", "product_id", "market_id", "customer_id", "order_date", "net_fob_price_usd",
            F.greatest(round_half_even(share, 0).cast("int"), F.lit(1)).alias("return_quantity"),
            dec(F.lit(4) + o % 7, 5, 2).alias("return_shipping_rate_pct"),
            (F.lit(7) + o % 48).cast("int").alias("days_to_return"),
            _numbered("Return reason", F.col("l_suppkey"), RETURN_REASONS).alias("return_reason"),
            _numbered("Return type", o, RETURN_TYPES).alias("return_type"),
            _numbered("Processing", o, PROCESSING).alias("processing_status"),
            _yes(o % 25 < 17).alias("is_first_return"),
        )

    @cached_property
    def fact_returns(self) -> DataFrame:
        return _conform(enrich.return_economics(self.raw_returns), "fact_returns")


