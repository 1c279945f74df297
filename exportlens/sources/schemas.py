"""The nine star-schema tables: types, keys and references."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

# Column names, types and lengths of the nine tables; True where a column may be null.
_TABLES: dict[str, list[tuple[str, DataType, bool]]] = {
    "dim_products": [
        ("product_id", VarcharType(10), False),
        ("sku_code", VarcharType(20), True),
        ("product_name", VarcharType(120), False),
        ("category", VarcharType(30), True),
        ("subcategory", VarcharType(50), True),
        ("brand_name", VarcharType(50), True),
        ("weight_kg", DecimalType(8, 3), True),
        ("cogs_inr", DecimalType(10, 2), True),
        ("india_mrp_inr", DecimalType(10, 2), True),
        ("fob_price_usd", DecimalType(10, 4), True),
        ("gross_margin_pct_india", DecimalType(5, 1), True),
        ("primary_material", VarcharType(40), True),
        ("is_handmade", VarcharType(1), True),
        ("is_sustainable", VarcharType(1), True),
        ("is_export_ready", VarcharType(1), True),
        ("moq_units", IntegerType(), True),
        ("monthly_capacity_units", IntegerType(), True),
        ("lead_time_days", IntegerType(), True),
        ("shelf_life_months", IntegerType(), True),
        ("hsn_code", VarcharType(15), True),
        ("marketplace_presence", VarcharType(40), True),
        ("product_launch_date", DateType(), True),
        ("is_active", VarcharType(1), True),
        ("artisan_cluster", VarcharType(30), True),
    ],
    "dim_markets": [
        ("market_id", VarcharType(5), False),
        ("country", VarcharType(50), False),
        ("region", VarcharType(30), True),
        ("currency", VarcharType(5), True),
        ("exchange_rate_to_inr", DecimalType(10, 4), True),
        ("home_decor_demand_score", DecimalType(4, 1), True),
        ("market_entry_ease_score", DecimalType(4, 1), True),
        ("regulatory_ease_score", DecimalType(4, 1), True),
        ("indian_craft_affinity_score", DecimalType(4, 1), True),
        ("ecommerce_maturity_score", DecimalType(4, 1), True),
        ("monthly_search_volume_k", IntegerType(), True),
        ("avg_customs_duty_pct", DecimalType(5, 2), True),
        ("amazon_presence", VarcharType(1), True),
        ("primary_marketplace", VarcharType(50), True),
        ("gdp_per_capita_usd", IntegerType(), True),
        ("market_size_usd_mn", DecimalType(10, 2), True),
        ("population_mn", DecimalType(8, 2), True),
        ("avg_transit_days_from_india", IntegerType(), True),
        ("composite_score", DecimalType(4, 2), True),
        ("market_tier", VarcharType(10), True),
        ("vat_gst_pct", DecimalType(5, 2), True),
        ("payment_risk_score", DecimalType(4, 1), True),
    ],
    "dim_customers": [
        ("customer_id", VarcharType(10), False),
        ("company_name", VarcharType(100), True),
        ("customer_type", VarcharType(50), True),
        ("market_id", VarcharType(5), True),
        ("country", VarcharType(50), True),
        ("city", VarcharType(50), True),
        ("customer_tier", VarcharType(20), True),
        ("credit_limit_usd", DecimalType(12, 2), True),
        ("payment_terms_days", IntegerType(), True),
        ("preferred_categories", VarcharType(100), True),
        ("primary_platform", VarcharType(50), True),
        ("account_manager", VarcharType(50), True),
        ("registration_date", DateType(), True),
        ("is_active", VarcharType(1), True),
        ("annual_revenue_band", VarcharType(20), True),
        ("lifetime_orders", IntegerType(), True),
        ("avg_order_value_usd", DecimalType(12, 2), True),
    ],
    "dim_forex_rates": [
        ("date", DateType(), False),
        ("currency_code", VarcharType(5), False),
        ("currency_pair", VarcharType(10), True),
        ("rate_to_inr", DecimalType(10, 4), True),
        ("daily_change_pct", DecimalType(8, 4), True),
        ("month", IntegerType(), True),
        ("year", IntegerType(), True),
        ("quarter", VarcharType(5), True),
    ],
    "fact_export_orders": [
        ("order_id", LongType(), False),
        ("order_date", DateType(), True),
        ("product_id", VarcharType(10), True),
        ("market_id", VarcharType(5), True),
        ("customer_id", VarcharType(10), True),
        ("quantity_units", IntegerType(), True),
        ("fob_price_usd_per_unit", DecimalType(10, 4), True),
        ("discount_pct", DecimalType(5, 2), True),
        ("net_fob_price_usd", DecimalType(10, 4), True),
        ("total_fob_value_usd", DecimalType(14, 2), True),
        ("exchange_rate_on_date", DecimalType(10, 4), True),
        ("total_fob_value_inr", DecimalType(16, 2), True),
        ("cogs_inr_per_unit", DecimalType(10, 2), True),
        ("total_cogs_inr", DecimalType(16, 2), True),
        ("gross_profit_inr", DecimalType(16, 2), True),
        ("gross_margin_pct", DecimalType(7, 2), True),
        ("payment_terms_days", IntegerType(), True),
        ("payment_due_date", DateType(), True),
        ("payment_received_date", DateType(), True),
        ("payment_delay_days", IntegerType(), True),
        ("payment_status", VarcharType(20), True),
        ("order_channel", VarcharType(30), True),
        ("order_status", VarcharType(20), True),
        ("incoterm", VarcharType(5), True),
        ("fiscal_year", IntegerType(), True),
        ("quarter", VarcharType(5), True),
        ("month_num", IntegerType(), True),
        ("month_name", VarcharType(15), True),
        ("week_num", IntegerType(), True),
        ("is_repeat_order", VarcharType(1), True),
        ("days_since_last_order", IntegerType(), True),
    ],
    "fact_shipment_details": [
        ("shipment_id", LongType(), False),
        ("order_id", LongType(), True),
        ("product_id", VarcharType(10), True),
        ("market_id", VarcharType(5), True),
        ("customer_id", VarcharType(10), True),
        ("shipment_date", DateType(), True),
        ("estimated_arrival_date", DateType(), True),
        ("actual_arrival_date", DateType(), True),
        ("delay_days", IntegerType(), True),
        ("is_delayed", VarcharType(1), True),
        ("shipping_line", VarcharType(30), True),
        ("port_of_loading", VarcharType(50), True),
        ("port_of_discharge", VarcharType(80), True),
        ("container_type", VarcharType(30), True),
        ("hsn_code", VarcharType(15), True),
        ("declared_value_usd", DecimalType(14, 2), True),
        ("freight_cost_usd", DecimalType(12, 2), True),
        ("insurance_usd", DecimalType(12, 2), True),
        ("cif_value_usd", DecimalType(14, 2), True),
        ("customs_duty_usd", DecimalType(12, 2), True),
        ("port_handling_usd", DecimalType(12, 2), True),
        ("last_mile_usd", DecimalType(12, 2), True),
        ("demurrage_charges_usd", DecimalType(12, 2), True),
        ("total_landed_cost_usd", DecimalType(14, 2), True),
        ("landed_to_fob_ratio", DecimalType(8, 4), True),
        ("total_transit_days", IntegerType(), True),
        ("customs_clearance_days", IntegerType(), True),
        ("shipment_status", VarcharType(20), True),
        ("delay_reason", VarcharType(50), True),
        ("exporter_net_margin_usd", DecimalType(14, 2), True),
    ],
    "fact_competitor_pricing": [
        ("date", DateType(), False),
        ("product_id", VarcharType(10), False),
        ("market_id", VarcharType(5), False),
        ("our_price_usd", DecimalType(10, 2), True),
        ("competitor1_price_usd", DecimalType(10, 2), True),
        ("competitor2_price_usd", DecimalType(10, 2), True),
        ("competitor3_price_usd", DecimalType(10, 2), True),
        ("avg_competitor_price_usd", DecimalType(10, 2), True),
        ("our_price_index", DecimalType(6, 1), True),
        ("price_competitiveness", VarcharType(20), True),
        ("landed_cost_usd", DecimalType(10, 4), True),
        ("gross_margin_on_our_price_pct", DecimalType(7, 2), True),
        ("month_num", IntegerType(), True),
        ("fiscal_year", IntegerType(), True),
    ],
    "fact_market_demand": [
        ("date", DateType(), False),
        ("product_id", VarcharType(10), False),
        ("market_id", VarcharType(5), False),
        ("google_trends_score", DecimalType(5, 1), True),
        ("daily_search_volume", IntegerType(), True),
        ("yoy_search_growth_pct", DecimalType(7, 2), True),
        ("social_media_mentions", IntegerType(), True),
        ("amazon_bsr", IntegerType(), True),
        ("estimated_demand_units", IntegerType(), True),
        ("seasonality_index", DecimalType(5, 3), True),
        ("demand_trend", VarcharType(15), True),
        ("month_num", IntegerType(), True),
        ("fiscal_year", IntegerType(), True),
        ("quarter", VarcharType(5), True),
    ],
    "fact_returns": [
        ("return_id", LongType(), False),
        ("order_id", LongType(), True),
        ("product_id", VarcharType(10), True),
        ("market_id", VarcharType(5), True),
        ("customer_id", VarcharType(10), True),
        ("return_date", DateType(), True),
        ("return_quantity", IntegerType(), True),
        ("return_reason", VarcharType(60), True),
        ("return_type", VarcharType(20), True),
        ("refund_amount_usd", DecimalType(12, 2), True),
        ("return_shipping_cost_usd", DecimalType(10, 2), True),
        ("net_loss_usd", DecimalType(12, 2), True),
        ("processing_status", VarcharType(30), True),
        ("days_to_return", IntegerType(), True),
        ("is_first_return", VarcharType(1), True),
        ("return_month", IntegerType(), True),
        ("return_year", IntegerType(), True),
    ],
}


def _field(name: str, kind: DataType, nullable: bool) -> StructField:
    """A text is read as a plain string and keeps its length as metadata."""
    if isinstance(kind, VarcharType):
        return StructField(name, StringType(), nullable, {"max_length": kind.length})
    return StructField(name, kind, nullable)


SCHEMAS: dict[str, StructType] = {
    table: StructType([_field(*column) for column in columns]) for table, columns in _TABLES.items()
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_products": ["product_id"],
    "dim_markets": ["market_id"],
    "dim_customers": ["customer_id"],
    "dim_forex_rates": ["date", "currency_code"],
    "fact_export_orders": ["order_id"],
    "fact_shipment_details": ["shipment_id"],
    "fact_competitor_pricing": ["date", "product_id", "market_id"],
    "fact_market_demand": ["date", "product_id", "market_id"],
    "fact_returns": ["return_id"],
}

_PARENT = {"product_id": "dim_products", "market_id": "dim_markets",
           "customer_id": "dim_customers", "order_id": "fact_export_orders"}
_CHILD_KEYS = {
    "dim_customers": ["market_id"],
    "fact_export_orders": ["product_id", "market_id", "customer_id"],
    "fact_shipment_details": ["order_id", "product_id", "market_id", "customer_id"],
    "fact_competitor_pricing": ["product_id", "market_id"],
    "fact_market_demand": ["product_id", "market_id"],
    "fact_returns": ["order_id", "product_id", "market_id", "customer_id"],
}
# (child table, key, parent table): the sixteen declared references.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    (child, key, _PARENT[key]) for child, keys in _CHILD_KEYS.items() for key in keys
]

# Facts are written partitioned by the year they are filtered on.
PARTITION_COLUMNS: dict[str, list[str]] = {
    "fact_export_orders": ["fiscal_year"],
    "fact_competitor_pricing": ["fiscal_year"],
    "fact_market_demand": ["fiscal_year"],
    "fact_returns": ["return_year"],
}

# Facts that are joined to each other by order are bucketed and sorted by it instead, all in the same number of buckets.
BUCKET_KEYS: dict[str, list[str]] = {
    "fact_export_orders": ["order_id"],
    "fact_shipment_details": ["order_id"],
    "fact_returns": ["order_id"],
}
