"""Row order of the views in reports.

The views themselves are unordered: a global sort is a shuffle only a reader of the whole result
needs. NULL placement is stated, because engines differ for a falling order without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exportlens.operators.ranking import with_position

# View -> sort columns; "-" is falling with NULLs first, "-?" falling with NULLs last.
REPORT_ORDER: dict[str, list[str]] = {
    "executive_revenue": ["fiscal_year", "month_num"],
    "market_entry_readiness": ["-weighted_priority_score"],
    "product_export_scorecard": ["-?total_revenue_usd"],
    "landed_cost_analysis": ["-avg_lc_fob_ratio"],
    "customer_ltv": ["-?total_revenue_usd"],
    "shipment_delay": ["-total_demurrage_usd"],
    "competitor_benchmark": ["-price_gap_pct"],
    "returns_analysis": ["-total_return_loss_usd"],
    "forex_impact": ["year", "month", "currency"],
    "channel_performance": ["fiscal_year", "-total_revenue_usd"],
    "demand_intelligence": ["-avg_yoy_growth_pct"],
    "payment_risk": ["-overdue_value_usd"],
    "seasonal_intelligence": ["country", "fiscal_year", "month_num"],
    "category_mix": ["-total_revenue_usd"],
    "master_summary": [],
}
# View -> columns that tell its rows apart.
GRAIN: dict[str, list[str]] = {
    "executive_revenue": ["fiscal_year", "quarter", "month_num"],
    "market_entry_readiness": ["market_id"],
    "product_export_scorecard": ["product_id"],
    "landed_cost_analysis": ["country", "region", "category", "product_name"],
    "customer_ltv": ["customer_id"],
    "shipment_delay": ["country", "region", "shipping_line", "port_of_loading", "port_of_discharge", "container_type", "delay_reason"],
    "competitor_benchmark": ["country", "region", "category", "subcategory", "product_name"],
    "returns_analysis": ["country", "region", "category", "product_name"],
    "forex_impact": ["year", "month", "currency"],
    "channel_performance": ["order_channel", "fiscal_year", "quarter"],
    "demand_intelligence": ["country", "region", "category", "product_name", "fiscal_year", "quarter"],
    "payment_risk": ["country", "region"],
    "seasonal_intelligence": ["country", "region", "category", "fiscal_year", "month_num"],
    "category_mix": ["category", "subcategory"],
    "master_summary": [],
}


def _order(name: str) -> list[Column]:
    keys = []
    for key in REPORT_ORDER[name]:
        if key.startswith("-?"):
            keys.append(F.col(key[2:]).desc_nulls_last())
        elif key.startswith("-"):
            keys.append(F.col(key[1:]).desc_nulls_first())
        else:
            keys.append(F.col(key).asc_nulls_last())
    return keys


def report_order(df: DataFrame, name: str) -> DataFrame:
    """The view's rows in the order its report lists them."""
    keys = _order(name)
    return df.orderBy(*keys) if keys else df


def report_position(df: DataFrame, name: str) -> DataFrame:
    """The view's rows with ``position``, their place in the report from 1 on; rows of equal order go by their grain.

    Rows are sorted by ranges and numbered inside these, so no task sees the whole view.
    """
    return with_position(df, [*_order(name), *[F.col(c) for c in GRAIN[name]]], "position")
