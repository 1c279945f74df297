"""KPI views and analysis operators as composable plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from exportlens.plans import views as V

Tables = Mapping[str, DataFrame]


def view_builders(as_of: str) -> dict[str, Callable[[Tables], DataFrame]]:
    """Each KPI view as a function of the table mapping, for registering or running by name."""
    orders, shipments, returns = "fact_export_orders", "fact_shipment_details", "fact_returns"
    pricing, demand = "fact_competitor_pricing", "fact_market_demand"
    markets, products, customers, forex = "dim_markets", "dim_products", "dim_customers", "dim_forex_rates"

    def over(build: Callable[..., DataFrame], *names: str, **kwargs) -> Callable[[Tables], DataFrame]:
        return lambda t: build(*[t[n] for n in names], **kwargs)

    return {
        "executive_revenue": over(V.executive_revenue, orders),
        "market_entry_readiness": over(V.market_entry_readiness, markets, orders, shipments, returns),
        "product_export_scorecard": over(
            V.product_export_scorecard, products, orders, shipments, returns, pricing
        ),
        "landed_cost_analysis": over(V.landed_cost_analysis, shipments, orders, markets, products),
        "customer_ltv": over(V.customer_ltv, customers, orders, returns, as_of=as_of),
        "shipment_delay": over(V.shipment_delay, shipments, markets),
        "competitor_benchmark": over(V.competitor_benchmark, pricing, markets, products),
        "returns_analysis": over(V.returns_analysis, returns, markets, products, orders),
        "forex_impact": over(V.forex_impact, orders, markets, forex),
        "channel_performance": over(V.channel_performance, orders),
        "demand_intelligence": over(V.demand_intelligence, demand, markets, products),
        "payment_risk": over(V.payment_risk, orders, markets),
        "seasonal_intelligence": over(V.seasonal_intelligence, orders, markets, products),
        "category_mix": over(V.category_mix, orders, products),
        "master_summary": over(V.master_summary, orders, shipments, returns),
    }
