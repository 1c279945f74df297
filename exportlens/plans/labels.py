"""Tag texts of the KPI views and the analysis tables."""

# Tag texts.
STAR_PRODUCT = "⭐ Star Export Product"
GROWTH_PRODUCT = "📈 Growth Product"
VIABLE_PRODUCT = "✅ Viable — Optimize"
REVIEW_PRODUCT = "⚠️ Review — Low Margin"

HIGH_COST_ROUTE = "High Cost Route"
MODERATE_COST = "Moderate Cost"
EFFICIENT_ROUTE = "Efficient Route"

BUYER_HIGH_RISK = "🔴 High Risk — Payment Issues"
BUYER_HIGH_RETURNS = "🟡 High Returns — Review"
BUYER_CHAMPION = "🟢 Champion Buyer"
BUYER_LOYAL = "🟢 Loyal Buyer"
BUYER_STANDARD = "⚪ Standard Buyer"

DELAY_CRITICAL = "🔴 Critical — High Delay"
DELAY_WARNING = "🟡 Warning — Monitor"
DELAY_FINE = "🟢 Performing Well"

OVERPRICED = "⚠️ Overpriced"
UNDERPRICED = "⚠️ Underpriced"
OPTIMALLY_PRICED = "✅ Optimally Priced"
FINE_TUNE = "🟡 Fine Tune"

RETURNS_CRITICAL = "🔴 Critical Return Problem"
RETURNS_ELEVATED = "🟡 Elevated — Investigate"
RETURNS_ACCEPTABLE = "🟢 Acceptable"

FOREX_GAIN = "Forex Gain"
FOREX_LOSS = "Forex Loss"

DEMAND_HIGH = "🚀 High Growth"
DEMAND_GROWING = "📈 Growing"
DEMAND_STABLE = "➡️ Stable"
DEMAND_DECLINING = "📉 Declining"

RISK_HIGH = "🔴 High Risk"
RISK_MODERATE = "🟡 Moderate Risk"
RISK_LOW = "🟢 Low Risk"

SEASON_PEAK = "🎄 Peak Season"
SEASON_RAMP = "📦 Pre-Peak Ramp"
SEASON_SLOW = "☀️ Summer Slow"
SEASON_NORMAL = "➡️ Normal"

TREND_PEAK = "🎄 Peak"
TREND_RAMP = "📦 Pre-Peak"
TREND_SLOW = "☀️ Slow"
TREND_NORMAL = "➡️  Normal"

ENTRY_TIERS = ["Tier 4 - Avoid", "Tier 3 - Monitor", "Tier 2 - Plan Entry", "Tier 1 - Enter Now"]
