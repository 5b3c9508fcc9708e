"""Settings handed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# Thresholds and saturation points of the risk contract.
ANOMALY_SATURATION = 0.10
FORECAST_SATURATION = 0.10
LOW_BELOW = 30.0
MEDIUM_BELOW = 60.0
HIGH_CHURN = 0.55
MODERATE_CHURN = 0.35
NEGATIVE_SENTIMENT = 0.45
ANOMALY_PRESENT = 0.03
FORECAST_GAP = 0.08
METRIC_DROP = -0.10
RECENT_ROWS = 30
INTERVAL_Z = 1.96
SEASON_DAYS = 7

# Canonical column lists.
SERIES_COLUMNS = ["revenue", "active_users", "signups"]
CHURN_NUMERIC_COLUMNS = ["tenure", "monthly_spend", "usage_frequency", "support_tickets"]
CHURN_BASE_COLUMNS = CHURN_NUMERIC_COLUMNS + ["plan_type"]
SENTIMENT_LABELS = ["negative", "neutral", "positive"]
DETECTOR_FEATURES = [
    "day_of_week",
    "revenue_pct_change_1d",
    "revenue_abs_pct_change_1d",
    "revenue_rolling_residual_7",
    "revenue_rolling_residual_30",
    "revenue_zscore_7",
    "revenue_zscore_30",
]
# Inputs that stand in for something else, and what they stand in for.
PROXY_FEATURES = {
    "monthly_spend": "linear transform of Daily_Usage_Mins",
    "plan_type": "binned Daily_Usage_Mins",
    "support_tickets": "keyword flag over last-support-ticket text",
}


@dataclass(frozen=True)
class RiskWeights:
    churn: float = 0.35
    sentiment: float = 0.20
    anomaly: float = 0.20
    forecast: float = 0.25


@dataclass(frozen=True)
class EngineConfig:
    seed: int = 42
    test_size: float = 0.2
    churn_model: str = "lightgbm"
    max_features: int = 5000
    min_df: int = 2
    contamination: float = 0.03
    n_trees: int = 500
    tree_sample: int = 256
    forecast_model: str = "prophet"
    horizon_days: int = 30
    weights: RiskWeights = field(default_factory=RiskWeights)
