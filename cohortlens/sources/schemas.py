"""Declared source contracts, domains and modelling constants."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TABLES = ("marketing_spend", "marketing_campaigns", "dim_user", "user_activity")

# Raw columns per source, in file order. Raw CSV is read with every column
# as a string; staging casts. Typed sources (parquet) pass through the same
# casts unchanged.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "marketing_spend": ("date", "campaign_id", "spend"),
    "marketing_campaigns": ("campaign_id", "campaign_name", "campaign_type"),
    "dim_user": ("user_id", "gender", "country", "campaign_id"),
    "user_activity": (
        "user_id",
        "event_type",
        "event_date",
        "revenue_amount",
        "attribution_date",
        "onboarding_name",
        "dt",
        "campaign_id",
    ),
}

RAW_SCHEMAS: dict[str, T.StructType] = {
    name: T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    for name, cols in RAW_COLUMNS.items()
}

# Typed form of the raw sources (what the parquet fixtures carry).
RAW_TYPED_SCHEMAS: dict[str, T.StructType] = {
    "marketing_spend": T.StructType(
        [
            T.StructField("date", T.DateType()),
            T.StructField("campaign_id", T.StringType()),
            T.StructField("spend", T.DoubleType()),
        ]
    ),
    "marketing_campaigns": RAW_SCHEMAS["marketing_campaigns"],
    "dim_user": RAW_SCHEMAS["dim_user"],
    "user_activity": T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("event_date", T.TimestampNTZType()),
            T.StructField("revenue_amount", T.DoubleType()),
            T.StructField("attribution_date", T.DateType()),
            T.StructField("onboarding_name", T.StringType()),
            T.StructField("dt", T.DateType()),
            T.StructField("campaign_id", T.StringType()),
        ]
    ),
}

# Cleaning rules and accepted domains.
GENDER_SENTINELS = ("unknown", "unknownx", "?")
COUNTRY_SENTINELS = ("XX", "ZZ")
UNKNOWN = "unknown"

GENDER_VALUES = ("female", "male", "nonbinary", "prefer_not_to_say", "unknown")
COUNTRY_VALUES = ("AU", "BR", "CA", "DE", "ES", "FR", "GB", "IN", "IT", "US", "unknown")
CAMPAIGN_TYPES = ("Display", "Influencer", "Search", "Social", "Video")
EVENT_TYPES = ("start_onboarding", "start_trial", "sale")
ONBOARDING_NAMES = ("fitness", "focus", "sleep", "standard", "unknown")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

ONBOARDING = "start_onboarding"
TRIAL = "start_trial"
SALE = "sale"

# Modelling contract. Only onboarding-time predictors; both
# targets share the same set (leakage rule).
PREDICTORS = ("gender", "country", "campaign_label", "onboarding_name", "attribution_weekday")
TARGETS = ("started_trial", "made_sale")
TRAIN_DATE_SHARE = 0.60
VALIDATION_DATE_SHARE = 0.20
# Threshold grid: numpy.arange(0.05, 0.51, 0.01) (46 float-stepped values).
THRESHOLD_START, THRESHOLD_STOP, THRESHOLD_STEP = 0.05, 0.51, 0.01

# Report labels.
PREDICTOR_LABELS = {
    "gender": "Gender",
    "country": "Country",
    "campaign_label": "Campaign",
    "onboarding_name": "Onboarding experience",
    "attribution_weekday": "Acquisition weekday",
}
FACTOR_LABELS = {
    "gender": "Gender",
    "country": "Country",
    "campaign_label": "Campaign",
    "onboarding_name": "Onboarding",
    "attribution_weekday": "Weekday",
}
# metric column -> lower is better
RANKING_METRICS = {
    "total_revenue_roas": False,
    "initial_revenue_roas": False,
    "cost_per_trial": True,
    "cost_per_sale": True,
    "trial_rate": False,
    "sale_rate": False,
}
# AUC upper bounds (exclusive) and labels; anything above the last is "Strong".
RELIABILITY_BANDS = ((0.55, "Very weak"), (0.60, "Weak"), (0.70, "Limited"), (0.80, "Useful"))
RELIABILITY_TOP = "Strong"


def threshold_grid() -> list[float]:
    """The 46 thresholds exactly as ``numpy.arange`` steps them."""
    import numpy as np

    return [float(t) for t in np.arange(THRESHOLD_START, THRESHOLD_STOP, THRESHOLD_STEP)]
