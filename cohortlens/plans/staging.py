"""Staging models: one cleaned table per raw source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    keep_when,
    map_sentinels,
    norm_category,
    norm_code,
    norm_text,
    plain_double,
    surrogate_key,
)
from ..operators.resolve import Resolution, resolve
from ..sources.schemas import COUNTRY_SENTINELS, GENDER_SENTINELS, SALE, UNKNOWN


def stg_marketing_spend(raw: DataFrame) -> DataFrame:
    """Rename + cast. The campaign id is cast only: it is not trimmed or
    upper-cased, unlike every other table's codes."""
    return raw.select(
        F.col("date").cast("date").alias("spend_date"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.col("spend").cast("double").alias("spend_amount"),
    )


def stg_marketing_campaigns(raw: DataFrame) -> DataFrame:
    """Normalised code, trimmed name and type. No de-duplication: uniqueness
    is a check, not a repair."""
    return raw.select(
        norm_code("campaign_id").alias("campaign_id"),
        norm_text("campaign_name").alias("campaign_name"),
        norm_text("campaign_type").alias("campaign_type"),
    )


def normalized_dim_user(raw: DataFrame) -> DataFrame:
    return raw.select(
        norm_text("user_id").alias("user_id"),
        map_sentinels("gender", GENDER_SENTINELS, UNKNOWN, case="lower").alias("gender"),
        map_sentinels("country", COUNTRY_SENTINELS, UNKNOWN, case="upper").alias("country"),
        norm_code("campaign_id", blank_null=True).alias("campaign_id"),
    )


# Three resolution policies: gender ignores `unknown` when looking for
# conflicts; country counts `unknown` as a value (unknown + known is a
# conflict); campaign resolves to null on conflict.
DIM_USER_RULES = [
    Resolution("gender", ignore=UNKNOWN, on_conflict=UNKNOWN, conflict_flag="has_gender_conflict"),
    Resolution("country", ignore=None, on_conflict=UNKNOWN, conflict_flag="has_country_conflict"),
    Resolution("campaign_id", ignore=None, on_conflict=None, conflict_flag="has_campaign_conflict"),
]


def stg_dim_user(raw: DataFrame) -> DataFrame:
    """One row per user: normalise, then resolve duplicates and conflicts in a
    single partial-aggregating ``groupBy(user_id)``."""
    resolved = resolve(normalized_dim_user(raw), "user_id", DIM_USER_RULES)
    return resolved.select(
        "user_id",
        "gender",
        "country",
        "campaign_id",
        "has_gender_conflict",
        "has_country_conflict",
        "has_campaign_conflict",
    )


def stg_user_activity(raw: DataFrame) -> DataFrame:
    """Normalised events with a deterministic surrogate key over seven fields
    (``dt`` is not part of it). Revenue is kept for sale events only."""
    event_type = F.lower(F.trim(F.col("event_type").cast("string")))
    norm = raw.select(
        norm_text("user_id").alias("user_id"),
        event_type.alias("event_type"),
        F.col("event_date").cast("timestamp_ntz").alias("event_at"),
        keep_when(F.col("revenue_amount").cast("double"), event_type == F.lit(SALE)).alias("revenue_amount"),
        F.col("attribution_date").cast("date").alias("attribution_date"),
        norm_category("onboarding_name", UNKNOWN).alias("onboarding_name"),
        F.col("dt").cast("date").alias("source_date"),
        norm_code("campaign_id", blank_null=True).alias("campaign_id"),
    )
    key = surrogate_key(
        "user_id",
        "event_type",
        "event_at",
        plain_double("revenue_amount"),
        "attribution_date",
        "onboarding_name",
        "campaign_id",
    )
    return norm.select(
        key.alias("activity_id"),
        "user_id",
        "event_type",
        "event_at",
        "revenue_amount",
        "attribution_date",
        "onboarding_name",
        "source_date",
        "campaign_id",
    )


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_marketing_spend": stg_marketing_spend(raw["marketing_spend"]),
        "stg_marketing_campaigns": stg_marketing_campaigns(raw["marketing_campaigns"]),
        "stg_dim_user": stg_dim_user(raw["dim_user"]),
        "stg_user_activity": stg_user_activity(raw["user_activity"]),
    }
