"""``user_features``: one row per journey row, onboarding-time fields only
plus the two targets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import campaign_label, month_num, weekday_name


def user_features(journey: DataFrame, campaigns: DataFrame) -> DataFrame:
    names = campaigns.select("campaign_id", "campaign_name")
    j = journey.join(names, "campaign_id", "left")
    return j.select(
        "user_id",
        "attribution_date",
        "gender",
        "country",
        "campaign_id",
        campaign_label("campaign_id", "campaign_name").alias("campaign_label"),
        "onboarding_name",
        weekday_name("attribution_date").alias("attribution_weekday"),
        month_num("attribution_date").alias("attribution_month"),
        "started_trial",
        "made_sale",
    )
