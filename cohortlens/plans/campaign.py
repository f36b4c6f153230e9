"""``mart_campaign_performance`` and the portfolio rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import coalesce0, safe_ratio

MART_COLUMNS = (
    "campaign_id",
    "campaign_name",
    "campaign_type",
    "attributed_users",
    "trial_users",
    "sale_users",
    "sale_without_trial_users",
    "first_spend_date",
    "last_spend_date",
    "spend_day_count",
    "total_spend",
    "initial_sale_revenue",
    "total_sale_revenue",
    "trial_rate",
    "sale_rate",
    "cost_per_trial",
    "cost_per_sale",
    "initial_revenue_roas",
    "total_revenue_roas",
)


def outcomes_by_date(journey: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Users of mapped campaigns (unmapped codes drop out of the inner join)
    counted per campaign x attribution date. Users are aggregated before the
    join, which then meets one row per code and day; a second sum counts a
    campaign that is listed twice twice, as joining the users would."""
    daily = journey.groupBy("campaign_id", "attribution_date").agg(
        F.count(F.lit(1)).alias("attributed_users"),
        F.sum("started_trial").alias("trial_users"),
        F.sum("made_sale").alias("sale_users"),
        F.sum("sale_without_trial").alias("sale_without_trial_users"),
        F.sum(coalesce0("initial_sale_revenue", 0.0)).alias("initial_sale_revenue"),
        F.sum("total_sale_revenue").alias("total_sale_revenue"),
    )
    counts = [c for c in daily.columns if c not in ("campaign_id", "attribution_date")]
    joined = daily.join(campaigns.select("campaign_id"), "campaign_id", "inner")
    return joined.groupBy("campaign_id", "attribution_date").agg(*[F.sum(c).alias(c) for c in counts])


def spend_by_date(spend: DataFrame) -> DataFrame:
    return spend.groupBy("campaign_id", "spend_date").agg(F.sum("spend_amount").alias("daily_spend"))


def align_daily(outcomes: DataFrame, daily_spend: DataFrame) -> DataFrame:
    """Both sides are already at campaign x day grain (aggregating first is
    what keeps spend from being multiplied by users); keep only days that
    have both a cohort and spend."""
    o, s = outcomes.alias("o"), daily_spend.alias("s")
    return o.join(
        s,
        (F.col("o.campaign_id") == F.col("s.campaign_id")) & (F.col("o.attribution_date") == F.col("s.spend_date")),
        "inner",
    ).select("o.*", "s.spend_date", "s.daily_spend")


def campaign_rollup(daily: DataFrame) -> DataFrame:
    return daily.groupBy("campaign_id").agg(
        F.min("spend_date").alias("first_spend_date"),
        F.max("spend_date").alias("last_spend_date"),
        F.count(F.lit(1)).alias("spend_day_count"),
        F.sum("daily_spend").alias("total_spend"),
        F.sum("attributed_users").alias("attributed_users"),
        F.sum("trial_users").alias("trial_users"),
        F.sum("sale_users").alias("sale_users"),
        F.sum("sale_without_trial_users").alias("sale_without_trial_users"),
        F.sum("initial_sale_revenue").alias("initial_sale_revenue"),
        F.sum("total_sale_revenue").alias("total_sale_revenue"),
    )


def mart_campaign_performance(journey: DataFrame, campaigns: DataFrame, spend: DataFrame) -> DataFrame:
    """One row per mapped campaign, including campaigns with no aligned day
    (their counts are 0, spend and rates null)."""
    rollup = campaign_rollup(align_daily(outcomes_by_date(journey, campaigns), spend_by_date(spend)))
    m = campaigns.join(rollup, "campaign_id", "left")
    users, trials, sales = (coalesce0(c) for c in ("attributed_users", "trial_users", "sale_users"))
    initial, total = coalesce0("initial_sale_revenue", 0.0), coalesce0("total_sale_revenue", 0.0)
    spend_total = F.col("total_spend")
    return m.select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        users.alias("attributed_users"),
        trials.alias("trial_users"),
        sales.alias("sale_users"),
        coalesce0("sale_without_trial_users").alias("sale_without_trial_users"),
        "first_spend_date",
        "last_spend_date",
        "spend_day_count",
        "total_spend",
        initial.alias("initial_sale_revenue"),
        total.alias("total_sale_revenue"),
        safe_ratio(trials, users).alias("trial_rate"),
        safe_ratio(sales, users).alias("sale_rate"),
        safe_ratio(spend_total, trials).alias("cost_per_trial"),
        safe_ratio(spend_total, sales).alias("cost_per_sale"),
        safe_ratio(initial, spend_total).alias("initial_revenue_roas"),
        safe_ratio(total, spend_total).alias("total_revenue_roas"),
    )


def portfolio(mart: DataFrame) -> DataFrame:
    """Whole-portfolio KPIs in one row: sums, and rates as ratios of sums
    (not means of campaign ratios)."""
    s = {
        c: F.sum(c)
        for c in (
            "attributed_users",
            "trial_users",
            "sale_users",
            "total_spend",
            "initial_sale_revenue",
            "total_sale_revenue",
        )
    }
    return mart.agg(
        *[v.alias(k) for k, v in s.items()],
        safe_ratio(s["trial_users"], s["attributed_users"]).alias("trial_rate"),
        safe_ratio(s["sale_users"], s["attributed_users"]).alias("sale_rate"),
        safe_ratio(s["total_spend"], s["trial_users"]).alias("cost_per_trial"),
        safe_ratio(s["total_spend"], s["sale_users"]).alias("cost_per_sale"),
        safe_ratio(s["initial_sale_revenue"], s["total_spend"]).alias("initial_revenue_roas"),
        safe_ratio(s["total_sale_revenue"], s["total_spend"]).alias("total_revenue_roas"),
    )
