"""``fct_user_journey``: one row per profiled user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import coalesce0, flag
from ..operators.aggregates import first_event_summary
from ..operators.filters import where_event
from ..sources.schemas import ONBOARDING, SALE, TRIAL

JOURNEY_COLUMNS = (
    "user_id",
    "gender",
    "country",
    "campaign_id",
    "attribution_date",
    "onboarding_name",
    "onboarding_at",
    "trial_at",
    "first_sale_at",
    "started_trial",
    "made_sale",
    "sale_without_trial",
    "trial_event_count",
    "sale_event_count",
    "initial_sale_revenue",
    "total_sale_revenue",
    "has_multiple_sales",
    "has_gender_conflict",
    "has_country_conflict",
    "has_campaign_conflict",
)


def user_outcomes(activity: DataFrame) -> DataFrame:
    """Trial and sale outcome per user in one two-level aggregation:
    ``trial_at, trial_count, sale_at, sale_count, sale_total, sale_initial``."""
    return first_event_summary(
        activity,
        key="user_id",
        ts="event_at",
        kind="event_type",
        kinds={TRIAL: "trial", SALE: "sale"},
        value="revenue_amount",
        valued=(SALE,),
    )


def onboarding_events(activity: DataFrame) -> DataFrame:
    """Onboarding rows, not aggregated: a user with two onboarding rows gets
    two journey rows (the ``unique`` check on the journey reports it)."""
    return where_event(activity, ONBOARDING).select(
        "user_id",
        F.col("event_at").alias("onboarding_at"),
        "attribution_date",
        "onboarding_name",
        "campaign_id",
    )


def fct_user_journey(activity: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles left-joined to onboarding and outcomes on ``user_id``.
    Activity of users missing from the profiles is dropped; attribution
    (campaign, date, onboarding) comes from the onboarding event, not the
    profile.

    All inputs of the main path are reduced to one row per user before they
    meet, so its joins are co-partitioned with the aggregations that feed them
    and no user's rows can weigh on a task. Users with several onboarding rows
    (which the data rules don't allow) are joined to those rows in a path of
    their own: an inner join of two shuffled sides, of which adaptive execution
    splits the heavy one, whatever its keys (over bucketed tables the rows stay
    in their bucket)."""
    outcomes, began = user_outcomes(activity), onboarding_events(activity)
    facts = [c for c in began.columns if c != "user_id"]
    # with one onboarding row, the least is that row
    per_user = began.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*facts)).alias("only"))
    profile = profiles.select(
        "user_id", "gender", "country", "has_gender_conflict", "has_country_conflict", "has_campaign_conflict"
    )
    users = profile.join(per_user, "user_id", "left").join(outcomes, "user_id", "left")
    once = users.where("n is null or n = 1").select("*", "only.*").drop("n", "only")
    # dealt evenly first, so that the join shuffles both sides: adaptive execution splits no other joins
    several = users.where("n > 1").drop("n", "only").hint("rebalance").join(began, "user_id")
    return _journey_columns(once.unionByName(several))


def _journey_columns(j: DataFrame) -> DataFrame:
    trial_at, sale_at = F.col("trial_at"), F.col("sale_at")
    sale_count = coalesce0("sale_count")
    return j.select(
        "user_id",
        "gender",
        "country",
        "campaign_id",
        "attribution_date",
        "onboarding_name",
        "onboarding_at",
        trial_at.alias("trial_at"),
        sale_at.alias("first_sale_at"),
        flag(trial_at.isNotNull()).alias("started_trial"),
        flag(sale_at.isNotNull()).alias("made_sale"),
        flag(sale_at.isNotNull() & trial_at.isNull()).alias("sale_without_trial"),
        coalesce0("trial_count").alias("trial_event_count"),
        sale_count.alias("sale_event_count"),
        F.col("sale_initial").alias("initial_sale_revenue"),
        coalesce0("sale_total", 0.0).alias("total_sale_revenue"),
        flag(sale_count > 1).alias("has_multiple_sales"),
        "has_gender_conflict",
        "has_country_conflict",
        "has_campaign_conflict",
    )
