"""Source profiles: counts, duplicates, conflicts, orphans, journeys, dates,
distributions.

Every profile is an aggregation that returns a small frame. "More than one
distinct value" tests use ``min != max`` and "no value" tests use
``min is null``: exact, combinable map-side, and free of the Expand that
several ``count(distinct)`` in one aggregate would need. Per-user work is a
partial-aggregating ``groupBy(user_id)``, so a user holding a large share of
the rows does not land whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_col, flag, sum_flag
from ..operators.aggregates import null_counts_long, one_row_counts
from ..operators.joins import key_overlap, orphan_counts
from ..operators.quantiles import exact_quantiles
from ..operators.sets import union_all
from ..sources.schemas import GENDER_SENTINELS, ONBOARDING, SALE, TRIAL, UNKNOWN

NULL_MARK = "__NULL__"


def _distinct_gt1(c) -> Column:
    """``count(distinct c) > 1`` (nulls ignored), as an aggregate."""
    return F.coalesce(F.min(as_col(c)) != F.max(as_col(c)), F.lit(False))


def _with_null_mark(c) -> Column:
    """``coalesce(trim(c), '__NULL__')``: null counted as a value."""
    return F.coalesce(F.trim(as_col(c).cast("string")), F.lit(NULL_MARK))


def tidy_event_types(activity: DataFrame, col: str = "event_type") -> DataFrame:
    """Raw activity with ``event_type`` lower-cased and trimmed, everything
    else untouched; profiles that filter by event type read this."""
    return activity.withColumn(col, F.lower(F.trim(F.col(col))))


# R1
def profile_rows(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        *[df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
          for n, df in tables.items()]
    )


# R2 (schema only: nothing is read)
def profile_schema(df: DataFrame, table: str) -> DataFrame:
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, data_type string")


# R3
def profile_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(*[null_counts_long(df, n) for n, df in tables.items()])


# R4
def profile_exact_duplicates(df: DataFrame, table: str) -> DataFrame:
    """Rows, distinct rows and their difference, from one grouping by all
    columns (duplicates collapse map-side)."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_row_count")
    ).select(
        F.lit(table).alias("table_name"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "distinct_row_count",
        (F.coalesce("row_count", F.lit(0)) - F.col("distinct_row_count")).alias("exact_duplicate_rows"),
    )


def _duplicate_key_groups(dim_user: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Keys with more than one row; per column whether the rows disagree
    (null counts as a value, values trimmed)."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [_distinct_gt1(_with_null_mark(c)).alias(f"{c}_conflict") for c in cols]
    return dim_user.groupBy(key).agg(*aggs).where(F.col("row_count") > 1)


# R5
def profile_key_duplicates(dim_user: DataFrame, key: str = "user_id",
                           cols=("gender", "country", "campaign_id")) -> DataFrame:
    g = _duplicate_key_groups(dim_user, key, list(cols))
    any_conflict = None
    for c in cols:
        any_conflict = F.col(f"{c}_conflict") if any_conflict is None else any_conflict | F.col(f"{c}_conflict")
    return g.agg(
        F.count(F.lit(1)).alias("duplicated_user_ids"),
        F.sum(F.col("row_count") - 1).alias("extra_rows"),
        sum_flag(any_conflict).alias("conflicting_user_ids"),
    )


# R6
def profile_values(df: DataFrame, cols, table: str) -> DataFrame:
    """Value counts of several columns, with visible brackets (``[ x]`` shows
    stray spaces) and ``[NULL]``: each row's (column, value) pairs meet in one
    partial aggregation, so the table is read once."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    shown = [F.coalesce(F.concat(F.lit("["), F.col(c).cast("string"), F.lit("]")), F.lit("[NULL]")) for c in cols]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), v.alias("value")) for c, v in zip(cols, shown, strict=True)])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.column_name", "p.value").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(F.lit(table).alias("table_name"), "column_name", "value", "row_count")


CATEGORY_COLUMNS = {
    "marketing_spend": ("campaign_id",),
    "marketing_campaigns": ("campaign_type",),
    "dim_user": ("gender", "country", "campaign_id"),
    "user_activity": ("event_type", "onboarding_name", "campaign_id"),
}


def profile_categories(tables: dict[str, DataFrame], columns=CATEGORY_COLUMNS) -> DataFrame:
    parts = [profile_values(tables[t], cols, t) for t, cols in columns.items()]
    return union_all(*parts).orderBy("table_name", "column_name", F.col("row_count").desc(), "value")


# R7
def profile_field_conflicts(dim_user: DataFrame, key: str = "user_id",
                            cols=("gender", "country", "campaign_id")) -> DataFrame:
    g = _duplicate_key_groups(dim_user, key, list(cols))
    names = {"gender": "gender_conflicts", "country": "country_conflicts", "campaign_id": "campaign_conflicts"}
    return g.agg(*[sum_flag(F.col(f"{c}_conflict")).alias(names.get(c, f"{c}_conflicts")) for c in cols])


# R8
def profile_orphan_codes(child: DataFrame, parent: DataFrame, source: str, key: str = "campaign_id",
                         user: str = "user_id") -> DataFrame:
    """Child codes missing from the parent: rows and distinct users per code."""
    return orphan_counts(child, parent, key, user).select(F.lit(source).alias("source"), key, "row_count", "user_count")


# R9
def profile_orphan_keys(child: DataFrame, parent: DataFrame, key: str = "user_id") -> DataFrame:
    return orphan_counts(child, parent, key, key).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_activity_rows"), F.sum("user_count").alias("orphan_user_ids")
    ).select("orphan_activity_rows", F.coalesce("orphan_user_ids", F.lit(0)).alias("orphan_user_ids"))


# R10
def profile_revenue_population(activity: DataFrame, by: str = "event_type",
                               col: str = "revenue_amount") -> DataFrame:
    c = F.col(col)
    return activity.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        sum_flag(c.isNull()).alias("null_revenue_rows"),
        sum_flag(c.isNotNull()).alias("populated_revenue_rows"),
        F.min(c).alias("minimum_revenue"),
        F.max(c).alias("maximum_revenue"),
    )


# R11
def profile_missing_onboarding(activity: DataFrame, by: str = "event_type",
                               col: str = "onboarding_name") -> DataFrame:
    return activity.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"), sum_flag(F.col(col).isNull()).alias("null_onboarding_rows")
    )


# R12
def classify_conflicts(dim_user: DataFrame, key: str = "user_id", col: str = "gender") -> DataFrame:
    """Users whose raw values disagree, split into: resolved by normalising,
    one informative value plus unknowns, contradictory informative values."""
    raw = F.col(col)
    cleaned = F.lower(F.trim(raw))
    norm = F.when(raw.isNull() | cleaned.isin(list(GENDER_SENTINELS)), F.lit(UNKNOWN)).otherwise(cleaned)
    informative = F.when(norm != F.lit(UNKNOWN), norm)
    per_user = dim_user.groupBy(key).agg(
        _distinct_gt1(_with_null_mark(raw)).alias("raw_conflict"),
        F.min(norm).alias("norm_min"),
        F.max(norm).alias("norm_max"),
        F.min(informative).alias("inf_min"),
        F.max(informative).alias("inf_max"),
        F.max(flag(norm == F.lit(UNKNOWN))).alias("has_unknown"),
    ).where(F.col("raw_conflict"))
    one_norm = F.col("norm_min") == F.col("norm_max")
    one_inf = F.col("inf_min") == F.col("inf_max")
    many_inf = F.col("inf_min") != F.col("inf_max")
    return per_user.agg(
        F.count(F.lit(1)).alias("raw_gender_conflict_users"),
        sum_flag(one_norm).alias("resolved_by_normalization"),
        sum_flag(one_inf & (F.col("has_unknown") == 1)).alias("known_plus_unknown"),
        sum_flag(many_inf).alias("contradictory_known_values"),
    )


def _user_event_summary(activity: DataFrame, ts: str = "event_date") -> DataFrame:
    t = F.col("event_type")
    return activity.groupBy("user_id").agg(
        sum_flag(t == ONBOARDING).alias("onboarding_events"),
        sum_flag(t == TRIAL).alias("trial_events"),
        sum_flag(t == SALE).alias("sale_events"),
        F.min(F.when(t == ONBOARDING, F.col(ts))).alias("onboarding_at"),
        F.min(F.when(t == TRIAL, F.col(ts))).alias("trial_at"),
        F.min(F.when(t == SALE, F.col(ts))).alias("first_sale_at"),
    )


# R13
def profile_journeys(activity: DataFrame, ts: str = "event_date") -> DataFrame:
    u = _user_event_summary(activity, ts)
    c = F.col
    return u.agg(
        F.count(F.lit(1)).alias("users"),
        sum_flag(c("trial_at").isNotNull()).alias("trial_users"),
        sum_flag(c("first_sale_at").isNotNull()).alias("sale_users"),
        sum_flag(c("first_sale_at").isNotNull() & c("trial_at").isNull()).alias("sale_without_trial_users"),
        sum_flag(c("trial_at") < c("onboarding_at")).alias("trial_before_onboarding_users"),
        sum_flag(c("first_sale_at") < c("onboarding_at")).alias("sale_before_onboarding_users"),
        sum_flag(c("first_sale_at") < c("trial_at")).alias("sale_before_trial_users"),
        sum_flag(c("onboarding_events") != 1).alias("users_without_one_onboarding"),
        sum_flag(c("trial_events") > 1).alias("users_with_multiple_trials"),
        sum_flag(c("sale_events") > 1).alias("users_with_multiple_sales"),
    )


def _sale_order_key(ts: str, value: str) -> Column:
    """Struct that orders sales by timestamp then value, nulls last in both."""
    return F.struct(
        F.col(ts).isNull().alias("ts_null"), F.col(ts).alias("ts"),
        F.col(value).isNull().alias("v_null"), F.col(value).alias("v"),
    )


# R14
def profile_repeat_sales(activity: DataFrame, ts: str = "event_date", value: str = "revenue_amount",
                         days: int = 14) -> DataFrame:
    """Users with exactly two sales: gap under 24 h, 24-48 h inclusive, first
    sale exactly ``days`` after the trial, no trial, equal revenue. The first
    and second sale are the min and max of a (timestamp, revenue) key in one
    per-user aggregation (no per-user window, no join)."""
    t = F.col("event_type")
    key = F.when(t == SALE, _sale_order_key(ts, value))
    per_user = activity.groupBy("user_id").agg(
        F.count_if(t == SALE).alias("sale_event_count"),
        F.min(key).alias("s1"),
        F.max(key).alias("s2"),
        F.min(F.when(t == TRIAL, F.col(ts))).alias("trial_at"),
    ).where(F.col("sale_event_count") == 2)
    first, second = F.col("s1.ts"), F.col("s2.ts")
    h24, h48 = F.expr("INTERVAL 24 HOURS"), F.expr("INTERVAL 48 HOURS")
    trial = F.col("trial_at")
    return per_user.agg(
        F.count(F.lit(1)).alias("users_with_two_sales"),
        sum_flag(second < first + h24).alias("second_sale_within_24_hours"),
        sum_flag((second >= first + h24) & (second <= first + h48)).alias("second_sale_between_24_and_48_hours"),
        sum_flag(trial.isNotNull() & (first == trial + F.expr(f"INTERVAL {days} DAYS"))).alias(
            "first_sale_exactly_14_days_after_trial"
        ),
        sum_flag(trial.isNull()).alias("two_sale_users_without_trial"),
        sum_flag(F.col("s1.v") == F.col("s2.v")).alias("sales_with_equal_revenue"),
    )


# R15
def profile_user_consistency(activity: DataFrame) -> DataFrame:
    c = F.col
    per_user = activity.groupBy("user_id").agg(
        _distinct_gt1("campaign_id").alias("campaign_conflict"),
        _distinct_gt1("attribution_date").alias("date_conflict"),
        _distinct_gt1("onboarding_name").alias("name_conflict"),
        F.min("onboarding_name").alias("name_min"),
        F.max("onboarding_name").alias("name_max"),
        sum_flag(c("onboarding_name").isNull()).alias("null_onboarding_rows"),
    )
    one_name = c("name_min") == c("name_max")
    return per_user.agg(
        sum_flag(c("campaign_conflict")).alias("campaign_conflict_users"),
        sum_flag(c("date_conflict")).alias("attribution_date_conflict_users"),
        sum_flag(c("name_conflict")).alias("onboarding_name_conflict_users"),
        sum_flag(c("name_min").isNull()).alias("users_with_no_onboarding_name"),
        sum_flag(one_name & (c("null_onboarding_rows") > 0)).alias("users_with_partly_missing_onboarding_name"),
    )


# R16
def profile_code_overlap(dim_user: DataFrame, activity: DataFrame, code: str = "C999",
                         key: str = "user_id", col: str = "campaign_id") -> DataFrame:
    a = dim_user.where(F.col(col) == F.lit(code)).select(key).distinct()
    b = activity.where(F.col(col) == F.lit(code)).select(key).distinct()
    return one_row_counts(
        dim_user.sparkSession, dim_user_c999_users=a, activity_c999_users=b, shared_c999_users=key_overlap(a, b, key)
    )


# R17
def profile_date_ranges(spend: DataFrame, activity: DataFrame) -> DataFrame:
    """Coverage of the four date fields, two scans."""
    s = spend.agg(F.min("date").cast("date").alias("lo"), F.max("date").cast("date").alias("hi"))
    a = activity.agg(
        *[
            agg(F.col(c)).cast("date").alias(f"{c}_{nm}")
            for c in ("attribution_date", "event_date", "dt")
            for nm, agg in (("lo", F.min), ("hi", F.max))
        ]
    )
    return union_all(
        s.select(F.lit("marketing_spend.date").alias("source_field"),
                 F.col("lo").alias("minimum_date"), F.col("hi").alias("maximum_date")),
        *[
            a.select(F.lit(f"user_activity.{c}").alias("source_field"),
                     F.col(f"{c}_lo").alias("minimum_date"), F.col(f"{c}_hi").alias("maximum_date"))
            for c in ("attribution_date", "event_date", "dt")
        ],
    )


# R18
def cohort_maturity(activity: DataFrame, days: int = 14, ts: str = "event_date") -> DataFrame:
    """Users whose onboarding cohort has a full ``days``-day window before the
    last observed event day."""
    end = activity.select(F.max(F.col(ts).cast("date"))).scalar()
    through = F.date_sub(end, days)
    cohorts = (
        activity.where(F.col("event_type") == ONBOARDING)
        .groupBy("user_id")
        .agg(F.min("attribution_date").alias("attribution_date"))
    )
    mature = sum_flag(F.col("attribution_date") <= through)
    return cohorts.agg(
        F.count(F.lit(1)).alias("users"),
        mature.alias("mature_users"),
        sum_flag(F.col("attribution_date") > through).alias("immature_users"),
    ).where(F.col("users") > 0).select(
        end.alias("observation_end_date"),
        through.alias("mature_through_date"),
        "users",
        "mature_users",
        "immature_users",
        F.round(F.lit(100.0) * F.col("mature_users").cast("double") / F.col("users"), 2).alias(
            "mature_user_percentage"
        ),
    )


# R19
def profile_unmatched_days(activity: DataFrame, spend: DataFrame) -> DataFrame:
    """Distinct (attribution date, campaign) cohorts with no spend row, per
    campaign."""
    cohorts = activity.select(F.col("attribution_date").alias("date"), "campaign_id").distinct()
    keys = spend.select("date", "campaign_id").where(F.col("date").isNotNull() & F.col("campaign_id").isNotNull())
    missing = cohorts.join(keys.distinct(), ["date", "campaign_id"], "left_anti")
    return missing.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("unmatched_date_count"))


# R20
def profile_sale_counts(activity: DataFrame, value: str = "revenue_amount") -> DataFrame:
    per_user = (
        activity.where(F.col("event_type") == SALE)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("sale_events"), F.sum(value).alias("total_revenue"))
    )
    return per_user.groupBy("sale_events").agg(
        F.count(F.lit(1)).alias("user_count"), F.round(F.sum("total_revenue"), 2).alias("total_revenue")
    )


QUANTILE_PROBS = (0.25, 0.50, 0.75, 0.95, 0.99)


# R21
def profile_distribution(df: DataFrame, col: str, stem: str, rows_name: str) -> DataFrame:
    """Rows, non-positive rows, min, exact p25/median/p75/p95/p99, max, all
    rounded to cents. Column names follow ``stem``: ``minimum_{stem}``,
    ``{stem}_p25``, ``median_{stem}``, ..."""
    c = F.col(col)
    basic = df.agg(
        F.count(F.lit(1)).alias(rows_name),
        sum_flag(c <= 0).alias(f"non_positive_{stem}_rows"),
        F.round(F.min(c), 2).alias(f"minimum_{stem}"),
        F.round(F.max(c), 2).alias(f"maximum_{stem}"),
    )
    qnames = [f"{stem}_p25", f"median_{stem}", f"{stem}_p75", f"{stem}_p95", f"{stem}_p99"]
    q = exact_quantiles(df, col, list(QUANTILE_PROBS), qnames)
    # the one-row quantile frame enters as a single struct-valued subquery
    qs = q.select(F.struct(*[F.round(F.col(n), 2).alias(n) for n in qnames])).scalar()
    order = [rows_name, f"non_positive_{stem}_rows", f"minimum_{stem}", *qnames, f"maximum_{stem}"]
    return basic.withColumn("__q", qs).select(*basic.columns, *[F.col(f"__q.{n}").alias(n) for n in qnames]).select(
        *order
    )


def profile_revenue_distribution(activity: DataFrame) -> DataFrame:
    sales = activity.where(F.col("event_type") == SALE)
    return profile_distribution(sales, "revenue_amount", "revenue", "sale_rows")


def profile_spend_distribution(spend: DataFrame) -> DataFrame:
    return profile_distribution(spend, "spend", "spend", "spend_rows")


# R22
def profile_date_matches(activity: DataFrame, ts: str = "event_date") -> DataFrame:
    c = F.col
    onb = c("event_type") == ONBOARDING
    return activity.agg(
        F.count(F.lit(1)).alias("activity_rows"),
        sum_flag(c("dt").cast("date") == c("attribution_date")).alias("dt_matches_attribution_date"),
        sum_flag(onb & (c(ts).cast("date") == c("attribution_date"))).alias("onboarding_matches_attribution_date"),
        sum_flag(onb).alias("onboarding_rows"),
    )
