"""Data-quality checks.

Generic column tests (not null, unique, accepted values) are declared per
model in ``SCHEMA_TESTS`` and run in one aggregation, with one scan per model. Rule sets return the violating rows, as a singular SQL test
would. ``check_report`` turns everything into one frame
``(model, test, column_name, violations)``; ``gate`` raises on any
violation so that nothing downstream is published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag
from ..operators.aggregates import one_row_counts
from ..operators.sets import union_all
from ..sources.readers import missing_columns
from ..sources.schemas import (
    CAMPAIGN_TYPES,
    COUNTRY_VALUES,
    EVENT_TYPES,
    GENDER_VALUES,
    ONBOARDING,
    ONBOARDING_NAMES,
    PREDICTORS,
    SALE,
    TARGETS,
    WEEKDAYS,
)

REPORT_COLUMNS = ("model", "test", "column_name", "violations")


@dataclass(frozen=True)
class ColumnTest:
    model: str
    test: str  # not_null | unique | accepted_values
    column: str
    values: tuple = ()


def _tests(model: str, not_null=(), unique=(), accepted=None) -> list[ColumnTest]:
    out = [ColumnTest(model, "not_null", c) for c in not_null]
    out += [ColumnTest(model, "unique", c) for c in unique]
    out += [ColumnTest(model, "accepted_values", c, tuple(v)) for c, v in (accepted or {}).items()]
    return out


BINARY = (0, 1)

# The column tests declared for each model.
SCHEMA_TESTS: list[ColumnTest] = (
    _tests(
        "stg_dim_user",
        not_null=(
            "user_id",
            "gender",
            "country",
            "has_gender_conflict",
            "has_country_conflict",
            "has_campaign_conflict",
        ),
        unique=("user_id",),
        accepted={"gender": GENDER_VALUES, "country": COUNTRY_VALUES},
    )
    + _tests(
        "stg_marketing_campaigns",
        not_null=("campaign_id", "campaign_name", "campaign_type"),
        unique=("campaign_id",),
        accepted={"campaign_type": CAMPAIGN_TYPES},
    )
    + _tests("stg_marketing_spend", not_null=("spend_date", "campaign_id", "spend_amount"))
    + _tests(
        "stg_user_activity",
        not_null=(
            "activity_id",
            "user_id",
            "event_type",
            "event_at",
            "attribution_date",
            "onboarding_name",
            "source_date",
            "campaign_id",
        ),
        unique=("activity_id",),
        accepted={"event_type": EVENT_TYPES, "onboarding_name": ONBOARDING_NAMES},
    )
    + _tests(
        "fct_user_journey",
        not_null=(
            "user_id",
            "campaign_id",
            "attribution_date",
            "onboarding_at",
            "started_trial",
            "made_sale",
            "total_sale_revenue",
        ),
        unique=("user_id",),
        accepted={"started_trial": BINARY, "made_sale": BINARY},
    )
    + _tests(
        "mart_campaign_performance",
        not_null=(
            "campaign_id",
            "campaign_name",
            "campaign_type",
            "attributed_users",
            "trial_users",
            "sale_users",
            "total_spend",
            "initial_sale_revenue",
            "total_sale_revenue",
        ),
        unique=("campaign_id",),
    )
    + _tests(
        "user_features",
        not_null=(
            "user_id",
            "attribution_date",
            "gender",
            "country",
            "campaign_id",
            "campaign_label",
            "onboarding_name",
            "attribution_weekday",
            "attribution_month",
            "started_trial",
            "made_sale",
        ),
        unique=("user_id",),
        accepted={"attribution_weekday": WEEKDAYS, "started_trial": BINARY, "made_sale": BINARY},
    )
)


def _findings(df: DataFrame, tests: dict[int, ColumnTest]) -> DataFrame:
    """What the rows of one model have to say on its tests, as (i, value): a
    null, a value outside its domain, a key. One scan for all tests."""
    said = []
    for i, t in tests.items():
        c = F.col(t.column)
        value = F.lit(None).cast("string") if t.test == "not_null" else c.cast("string")
        if t.test == "not_null":
            condition = c.isNull()
        elif t.test == "unique":
            condition = c.isNotNull()
        else:
            condition = c.isNotNull() & ~c.isin(list(t.values))
        said.append(F.when(condition, F.struct(F.lit(i).alias("i"), value.alias("value"))))
    return df.select(F.explode(F.array(*said)).alias("x")).where("x is not null").select("x.*")


def schema_test_report(models, kinds=("not_null", "unique", "accepted_values"), names=None) -> DataFrame:
    """(model, test, column_name, violations) of all declared column tests over
    ``models`` (anything with ``get(name)``), optionally only some kinds, or
    only the models in ``names``: null rows, keys that occur more than once
    (nulls are no keys), distinct values outside their domain. Each model is
    read once, and what its rows say is counted by (test, value), then by test,
    for all models together; a test with nothing to count is reported as 0."""
    tests = dict(enumerate(t for t in SCHEMA_TESTS if t.test in kinds and (names is None or t.model in names)))
    by_model: dict[str, dict[int, ColumnTest]] = {}
    for i, t in tests.items():
        by_model.setdefault(t.model, {})[i] = t
    rows = union_all(*[_findings(models.get(model), mine) for model, mine in by_model.items()])
    by_value = rows.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    by_test = by_value.groupBy("i").agg(
        F.sum("n").alias("not_null"), F.count(F.lit(1)).alias("accepted_values"), F.count_if(F.col("n") > 1).alias("unique")
    )
    declared = rows.sparkSession.createDataFrame(
        [(i, t.model, t.test, t.column) for i, t in tests.items()], "i int, model string, test string, column_name string"
    )
    counted = F.coalesce(*[F.when(F.col("test") == k, F.col(k)) for k in ("not_null", "accepted_values", "unique")], F.lit(0))
    return declared.join(by_test, "i", "left").select("model", "test", "column_name", counted.cast("long").alias("violations"))


# ---------------------------------------------------------------- rule sets


def campaign_rule_predicate() -> Column:
    c = F.col
    return (
        (c("attributed_users") < c("trial_users"))
        | (c("attributed_users") < c("sale_users"))
        | (c("sale_users") < c("sale_without_trial_users"))
        | (c("total_spend") <= 0)
        | (c("initial_sale_revenue") < 0)
        | (c("total_sale_revenue") < c("initial_sale_revenue"))
        | (c("trial_rate") < 0)
        | (c("trial_rate") > 1)
        | (c("sale_rate") < 0)
        | (c("sale_rate") > 1)
        | ((c("trial_users") == 0) & c("cost_per_trial").isNotNull())
        | ((c("trial_users") > 0) & (c("cost_per_trial").isNull() | (c("cost_per_trial") <= 0)))
        | ((c("sale_users") == 0) & c("cost_per_sale").isNotNull())
        | ((c("sale_users") > 0) & (c("cost_per_sale").isNull() | (c("cost_per_sale") <= 0)))
        | (c("initial_revenue_roas") < 0)
        | (c("total_revenue_roas") < c("initial_revenue_roas"))
    )


def campaign_rule_violations(mart: DataFrame) -> DataFrame:
    """Funnel order, positive spend, rates in 0..1, a cost exists iff there
    is a converter, total ROAS >= initial ROAS. A null comparison does not
    violate (SQL three-valued logic)."""
    return mart.where(campaign_rule_predicate())


def activity_date_violations(activity: DataFrame) -> DataFrame:
    c = F.col
    return activity.where(
        (c("source_date") != c("attribution_date"))
        | ((c("event_type") == ONBOARDING) & (c("event_at").cast("date") != c("attribution_date")))
    )


def activity_revenue_violations(activity: DataFrame) -> DataFrame:
    c = F.col
    return activity.where(
        ((c("event_type") == SALE) & (c("revenue_amount").isNull() | (c("revenue_amount") <= 0)))
        | ((c("event_type") != SALE) & c("revenue_amount").isNotNull())
    )


def journey_violations(journey: DataFrame) -> DataFrame:
    c = F.col
    trial, sale = c("trial_at"), c("first_sale_at")
    return journey.where(
        ~c("trial_event_count").isin(0, 1)
        | (c("started_trial") != flag(trial.isNotNull()))
        | (c("made_sale") != flag(sale.isNotNull()))
        | (c("sale_without_trial") != flag(sale.isNotNull() & trial.isNull()))
        | (c("has_multiple_sales") != flag(c("sale_event_count") > 1))
        | (trial.isNotNull() & (trial < c("onboarding_at")))
        | (sale.isNotNull() & (sale < c("onboarding_at")))
        | (trial.isNotNull() & sale.isNotNull() & (sale < trial))
        | (
            (c("made_sale") == 0)
            & (
                (c("sale_event_count") != 0)
                | sale.isNotNull()
                | c("initial_sale_revenue").isNotNull()
                | (c("total_sale_revenue") != 0)
            )
        )
        | (
            (c("made_sale") == 1)
            & (
                (c("sale_event_count") < 1)
                | sale.isNull()
                | c("initial_sale_revenue").isNull()
                | (c("initial_sale_revenue") <= 0)
                | (c("total_sale_revenue") < c("initial_sale_revenue"))
            )
        )
    )


def feature_violations(features: DataFrame, journey: DataFrame) -> DataFrame:
    """Target mismatches between features and journey (one row per user)
    plus one row when the two tables differ in row count."""
    f = features.select("user_id", F.col("started_trial").alias("f_trial"), F.col("made_sale").alias("f_sale"))
    j = journey.select("user_id", F.col("started_trial").alias("j_trial"), F.col("made_sale").alias("j_sale"))
    mismatch = (
        f.join(j, "user_id", "inner")
        .where((F.col("f_trial") != F.col("j_trial")) | (F.col("f_sale") != F.col("j_sale")))
        .select(F.lit("target_mismatch").alias("issue_type"), "user_id")
    )
    counts = one_row_counts(features.sparkSession, feature_row_count=features, journey_row_count=journey)
    count_issue = counts.where(F.col("feature_row_count") != F.col("journey_row_count")).select(
        F.lit("row_count_mismatch").alias("issue_type"), F.lit(None).cast("string").alias("user_id")
    )
    return union_all(mismatch, count_issue)


RULE_SETS = {
    "campaign_rules": ("mart_campaign_performance", lambda m: campaign_rule_violations(m.get("mart_campaign_performance"))),
    "activity_date_consistency": ("stg_user_activity", lambda m: activity_date_violations(m.get("stg_user_activity"))),
    "activity_revenue_rules": ("stg_user_activity", lambda m: activity_revenue_violations(m.get("stg_user_activity"))),
    "journey_rules": ("fct_user_journey", lambda m: journey_violations(m.get("fct_user_journey"))),
    "feature_rules": (
        "user_features",
        lambda m: feature_violations(m.get("user_features"), m.get("fct_user_journey")),
    ),
}


def violation_count(violations: DataFrame, model: str, test: str) -> DataFrame:
    """One report row for a rule set, present even when it finds nothing."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(model).alias("model"),
        F.lit(test).alias("test"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("violations").cast("long").alias("violations"),
    )


def rule_report(models, names=None) -> DataFrame:
    parts = [
        violation_count(make(models), model, name)
        for name, (model, make) in RULE_SETS.items()
        if names is None or name in names
    ]
    return union_all(*parts)


def check_report(models) -> DataFrame:
    """Every column test and rule set: ``(model, test, column_name, violations)``."""
    return union_all(schema_test_report(models), rule_report(models))


class CheckFailed(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Raise when any check has violations; otherwise return the report.
    Only failing rows (a bounded list of checks) reach the driver."""
    failing = report.where(F.col("violations") > 0).collect()
    if failing:
        lines = ", ".join(f"{r.model}.{r.test}({r.column_name or ''})={r.violations}" for r in failing)
        raise CheckFailed(f"data checks failed: {lines}")
    return report


def gate_model(models, name: str) -> None:
    """Raise if the model ``name`` breaks a column test or a rule set of its
    own. Run as each model is built, so nothing that depends on a failing model
    is published."""
    if any(t.model == name for t in SCHEMA_TESTS):
        gate(schema_test_report(models, names={name}))
    rules = {rule for rule, (model, _) in RULE_SETS.items() if model == name}
    if rules:
        gate(rule_report(models, rules))


# ------------------------------------------------------- training guards


def feature_guard(features: DataFrame, targets=TARGETS, predictors=PREDICTORS) -> DataFrame:
    """One-row summary of the training guards: rows, duplicated users, and
    per target the null and non-0/1 counts."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for t in targets:
        aggs += [
            F.count_if(F.col(t).isNull()).alias(f"{t}_nulls"),
            F.count_if(F.col(t).isNotNull() & ~F.col(t).isin(0, 1)).alias(f"{t}_invalid"),
        ]
    summary = features.agg(*aggs)
    per_user = features.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    dups = per_user.select(F.count_if(F.col("n") > 1)).scalar()  # rows without id count as one user
    return summary.select(
        "row_count", dups.alias("duplicate_users"), *[c for c in summary.columns if c != "row_count"]
    )


def validate_features(features: DataFrame, targets=TARGETS, predictors=PREDICTORS) -> DataFrame:
    """Raise unless the feature table can be trained on."""
    missing = missing_columns(features, ["user_id", "attribution_date", *predictors, *targets])
    if missing:
        raise ValueError(f"features lack {', '.join(missing)}")
    s = feature_guard(features, targets, predictors).first()
    if s.row_count == 0:
        raise ValueError("features are empty: nothing to train on")
    if s.duplicate_users:
        raise ValueError("features hold more than one row for some user_id")
    for t in targets:
        if s[f"{t}_nulls"]:
            raise ValueError(f"target {t} is null in some rows")
        if s[f"{t}_invalid"]:
            raise ValueError(f"target {t} is neither 0 nor 1 in some rows")
    return features


def split_guard(split_df: DataFrame, targets=TARGETS, split_col: str = "split") -> DataFrame:
    """Per split: rows and, per target, min and max (two classes iff min < max)."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for t in targets:
        aggs += [F.min(t).alias(f"{t}_min"), F.max(t).alias(f"{t}_max")]
    return split_df.groupBy(split_col).agg(*aggs)


def validate_splits(split_df: DataFrame, targets=TARGETS, split_col: str = "split",
                    splits=("training", "validation", "test")) -> None:
    rows = {r[split_col]: r for r in split_guard(split_df, targets, split_col).collect()}
    for s in splits:
        r = rows.get(s)
        if r is None or r.row_count == 0:
            raise ValueError(f"no rows fall into the {s} part")
        for t in targets:
            if r[f"{t}_min"] == r[f"{t}_max"]:
                raise ValueError(f"target {t} has a single value in the {s} part")
