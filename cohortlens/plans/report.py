"""Report frames behind the campaign and model views.

All inputs are small, bounded tables (one row per campaign, per target, or
per coefficient); the functions return DataFrames and never pull rows to the
driver. Whole-portfolio benchmarks enter as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import percent
from ..operators.aggregates import distinct_sorted
from ..operators.filters import by_sign
from ..operators.sets import union_all
from ..operators.windows import top_k_per_group
from ..sources.schemas import (
    FACTOR_LABELS,
    PREDICTOR_LABELS,
    RANKING_METRICS,
    RELIABILITY_BANDS,
    RELIABILITY_TOP,
)
from .campaign import portfolio


def metric_order(metric: str, lower_is_better: bool | None = None) -> list[Column]:
    """Best first for the metric's polarity; nulls last; ties by total ROAS
    (descending) then campaign id."""
    if lower_is_better is None:
        lower_is_better = RANKING_METRICS[metric]
    m = F.col(metric)
    first = m.asc_nulls_last() if lower_is_better else m.desc_nulls_last()
    return [first, F.col("total_revenue_roas").desc_nulls_last(), F.col("campaign_id").asc_nulls_last()]


def filter_type(mart: DataFrame, campaign_type: str | None = None) -> DataFrame:
    return mart if campaign_type is None else mart.where(F.col("campaign_type") == F.lit(campaign_type))


def filter_values(mart: DataFrame) -> DataFrame:
    """What the campaign-type filter offers."""
    return distinct_sorted(mart, "campaign_type")


def rank_campaigns(mart: DataFrame, metric: str, campaign_type: str | None = None) -> DataFrame:
    """Campaigns ordered by ``metric`` (polarity-aware) with the portfolio
    benchmark and a better-than-portfolio flag (``<=`` for costs, ``>=``
    otherwise). The type filter applies to the rows only: the benchmark is
    always the whole portfolio."""
    lower = RANKING_METRICS[metric]
    bench = portfolio(mart).select(metric).scalar()
    m = F.col(metric)
    better = (m <= bench) if lower else (m >= bench)
    return (
        filter_type(mart, campaign_type)
        .orderBy(*metric_order(metric, lower))
        .select(
            "campaign_id",
            "campaign_name",
            "campaign_type",
            F.lit(metric).alias("metric"),
            m.alias("metric_value"),
            "attributed_users",
            bench.alias("portfolio_benchmark"),
            F.coalesce(better, F.lit(False)).alias("better_than_portfolio"),
        )
    )


def arg_best(mart: DataFrame, metric: str, lowest: bool = False) -> DataFrame:
    """The single best row for ``metric`` (nulls skipped; first in ROAS-desc
    order on ties). A top-1 sort: each task keeps one row."""
    return mart.where(F.col(metric).isNotNull()).orderBy(*metric_order(metric, lowest)).limit(1)


# decision name -> (metric, lowest)
DECISIONS = {
    "best_efficiency": ("total_revenue_roas", False),
    "lowest_cost_per_trial": ("cost_per_trial", True),
    "largest_revenue": ("total_sale_revenue", False),
    "weakest_efficiency": ("total_revenue_roas", True),
}


def decisions(mart: DataFrame) -> DataFrame:
    """Best ROAS, lowest cost per trial, most revenue, worst ROAS, over all
    campaigns (no type filter)."""
    return union_all(
        *[
            arg_best(mart, metric, lowest).select(
                F.lit(name).alias("decision"),
                "campaign_id",
                "campaign_name",
                F.col(metric).alias("metric_value"),
            )
            for name, (metric, lowest) in DECISIONS.items()
        ]
    )


def spend_vs_revenue(mart: DataFrame) -> DataFrame:
    """Per campaign: spend, revenue, above break-even (revenue > spend), and
    the common axis bound ``greatest(max spend, max revenue)``."""
    bound = mart.select(F.greatest(F.max("total_spend"), F.max("total_sale_revenue"))).scalar()
    return mart.select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "total_spend",
        "total_sale_revenue",
        "total_revenue_roas",
        "sale_users",
        F.coalesce(F.col("total_sale_revenue") > F.col("total_spend"), F.lit(False)).alias("above_break_even"),
        bound.alias("axis_max"),
    )


def campaign_detail(mart: DataFrame) -> DataFrame:
    return mart.select(
        F.concat("campaign_id", F.lit(" — "), "campaign_name").alias("campaign"),
        "campaign_type",
        "attributed_users",
        percent("trial_rate").alias("trial_rate_pct"),
        percent("sale_rate").alias("sale_rate_pct"),
        "total_spend",
        "cost_per_trial",
        "cost_per_sale",
        "total_sale_revenue",
        "total_revenue_roas",
    ).orderBy(F.col("total_revenue_roas").desc_nulls_last())


def campaign_audit(mart: DataFrame) -> DataFrame:
    return mart.select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "attributed_users",
        "trial_users",
        "sale_users",
        "total_spend",
        "cost_per_trial",
        "cost_per_sale",
        "initial_sale_revenue",
        "total_sale_revenue",
        "initial_revenue_roas",
        "total_revenue_roas",
        percent("trial_rate").alias("trial_rate_pct"),
        percent("sale_rate").alias("sale_rate_pct"),
    ).orderBy(F.col("total_revenue_roas").desc_nulls_last())


# ------------------------------------------------------------ model views


def _label_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def factor_table(coefficients: DataFrame, references: DataFrame, k: int = 5) -> DataFrame:
    """Per target the ``k`` largest positive and ``k`` largest negative
    coefficients by absolute size, labelled, with the comparison group
    (the predictor's reference category)."""
    signed = union_all(by_sign(coefficients, True), by_sign(coefficients, False)).withColumn(
        "sign", F.when(F.col("coefficient") > 0, F.lit("positive")).otherwise(F.lit("negative"))
    )
    top = top_k_per_group(signed, ["target", "sign"], [F.col("absolute_importance").desc(), F.col("feature")], k, "factor_rank")
    refs = references.select("target", "predictor", F.col("reference_category").alias("comparison_group"))
    label = F.concat(
        F.coalesce(F.element_at(_label_map(FACTOR_LABELS), F.col("predictor")), F.col("predictor")),
        F.lit(": "),
        F.col("category").cast("string"),
    )
    return top.join(refs, ["target", "predictor"], "left").select(
        "target",
        "sign",
        "factor_rank",
        "predictor",
        "category",
        "feature",
        label.alias("factor_label"),
        "comparison_group",
        "coefficient",
        "absolute_importance",
        "odds_ratio",
        "direction",
    )


def leading_predictor(factors: DataFrame) -> DataFrame:
    """First factor per target: the largest positive one, or the largest
    negative one when no positive factor exists."""
    first = top_k_per_group(factors, ["target"], [F.when(F.col("sign") == "positive", 0).otherwise(1), F.col("factor_rank")], 1)
    return first.select(
        "target",
        "predictor",
        F.coalesce(F.element_at(_label_map(PREDICTOR_LABELS), F.col("predictor")), F.col("predictor")).alias(
            "predictor_label"
        ),
    )


def reliability_label(auc: Column) -> Column:
    out = None
    for bound, label in RELIABILITY_BANDS:
        out = F.when(auc < bound, F.lit(label)) if out is None else out.when(auc < bound, F.lit(label))
    return out.otherwise(F.lit(RELIABILITY_TOP))


# Confusion-cell captions.
CONFUSION_LABELS = (
    ("true_positive", "Converters correctly flagged"),
    ("false_positive", "Non-converters incorrectly flagged"),
    ("false_negative", "Converters missed"),
    ("true_negative", "Non-converters correctly rejected"),
)


def confusion_long(metrics: DataFrame) -> DataFrame:
    """Confusion counts per target in long form ``(target, result, users)``."""
    stack = ", ".join(f"'{label}', CAST({col} AS BIGINT)" for col, label in CONFUSION_LABELS)
    return metrics.selectExpr("target", f"stack({len(CONFUSION_LABELS)}, {stack}) AS (result, users)")


def comparison_groups(references: DataFrame) -> DataFrame:
    """Reference category per target and predictor, with readable names."""
    return references.select(
        "target",
        "predictor",
        F.coalesce(F.element_at(_label_map(PREDICTOR_LABELS), F.col("predictor")), F.col("predictor")).alias(
            "predictor_label"
        ),
        "reference_category",
    )


def model_summary(metrics: DataFrame) -> DataFrame:
    """Headline numbers per target with the reliability label."""
    return metrics.select(
        "target",
        "roc_auc",
        reliability_label(F.col("roc_auc")).alias("reliability"),
        "precision",
        "recall",
        "f1_score",
        "predicted_positive_rate",
        "prediction_threshold",
        "test_start_date",
    )
