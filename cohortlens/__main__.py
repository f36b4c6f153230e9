"""Command line: the batch steps as Spark jobs.

    spark-submit -m cohortlens explore --raw RAW_DIR --out OUT_DIR   # source profiles
    spark-submit -m cohortlens build   --raw RAW_DIR --out OUT_DIR   # models as tables, gated by checks
    spark-submit -m cohortlens test    --raw RAW_DIR --out OUT_DIR   # check report over the built tables
    spark-submit -m cohortlens train   --out OUT_DIR                 # model-output tables
    spark-submit -m cohortlens report  --out OUT_DIR                 # report tables

Raw sources are ``RAW_DIR/{name}.csv`` (or ``--fmt parquet``). Everything is
written under ``OUT_DIR`` as parquet and published there (``sources/tables.py``:
readers see the last complete set); nothing is collected but bounded summaries.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .plans import profile, quality, report
from .plans.build import MODEL_ORDER, Models, build_all
from .plans.campaign import portfolio
from .session import tune
from .sources.readers import load, read_raw_sources, typed_raw
from .sources.sinks import materialize, write_outputs
from .sources.tables import Store


def _publish(spark, out: str, group: str, frames: dict) -> Store:
    """A group of result tables under ``{out}/{group}``, all replaced in one step."""
    store = Store(spark, os.path.join(out, group))
    store.publish({name: store.stage(df, name) for name, df in frames.items()})
    return store


def _built(spark, out: str) -> Models:
    base = os.path.join(out, "models")
    return Models({}, {n: load(spark, n, base) for n in MODEL_ORDER})


def explore(spark, args) -> None:
    # about twenty profiles read the sources: parse (CSV) once, profile columnar copies
    raw = {
        n: materialize(typed_raw(df, n), n, os.path.join(args.out, "raw_typed"))
        for n, df in read_raw_sources(spark, args.raw, args.fmt).items()
    }
    act = profile.tidy_event_types(raw["user_activity"])
    frames = {
        "rows": profile.profile_rows(raw),
        "nulls": profile.profile_nulls(raw),
        "exact_duplicates": profile.union_all(*[profile.profile_exact_duplicates(d, n) for n, d in raw.items()]),
        "key_duplicates": profile.profile_key_duplicates(raw["dim_user"]),
        "categories": profile.profile_categories(raw),
        "field_conflicts": profile.profile_field_conflicts(raw["dim_user"]),
        "orphan_codes": profile.union_all(
            profile.profile_orphan_codes(raw["dim_user"], raw["marketing_campaigns"], "dim_user"),
            profile.profile_orphan_codes(raw["user_activity"], raw["marketing_campaigns"], "user_activity"),
        ),
        "orphan_keys": profile.profile_orphan_keys(raw["user_activity"], raw["dim_user"]),
        # by the event types as they stand, untidy spellings included, and by the tidied ones
        "revenue_population": profile.profile_revenue_population(raw["user_activity"]),
        "missing_onboarding": profile.profile_missing_onboarding(raw["user_activity"]),
        "revenue_population_tidy": profile.profile_revenue_population(act),
        "missing_onboarding_tidy": profile.profile_missing_onboarding(act),
        "gender_conflicts": profile.classify_conflicts(raw["dim_user"]),
        "journeys": profile.profile_journeys(act),
        "user_consistency": profile.profile_user_consistency(act),
        "code_overlap": profile.profile_code_overlap(raw["dim_user"], raw["user_activity"]),
        "date_ranges": profile.profile_date_ranges(raw["marketing_spend"], raw["user_activity"]),
        "cohort_maturity": profile.cohort_maturity(act),
        "unmatched_days": profile.profile_unmatched_days(act, raw["marketing_spend"]),
        "sale_counts": profile.profile_sale_counts(act),
        "revenue_distribution": profile.profile_revenue_distribution(act),
        "spend_distribution": profile.profile_spend_distribution(raw["marketing_spend"]),
        "repeat_sales": profile.profile_repeat_sales(act),
        "date_matches": profile.profile_date_matches(act),
    }
    _publish(spark, args.out, "profiles", frames)


def build(spark, args) -> None:
    raw = read_raw_sources(spark, args.raw, args.fmt)
    build_all(raw, base=os.path.join(args.out, "models"), checks=quality.gate_model, user_buckets=args.user_buckets)


def test(spark, args) -> int:
    store = _publish(spark, args.out, "checks", {"check_report": quality.check_report(_built(spark, args.out))})
    failing = store.read("check_report").where("violations > 0")
    return 1 if failing.limit(1).count() else 0


def train(spark, args) -> None:
    from .plans.model import train_models

    outputs = train_models(_built(spark, args.out).user_features)
    write_outputs(outputs.as_dict(), base=args.out)


def app(spark, args) -> None:
    mart = _built(spark, args.out).mart_campaign_performance
    frames = {
        "portfolio": portfolio(mart),
        "filter_values": report.filter_values(mart),
        "decisions": report.decisions(mart),
        "spend_vs_revenue": report.spend_vs_revenue(mart),
        "campaign_detail": report.campaign_detail(mart),
        "campaign_audit": report.campaign_audit(mart),
    }
    for metric in ("total_revenue_roas", "initial_revenue_roas", "cost_per_trial", "cost_per_sale",
                   "trial_rate", "sale_rate"):
        frames[f"ranking_{metric}"] = report.rank_campaigns(mart, metric)
    outputs = Store(spark, os.path.join(args.out, "model_output"))
    if outputs.published():
        coefs, refs, metrics = (outputs.read(n) for n in ("feature_importance", "reference_categories", "model_metrics"))
        factors = report.factor_table(coefs, refs)
        frames.update(
            factor_table=factors,
            leading_predictor=report.leading_predictor(factors),
            model_summary=report.model_summary(metrics),
            confusion=report.confusion_long(metrics),
            comparison_groups=report.comparison_groups(refs),
        )
    _publish(spark, args.out, "reports", frames)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cohortlens")
    ap.add_argument("step", choices=["explore", "build", "test", "train", "report"])
    ap.add_argument("--raw", help="folder with the raw sources")
    ap.add_argument("--fmt", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--user-buckets", type=int, default=None,
                    help="build: bucket the user-keyed staging tables by user_id (co-partitioned journey)")
    args = ap.parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"cohortlens-{args.step}").getOrCreate())
    step = {"explore": explore, "build": build, "test": test, "train": train, "report": app}[args.step]
    return int(step(spark, args) or 0)


if __name__ == "__main__":
    sys.exit(main())
