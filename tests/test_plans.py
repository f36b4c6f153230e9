"""Plan shape of the core models with AQE and size-based broadcast off (the
plan a large input gets), each planned over written tables as in a build."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from cohortlens.plans.build import Models, build_all
from cohortlens.plans.journey import fct_user_journey, onboarding_events
from cohortlens.sources import fixtures
from cohortlens.sources.sinks import materialize

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _count(plan: str, node: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}(?:\s|$)", plan, re.M))


@pytest.fixture()
def static(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_core_model_plans(static, scratch):
    raw = {n: materialize(df, n, os.path.join(scratch, "raw")) for n, df in fixtures.raw_sources(static, SF).items()}
    built = build_all(raw, base=os.path.join(scratch, "models"))

    dim = _plan(Models(raw).stg_dim_user)
    assert "Expand" not in dim  # no count(distinct) rewrite
    assert _count(dim, "Exchange") == 1  # one groupBy(user_id), combined map-side
    assert _count(dim, "SortAggregate") == 2  # partial + final, on the strings

    staged = {n: built.get(n) for n in ("stg_user_activity", "stg_dim_user")}
    journey = _plan(Models(raw, staged).fct_user_journey)
    # profiles, outcome levels (user, ts) and (user), onboarding per user: the joins reuse the user_id partitioning of the
    # aggregates. The path of users with several onboarding rows counts them by user again and deals its two sides anew
    assert _count(journey, "Exchange") == 7
    assert _count(journey, "SortMergeJoin") == 5
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", journey)

    upstream = {n: built.get(n) for n in ("fct_user_journey", "stg_marketing_campaigns", "stg_marketing_spend")}
    mart = _plan(Models(raw, upstream).mart_campaign_performance)
    assert _count(mart, "BroadcastExchange") == 0  # no forced broadcast
    # cohort-day and spend-day aggregates, their join and campaigns, rollup
    assert _count(mart, "Exchange") <= 7
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", mart)
    journey_scan = [s for s in schemas if "started_trial" in s][0]
    assert "user_id" not in journey_scan and "gender" not in journey_scan  # column pruning


def test_journey_over_bucketed_tables_has_no_exchange(static, scratch):
    raw = {n: materialize(df, n, os.path.join(scratch, "raw")) for n, df in fixtures.raw_sources(static, SF).items()}
    built = build_all(raw, base=os.path.join(scratch, "bucketed"), user_buckets=4)
    staged = {n: built.get(n) for n in ("stg_user_activity", "stg_dim_user")}
    journey = Models(raw, staged).fct_user_journey
    plan = _plan(journey)
    assert _count(plan, "Exchange") == 0  # aggregations and joins read co-partitioned buckets
    assert _count(plan, "SortMergeJoin") == 5
    plain = build_all(raw, base=os.path.join(scratch, "plain")).fct_user_journey

    def rows(df):
        r = df.select(*[F.round(c, 6).alias(c) if c.endswith("revenue") else F.col(c) for c in df.columns])
        return sorted(tuple(x) for x in r.collect())

    assert rows(journey) == rows(plain) and len(rows(plain)) == 200


def test_a_hot_user_s_onboarding_rows_are_split(spark, scratch):
    """A user with a third of all onboarding rows, half of them the same row:
    adaptive execution splits them over tasks, and the result is the plain left
    join's."""
    activity = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user_id"),
        F.lit("start_onboarding").alias("event_type"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, if(id % 2 = 0, 0, id))").alias("event_at"),
        F.lit(None).cast("double").alias("revenue_amount"),
        F.lit("2024-01-01").cast("date").alias("attribution_date"),
        F.when(F.col("id") % 2 == 0, "sleep").otherwise(F.md5(F.col("id").cast("string"))).alias("onboarding_name"),
        F.lit("C1").alias("campaign_id"),
    )
    activity = materialize(activity, "activity", scratch)
    users = activity.select("user_id").distinct().unionByName(spark.createDataFrame([("none",)], "user_id string"))
    flags = {c: F.lit(False) for c in ("has_gender_conflict", "has_country_conflict", "has_campaign_conflict")}
    profiles = materialize(users.withColumns({"gender": F.lit("female"), "country": F.lit("DE"), **flags}), "profiles", scratch)
    session = spark.newSession()
    for k, v in {"autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "32k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
                 "adaptive.skewJoin.skewedPartitionFactor": "2", "adaptive.coalescePartitions.enabled": "false", "shuffle.partitions": "8"}.items():
        session.conf.set(f"spark.sql.{k}", v)
    tables = [session.read.parquet(os.path.join(scratch, n)) for n in ("activity", "profiles")]
    journey = fct_user_journey(*tables)
    got = journey.groupBy("user_id").count()
    per_user = {r.user_id: r["count"] for r in got.where("user_id in ('hot', 'u1', 'none')").collect()}
    assert per_user == {"hot": 20_000, "u1": 1, "none": 1}
    tasks = journey.withColumn("task", F.spark_partition_id()).where("user_id = 'hot'").groupBy("task").agg(F.count("*").alias("n"), F.max("onboarding_name")).collect()
    assert len(tasks) >= 4 and max(r.n for r in tasks) < 10_000
    plain = tables[1].join(onboarding_events(tables[0]), "user_id", "left").select("user_id", "onboarding_at", "onboarding_name")
    assert journey.select("user_id", "onboarding_at", "onboarding_name").exceptAll(plain).count() == 0
    assert plain.exceptAll(journey.select("user_id", "onboarding_at", "onboarding_name")).count() == 0


def test_checks_and_value_counts_read_a_table_once(static, scratch):
    from cohortlens.plans import profile, quality

    built = build_all(fixtures.raw_sources(static, SF), base=os.path.join(scratch, "models"))
    checks = _plan(quality.schema_test_report(built, names={"stg_user_activity"}))
    assert _count(checks, "Scan parquet") == 1
    raw = {n: materialize(df, n, os.path.join(scratch, "raw")) for n, df in fixtures.raw_sources(static, SF).items()}
    values = _plan(profile.profile_categories(raw))
    assert _count(values, "Scan parquet") == len(raw)
