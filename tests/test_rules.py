"""Every rule set and guard, firing on a bad row and silent on a good one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.columns import plain_double
from cohortlens.operators.joins import orphan_counts
from cohortlens.operators.windows import rank_events
from cohortlens.plans import model, quality

DAY = dt.date(2024, 1, 2)
AT = dt.datetime(2024, 1, 2, 12)

ACTIVITY = "event_type string, event_at timestamp_ntz, revenue_amount double, attribution_date date, source_date date"
JOURNEY = (
    "user_id string, onboarding_at timestamp_ntz, trial_at timestamp_ntz, first_sale_at timestamp_ntz, started_trial int, made_sale int, "
    "sale_without_trial int, trial_event_count long, sale_event_count long, initial_sale_revenue double, total_sale_revenue double, has_multiple_sales int"
)
MART = (
    "campaign_id string, attributed_users long, trial_users long, sale_users long, sale_without_trial_users long, total_spend double, "
    "initial_sale_revenue double, total_sale_revenue double, trial_rate double, sale_rate double, cost_per_trial double, cost_per_sale double, "
    "initial_revenue_roas double, total_revenue_roas double"
)


def _fires(spark, schema, good: dict, bad: list[dict], rule) -> None:
    """``rule`` finds each of the good row's changes, but not the good row."""
    df = spark.createDataFrame([tuple({**good, **change}.values()) for change in [{}, *bad]], schema)
    tagged = df.withColumn("n", F.monotonically_increasing_id())
    found = {r.n for r in rule(tagged).select("n").collect()}
    assert found == {r.n for r in tagged.select("n").collect()[1:]}


def test_activity_dates(spark):
    good = dict(event_type="start_onboarding", event_at=AT, revenue_amount=None, attribution_date=DAY, source_date=DAY)
    bad = [dict(source_date=DAY + dt.timedelta(1)), dict(event_at=AT + dt.timedelta(1))]
    _fires(spark, ACTIVITY, good, bad, quality.activity_date_violations)


def test_activity_revenue(spark):
    good = dict(event_type="sale", event_at=AT, revenue_amount=1.0, attribution_date=DAY, source_date=DAY)
    bad = [dict(revenue_amount=0.0), dict(revenue_amount=None), dict(event_type="start_trial")]
    _fires(spark, ACTIVITY, good, bad, quality.activity_revenue_violations)


def test_journey(spark):
    hour = dt.timedelta(hours=1)
    good = dict(
        user_id="u", onboarding_at=AT, trial_at=AT + hour, first_sale_at=AT + 2 * hour, started_trial=1, made_sale=1, sale_without_trial=0,
        trial_event_count=1, sale_event_count=2, initial_sale_revenue=3.0, total_sale_revenue=5.0, has_multiple_sales=1,
    )
    bad = [
        dict(trial_event_count=2), dict(started_trial=0), dict(made_sale=0), dict(sale_without_trial=1), dict(has_multiple_sales=0),
        dict(trial_at=AT - hour), dict(first_sale_at=AT - hour), dict(trial_at=AT + 3 * hour), dict(initial_sale_revenue=None),
        dict(initial_sale_revenue=0.0), dict(total_sale_revenue=2.0), dict(sale_event_count=0, has_multiple_sales=0),
    ]
    _fires(spark, JOURNEY, good, bad, quality.journey_violations)


def test_campaigns(spark):
    good = dict(
        campaign_id="c", attributed_users=10, trial_users=5, sale_users=4, sale_without_trial_users=1, total_spend=20.0, initial_sale_revenue=5.0,
        total_sale_revenue=8.0, trial_rate=0.5, sale_rate=0.4, cost_per_trial=4.0, cost_per_sale=5.0, initial_revenue_roas=0.25, total_revenue_roas=0.4,
    )
    bad = [
        dict(trial_users=11), dict(sale_users=11), dict(sale_without_trial_users=5), dict(total_spend=0.0), dict(initial_sale_revenue=-1.0),
        dict(total_sale_revenue=4.0), dict(trial_rate=1.5), dict(sale_rate=-0.1), dict(cost_per_trial=None), dict(cost_per_sale=0.0),
        dict(trial_users=0), dict(sale_users=0, sale_without_trial_users=0), dict(initial_revenue_roas=-1.0), dict(total_revenue_roas=0.1),
    ]
    _fires(spark, MART, good, bad, quality.campaign_rule_violations)


def test_features_against_journey(spark):
    schema = "user_id string, started_trial int, made_sale int"
    journey = spark.createDataFrame([("a", 1, 0), ("b", 0, 0)], schema)
    assert quality.feature_violations(journey, journey).count() == 0
    other = spark.createDataFrame([("a", 0, 0), ("b", 0, 0), ("c", 0, 0)], schema)
    assert {r.issue_type for r in quality.feature_violations(other, journey).collect()} == {"target_mismatch", "row_count_mismatch"}


FEATURES = "user_id string, attribution_date date, gender string, country string, campaign_label string, onboarding_name string, attribution_weekday string, started_trial int, made_sale int"


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [("a", 0, 1), ("a", 0, 1)],
        [(None, 0, 1), (None, 1, 1)],
        [("a", None, 1)],
        [("a", 0, 3)],
    ],
)
def test_training_guard_raises(spark, rows):
    df = spark.createDataFrame([(u, DAY, "g", "c", "l", "o", "w", t, s) for u, t, s in rows], FEATURES)
    with pytest.raises(ValueError):
        quality.validate_features(df)
    with pytest.raises(ValueError):
        quality.validate_features(df.drop("gender"))


def test_split_guard_raises(spark):
    schema = "split string, started_trial int, made_sale int"
    both = [(s, x, 1 - x) for s in ("training", "validation", "test") for x in (0, 1)]
    quality.validate_splits(spark.createDataFrame(both, schema))
    for rows in (both[:4], [*both[:4], ("test", 0, 1), ("test", 0, 0)]):
        with pytest.raises(ValueError):
            quality.validate_splits(spark.createDataFrame(rows, schema))


def test_rows_without_a_date_count_as_one_date(spark):
    days = [DAY + dt.timedelta(i) for i in range(9)]
    rows = [(d,) for d in days for _ in range(2)] + [(None,), (None,)]
    split = model.split_chronologically(spark.createDataFrame(rows, "attribution_date date"))
    assert (split.validation_start, split.test_start) == (days[6], days[8])  # of ten
    assert {(r.split, r["count"]) for r in split.frame.groupBy("split").count().collect()} == {
        ("training", 12), ("validation", 4), ("test", 2), (None, 2),
    }
    with pytest.raises(ValueError):
        model.split_chronologically(spark.createDataFrame([(d,) for d in [*days[:4], None]], "attribution_date date"))


def test_surrogate_key_text_of_doubles(spark):
    import duckdb

    values = [0.0, -0.0, 1.0, 19.99, 1e7, -1.5e9, 0.0005, 1.2345678901234567e-4, 2e-5, 1e16, 1.5e20, 123456789.125, 9999999.5, 1e-10, 1e15, 1e300]
    values += [float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    got = [r.t for r in df.select("i", plain_double("x").alias("t")).orderBy("i").collect()]
    want = [None if x is None else duckdb.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [x]).fetchone()[0] for x in values]
    assert got == want


def test_orphans_are_counted_before_the_join(spark):
    child = spark.createDataFrame([("x", "u1"), ("x", "u2"), ("x", "u1"), ("y", "u3"), (None, "u4")], "code string, user_id string")
    parent = spark.createDataFrame([("y",), ("y",), (None,)], "code string")
    out = orphan_counts(child, parent, "code", "user_id")
    assert sorted(map(tuple, out.collect()), key=str) == [("x", 3, 2), (None, 1, 1)]


def test_ranks_and_group_sizes_in_one_join(spark):
    rows = [("a", 3), ("a", 1), ("b", 7), ("a", 1), (None, 2), (None, 5)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    out = rank_events(df, "k", [F.col("v").asc_nulls_last()], "nth", size="n")
    got = sorted(((r.k, r.v, r.nth, r.n) for r in out.collect()), key=str)
    assert got == sorted([("a", 1, 1, 3), ("a", 1, 2, 3), ("a", 3, 3, 3), ("b", 7, 1, 1), (None, 2, 1, 2), (None, 5, 2, 2)], key=str)
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    # the keys' first positions and sizes in one join; the others look up partition offsets
    assert len([x for x in joins if "broadcast" not in x]) == 1
