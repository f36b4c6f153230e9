"""Journey and mart traps: first-sale revenue ties, fan-out, dropped
orphans, spend alignment, null rates, zero division."""

import datetime as dt

import pytest

from cohortlens.plans.build import Models
from cohortlens.plans.campaign import portfolio
from cohortlens.plans.report import decisions

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def T(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


ACT = (
    "user_id string, event_type string, event_date timestamp_ntz, revenue_amount double, "
    "attribution_date date, onboarding_name string, dt date, campaign_id string"
)


def onboarding(u, day, camp="C001"):
    return (u, "start_onboarding", T(day), None, dt.date(2024, 1, day), "sleep", dt.date(2024, 1, day), camp)


def event(u, kind, ts, rev, day, camp="C001"):
    return (u, kind, ts, rev, dt.date(2024, 1, day), "sleep", dt.date(2024, 1, day), camp)


def models(spark, activity, users, spend, campaigns=None):
    campaigns = campaigns or [("C001", "One", "Social"), ("C002", "Two", "Video"), ("C003", "Three", "Search")]
    raw = {
        "user_activity": spark.createDataFrame(activity, ACT),
        "dim_user": spark.createDataFrame(users, "user_id string, gender string, country string, campaign_id string"),
        "marketing_spend": spark.createDataFrame(spend, "date date, campaign_id string, spend double"),
        "marketing_campaigns": spark.createDataFrame(
            campaigns, "campaign_id string, campaign_name string, campaign_type string"
        ),
    }
    return Models(raw)


def users(*ids, camp="C001"):
    return [(u, "male", "US", camp) for u in ids]


def test_initial_revenue_rules(spark):
    act = [
        onboarding("a", 1), event("a", "sale", T(2), 10.0, 1), event("a", "sale", T(2), 5.0, 1),
        event("a", "sale", T(3), 7.0, 1),  # ties at the first timestamp are summed
        onboarding("b", 1), event("b", "sale", T(2), None, 1), event("b", "sale", T(3), 4.0, 1),  # null first -> 0
        onboarding("c", 1), event("c", "sale", T(2), None, 1),  # only a null first sale -> null
        onboarding("d", 1), event("d", "start_trial", T(2), None, 1),  # no sale
        onboarding("e", 1), event("e", "sale", None, 3.0, 1),  # sale without timestamp -> 0
    ]
    m = models(spark, act, users("a", "b", "c", "d", "e"), [(D1, "C001", 10.0)])
    j = {r.user_id: r for r in m.fct_user_journey.collect()}
    assert j["a"].initial_sale_revenue == 15.0 and j["a"].total_sale_revenue == 22.0 and j["a"].sale_event_count == 3
    assert j["b"].initial_sale_revenue == 0.0 and j["b"].total_sale_revenue == 4.0
    assert j["c"].initial_sale_revenue is None and j["c"].made_sale == 1
    assert j["d"].initial_sale_revenue is None and j["d"].total_sale_revenue == 0.0 and j["d"].started_trial == 1
    assert j["e"].initial_sale_revenue == 0.0 and j["e"].made_sale == 0 and j["e"].sale_event_count == 1
    assert j["a"].has_multiple_sales == 1 and j["a"].sale_without_trial == 1


def test_fan_out_orphans_and_attribution(spark):
    act = [
        onboarding("a", 1, "c002"), onboarding("a", 2, "c002"),  # two onboarding rows fan out
        onboarding("z", 1),  # not in the profile table: dropped
    ]
    m = models(spark, act, users("a", camp="C001") + users("q"), [(D1, "C002", 1.0)])
    rows = m.fct_user_journey.collect()
    assert sorted(r.user_id for r in rows) == ["a", "a", "q"]
    assert {r.campaign_id for r in rows if r.user_id == "a"} == {"C002"}  # from onboarding, not profile
    assert [r.campaign_id for r in rows if r.user_id == "q"] == [None]


def test_mart_alignment_and_null_rates(spark):
    act = [
        onboarding("a", 1), event("a", "start_trial", T(1, 5), None, 1), event("a", "sale", T(2), 9.0, 1),
        onboarding("b", 2),  # cohort day 2 has no spend
        onboarding("c", 1, "C002"), event("c", "sale", T(2), 4.0, 1, "C002"),  # sale, no trial
        onboarding("x", 1, "C999"),  # unmapped
    ]
    spend = [
        (D1, "C001", 2.0), (D1, "C001", 3.0),  # two rows one day: summed
        (D3, "C001", 100.0),  # spend day with no cohort: not counted
        (D1, "c002", 50.0),  # lower-case code: never aligns
        (D1, "C002", 8.0),
    ]
    m = models(spark, act, users("a", "b", "c", "x"), spend)
    mart = {r.campaign_id: r for r in m.mart_campaign_performance.collect()}
    c1 = mart["C001"]
    assert (c1.attributed_users, c1.trial_users, c1.sale_users, c1.spend_day_count) == (1, 1, 1, 1)
    assert c1.total_spend == 5.0 and c1.cost_per_trial == 5.0 and c1.total_revenue_roas == 9.0 / 5.0
    c2 = mart["C002"]
    assert (c2.trial_users, c2.sale_users, c2.sale_without_trial_users) == (0, 1, 1)
    assert c2.cost_per_trial is None and c2.cost_per_sale == 8.0  # zero trials: null, not an error
    c3 = mart["C003"]  # no users, no spend
    assert (c3.attributed_users, c3.trial_users, c3.sale_users) == (0, 0, 0)
    assert c3.total_spend is None and c3.trial_rate is None and c3.initial_revenue_roas is None
    assert c3.initial_sale_revenue == 0.0 and c3.spend_day_count is None
    assert "C999" not in mart
    p = portfolio(m.mart_campaign_performance).first()
    assert p.total_spend == 13.0 and p.total_revenue_roas == 13.0 / 13.0
    assert p.trial_rate == 1 / 2  # ratio of sums


def test_decisions_skip_nulls_and_break_ties(spark):
    act = [onboarding("a", 1), event("a", "sale", T(2), 10.0, 1), onboarding("b", 1, "C002"),
           event("b", "sale", T(2), 10.0, 1, "C002")]
    m = models(spark, act, users("a", "b"), [(D1, "C001", 5.0), (D1, "C002", 5.0)])
    d = {r.decision: r for r in decisions(m.mart_campaign_performance).collect()}
    assert d["best_efficiency"].campaign_id == "C001"  # tie on ROAS: lower id
    assert d["weakest_efficiency"].campaign_id == "C001"
    assert "lowest_cost_per_trial" not in d  # no campaign has trials: every cost is null
    assert all(r.metric_value is not None for r in d.values())


def test_hot_user_results_are_whole(spark):
    """One user holds most rows (duplicate profiles and thousands of sales);
    nothing is dropped or capped and the aggregates are exact."""
    import random

    rnd = random.Random(4)
    act = [onboarding("hot", 1), onboarding("b", 1)]
    revs = []
    for i in range(3000):
        r = float(rnd.randint(1, 500))
        day = 2 + (i % 20)
        act.append(event("hot", "sale", dt.datetime(2024, 1, day, i % 24, i % 60), r, 1))
        revs.append((dt.datetime(2024, 1, day, i % 24, i % 60), r))
    act.append(event("b", "start_trial", T(2), None, 1))
    profiles = [("hot", "female", "US", "C001")] * 2000 + [("hot", None, "US", "C001")] * 500 + users("b")
    m = models(spark, act, profiles, [(D1, "C001", 10.0)])
    j = {r.user_id: r for r in m.fct_user_journey.collect()}
    first = min(t for t, _ in revs)
    assert j["hot"].sale_event_count == 3000
    assert j["hot"].total_sale_revenue == pytest.approx(sum(r for _, r in revs))
    assert j["hot"].initial_sale_revenue == pytest.approx(sum(r for t, r in revs if t == first))
    assert j["hot"].gender == "female" and not j["hot"].has_gender_conflict
    assert j["b"].started_trial == 1 and j["b"].made_sale == 0
    mart = {r.campaign_id: r for r in m.mart_campaign_performance.collect()}
    assert mart["C001"].attributed_users == 2 and mart["C001"].sale_users == 1
