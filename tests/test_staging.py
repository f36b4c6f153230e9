"""Staging traps: conflict policies, sentinels, blanks, surrogate key."""

import datetime as dt

from cohortlens.plans.staging import stg_dim_user, stg_marketing_spend, stg_user_activity

DIM = "user_id string, gender string, country string, campaign_id string"
ACT = (
    "user_id string, event_type string, event_date timestamp_ntz, revenue_amount double, "
    "attribution_date date, onboarding_name string, dt date, campaign_id string"
)


def _users(spark, rows):
    return {r.user_id: r for r in stg_dim_user(spark.createDataFrame(rows, DIM)).collect()}


def test_gender_policy_ignores_unknown_but_country_does_not(spark):
    u = _users(
        spark,
        [
            ("1", "female", "US", "C001"),
            ("1", None, "XX", "C001"),  # gender unknown: not a conflict; country unknown+US: conflict
            ("2", "Female ", "DE", "C002"),
            ("2", "?", "DE", "C002"),
        ],
    )
    assert u["1"].gender == "female" and not u["1"].has_gender_conflict
    assert u["1"].country == "unknown" and u["1"].has_country_conflict
    assert u["2"].gender == "female" and u["2"].country == "DE"
    assert not u["2"].has_country_conflict


def test_prefer_not_to_say_is_informative(spark):
    u = _users(spark, [("1", "female", "US", "C001"), ("1", "prefer_not_to_say", "US", "C001")])
    assert u["1"].gender == "unknown" and u["1"].has_gender_conflict


def test_contradictions_and_all_unknown(spark):
    u = _users(
        spark,
        [
            ("1", "female", "DE", "C001"),
            ("1", "male", "FR", "C002"),
            ("2", "UnknownX", None, None),
            ("2", "unknown", "ZZ", None),
            ("3", "male", "GB", "C001"),
            ("3", "male", "GB", None),
        ],
    )
    assert (u["1"].gender, u["1"].country, u["1"].campaign_id) == ("unknown", "unknown", None)
    assert u["1"].has_gender_conflict and u["1"].has_country_conflict and u["1"].has_campaign_conflict
    assert (u["2"].gender, u["2"].country, u["2"].campaign_id) == ("unknown", "unknown", None)
    assert not (u["2"].has_gender_conflict or u["2"].has_country_conflict or u["2"].has_campaign_conflict)
    # campaign null + C001: one distinct non-null value -> kept, no conflict
    assert u["3"].campaign_id == "C001" and not u["3"].has_campaign_conflict


def test_empty_strings_are_not_sentinels(spark):
    u = _users(spark, [("1", "", "", "")])
    assert u["1"].gender == "" and u["1"].country == ""
    assert u["1"].campaign_id is None  # blank campaign -> null


def test_spend_code_is_not_normalised(spark):
    raw = spark.createDataFrame([(dt.date(2024, 1, 1), " c001", 5.0)], "date date, campaign_id string, spend double")
    assert stg_marketing_spend(raw).first().campaign_id == " c001"


def test_activity_normalisation_and_key_excludes_dt(spark):
    ts = dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    rows = [
        ("7", " SALE", ts, 12.5, dt.date(2024, 1, 1), " Sleep", dt.date(2024, 1, 1), "c001"),
        ("7", " SALE", ts, 12.5, dt.date(2024, 1, 1), " Sleep", dt.date(2024, 1, 9), "c001"),
        ("7", "start_trial", ts, 0.0, dt.date(2024, 1, 1), "", dt.date(2024, 1, 1), " "),
    ]
    out = stg_user_activity(spark.createDataFrame(rows, ACT)).collect()
    sale1, sale2, trial = out
    assert sale1.event_type == "sale" and sale1.onboarding_name == "sleep" and sale1.campaign_id == "C001"
    assert sale1.activity_id == sale2.activity_id  # dt is not part of the key
    assert trial.revenue_amount is None  # revenue kept for sales only
    assert trial.onboarding_name == "unknown" and trial.campaign_id is None
    # the key text: fields joined by '-', nulls marked
    import hashlib

    text = "-".join(["7", "start_trial", "2024-01-01 10:00:00.5", "_dbt_utils_surrogate_key_null_", "2024-01-01",
                     "unknown", "_dbt_utils_surrogate_key_null_"])
    assert trial.activity_id == hashlib.md5(text.encode()).hexdigest()


def test_resolver_against_plain_python(spark):
    import random

    from cohortlens.operators.resolve import Resolution, resolve

    rnd = random.Random(9)
    domain = ["a", "b", "O'Brien", "back\\slash", "é", "", "unknown", "Z", "zz", None]
    rows = [(f"u{rnd.randint(0, 60)}", rnd.choice(domain), rnd.choice(domain)) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, x string, y string")
    rules = [
        Resolution("x", ignore="unknown", on_conflict="unknown", conflict_flag="x_conflict"),
        Resolution("y", ignore=None, on_conflict=None, conflict_flag="y_conflict"),
    ]
    want = []
    for k in sorted({r[0] for r in rows}):
        x = {r[1] for r in rows if r[0] == k} - {None, "unknown"}
        y = {r[2] for r in rows if r[0] == k} - {None}
        want.append((k, x.pop() if len(x) == 1 else "unknown", y.pop() if len(y) == 1 else None, len(x) > 1, len(y) > 1))
    assert sorted(tuple(r) for r in resolve(df, "k", rules).collect()) == want
