"""The two-level first-event aggregation against plain Python on random users with ties, null revenues and null timestamps."""

import datetime as dt
import random

import pytest

from cohortlens.plans.journey import user_outcomes


def plain_outcomes(rows):
    """Per user: first trial, trials, first sale, sales, revenue of all sales
    and of those at the first one's time (None where no sale has a revenue)."""
    out = []
    for user in sorted({r[0] for r in rows}):
        trials = [at for u, kind, at, _ in rows if u == user and kind == "start_trial"]
        sales = [(at, rev) for u, kind, at, rev in rows if u == user and kind == "sale"]
        first = min((at for at, _ in sales if at is not None), default=None)
        all_revenue = [rev for _, rev in sales if rev is not None]
        at_first = [rev if at == first and first is not None else 0.0 for at, rev in sales]
        at_first = [rev for rev in at_first if rev is not None]
        trial = min((at for at in trials if at is not None), default=None)
        out.append((user, trial, len(trials), first, len(sales), sum(all_revenue) if all_revenue else None, sum(at_first) if at_first else None))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_two_level_equals_plain_python(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for u in range(300):
        for _ in range(rnd.randint(1, 6)):
            kind = rnd.choice(["sale", "sale", "start_trial", "start_onboarding"])
            ts = None if rnd.random() < 0.08 else dt.datetime(2024, 1, 1, rnd.randint(0, 3))  # many ties
            rev = None if rnd.random() < 0.2 else float(rnd.randint(1, 9))
            rows.append((f"u{u}", kind, ts, rev if kind == "sale" else None))
    df = spark.createDataFrame(rows, "user_id string, event_type string, event_at timestamp_ntz, revenue_amount double")
    got = {r.user_id: r for r in user_outcomes(df).collect()}
    want = plain_outcomes(rows)
    checked = 0
    for user_id, trial_at, trial_count, first_sale_at, sale_count, total, initial in want:
        g = got.get(user_id)
        if g is None:  # only onboarding rows: no outcome row at all
            assert trial_count == 0 and sale_count == 0
            continue
        assert g.trial_count == trial_count and g.sale_count == sale_count
        assert g.trial_at == trial_at
        assert g.sale_at == first_sale_at
        assert g.sale_total == (None if total is None else pytest.approx(total))
        if sale_count == 0:
            assert g.sale_initial is None
        else:
            assert g.sale_initial == (None if initial is None else pytest.approx(initial))
        checked += 1
    assert checked > 250
