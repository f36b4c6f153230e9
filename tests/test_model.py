"""Modelling operators against brute force and a closed-form solve."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators.quantiles import exact_quantiles, prefix_sums
from cohortlens.plans import model
from cohortlens.sources.schemas import threshold_grid


def test_threshold_grid_is_float_stepped():
    g = threshold_grid()
    assert len(g) == 46 and g[0] == 0.05 and g[19] == 0.24000000000000005


def _scored(spark, n=400, seed=3, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = round(rnd.random(), 2) if ties else rnd.random()
        if i % 50 == 0:
            s = 0.24000000000000005  # exactly on a grid point
        y = 1 if rnd.random() < 0.2 + 0.5 * s else 0
        rows.append((i, y, float(s)))
    return spark.createDataFrame(rows, "id long, label int, score double"), rows


def _auc_brute(rows):
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    df, rows = _scored(spark)
    got = spark.range(1).select(model.roc_auc(df).alias("a")).first().a
    assert got == pytest.approx(_auc_brute(rows), abs=1e-12)
    df2, rows2 = _scored(spark, ties=False, seed=5)
    assert spark.range(1).select(model.roc_auc(df2).alias("a")).first().a == pytest.approx(_auc_brute(rows2), abs=1e-12)


def test_threshold_metrics_brute_force(spark):
    df, rows = _scored(spark)
    got = {r.threshold: r for r in model.threshold_metrics(df, target="t").collect()}
    P = sum(y for _, y, _ in rows)
    for t in threshold_grid():
        tp = sum(1 for _, y, s in rows if s >= t and y == 1)
        pp = sum(1 for _, y, s in rows if s >= t)
        r = got[t]
        assert r.precision == (tp / pp if pp else 0.0)
        assert r.recall == (tp / P if P else 0.0)
        assert r.f1_score == pytest.approx(2 * tp / (P + pp) if P + pp else 0.0, abs=1e-15)
        assert r.predicted_positive_rate == pp / len(rows)


def test_select_threshold_prefers_higher_on_ties(spark):
    rows = [("t", 0.1, 0.5, 0.5, 0.5, 0.2), ("t", 0.2, 0.5, 0.5, 0.5, 0.1), ("t", 0.3, 0.4, 0.9, 0.9, 0.1)]
    df = spark.createDataFrame(
        rows, "target string, threshold double, f1_score double, precision double, recall double, "
        "predicted_positive_rate double"
    )
    assert model.select_threshold(df).first().threshold == 0.2


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0.01), (0, 0.02)], "label int, score double")
    r = model.threshold_metrics(df, target="t").orderBy(F.col("threshold").desc()).first()
    assert (r.precision, r.recall, r.f1_score, r.predicted_positive_rate) == (0.0, 0.0, 0.0, 0.0)
    assert spark.range(1).select(model.roc_auc(df).alias("a")).first().a is None  # one class only


@pytest.mark.parametrize("buckets", [1, 3, 256])
def test_exact_quantiles_match_numpy(spark, buckets):
    rnd = random.Random(buckets)
    vals = [float(rnd.randint(0, 30)) for _ in range(500)] + [7.0] * 300 + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs, buckets=buckets).first()
    want = np.quantile([v for v in vals if v is not None], probs)  # linear interpolation
    assert list(got) == pytest.approx(list(want), abs=1e-9)


def test_plans_do_not_grow_with_the_ranges(spark):
    """The same result and a plan of the same length at 8 and 2000 ranges; an
    empty column gives nulls."""
    df = spark.range(5000).select((F.col("id") * 37 % 1009 + 0.5).alias("x"))
    probs = [0.1, 0.5, 0.999]
    plans, values = [], []
    for ranges in (8, 2000):
        q = exact_quantiles(df, "x", probs, buckets=ranges)
        plans.append(len(q._jdf.queryExecution().analyzed().toString().splitlines()))
        values.append(tuple(q.first()))
    assert plans[0] == plans[1] and values[0] == values[1]
    assert values[0] == pytest.approx(tuple(np.quantile([i * 37 % 1009 + 0.5 for i in range(5000)], probs)))
    assert tuple(exact_quantiles(df.where("x < 0"), "x", probs).first()) == (None, None, None)


def test_prefix_sums(spark):
    rows = [(float(i), i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "s double, w long")
    out = {r.s: r.w_before for r in prefix_sums(df, "s", ["w"], buckets=7).collect()}
    run = 0
    for s, w in rows:
        assert out[s] == run
        run += w


def test_split_by_distinct_dates(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    rows = [(str(i), d) for i, d in enumerate(days * 3)]  # each date three times
    df = spark.createDataFrame(rows, "user_id string, attribution_date date")
    s = model.split_chronologically(df)
    assert s.validation_start == days[6] and s.test_start == days[8]
    counts = {r.split: r["count"] for r in s.frame.groupBy("split").count().collect()}
    assert counts == {"training": 18, "validation": 6, "test": 6}
    with pytest.raises(ValueError):
        model.split_chronologically(df.where(F.col("attribution_date") <= days[1]))


def _names(enc):
    return {r.slot: (r.predictor, r.category) for r in enc.feature_table().collect()}


def test_encoder_reference_and_unseen(spark):
    train = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x")], "p1 string, p2 string")
    enc = model.Encoder.fit(train, ("p1", "p2"))
    assert dict(map(tuple, enc.reference_table().collect())) == {"p1": "a", "p2": "x"}
    names = _names(enc)
    assert sorted(names) == [0, 1, 2] and sorted(names.values()) == [("p1", "b"), ("p1", "c"), ("p2", "y")]
    test = spark.createDataFrame([("zz", "y"), ("a", "x"), ("b", "x"), ("b", "x")], "p1 string, p2 string")
    got = []
    for r in enc.transform(test).collect():
        v = r.features.toArray()
        assert v.size == 3
        got.append((r.p1, {names[i] for i in range(3) if v[i] == 1.0}))
    # unseen == reference: all zeros
    assert sorted(got, key=str) == [("a", set()), ("b", {("p1", "b")}), ("b", {("p1", "b")}), ("zz", {("p2", "y")})]
    many = spark.createDataFrame([(f"c{i:02d}", "x") for i in range(50)], "p1 string, p2 string")
    wide = model.Encoder.fit(many, ("p1", "p2")).transform(many).first().features
    assert type(wide).__name__ == "SparseVector" and wide.size == 49


def test_a_million_categories_stay_on_the_executors(spark, monkeypatch):
    """The dictionary of a predictor with a million categories is a table: what
    is collected is one row per predictor."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    collected = []
    real = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda df: collected.append(rows := real(df)) or rows)
    train = spark.range(1_000_000, numPartitions=8).select(F.concat(F.lit("c"), F.lpad("id", 7, "0")).alias("p1"), F.lit("x").alias("p2"))
    enc = model.Encoder.fit(train, ("p1", "p2"))
    seen = enc.transform(train.where("p1 in ('c0000000', 'c0000001', 'c0999999')")).select("p1", "features")
    slots = {r.p1: (r.features.size, list(r.features.indices)) for r in real(seen)}
    assert slots == {"c0000000": (999_999, []), "c0000001": (999_999, [999_998]), "c0999999": (999_999, [0])}
    assert sum(map(len, collected)) <= 10
    refs = model.reference_categories(enc, ("t",))
    assert sorted(map(tuple, real(refs))) == [("t", "p1", "c0000000"), ("t", "p2", "x")]


def _newton_logreg(X, y, iters=50):
    """argmin 0.5 |w|^2 + sum logloss, intercept unpenalised."""
    n, k = X.shape
    A = np.hstack([np.ones((n, 1)), X])
    w = np.zeros(k + 1)
    reg = np.eye(k + 1)
    reg[0, 0] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-A @ w))
        g = A.T @ (p - y) + reg @ w
        H = A.T @ (A * (p * (1 - p))[:, None]) + reg
        w -= np.linalg.solve(H, g)
    return w


def test_logistic_regression_matches_reference_objective(spark):
    rnd = random.Random(11)
    cats = {"gender": ["female", "male", "unknown"], "country": ["DE", "FR", "US"],
            "campaign_label": ["C001 - A", "C002 - B"], "onboarding_name": ["sleep", "focus", "fitness"],
            "attribution_weekday": ["monday", "friday"]}
    rows = []
    for i in range(600):
        r = {p: rnd.choice(v) for p, v in cats.items()}
        logit = -1.0 + (0.8 if r["onboarding_name"] == "sleep" else 0) + (0.5 if r["country"] == "US" else 0)
        r["y"] = 1 if rnd.random() < 1 / (1 + np.exp(-logit)) else 0
        rows.append(r)
    df = spark.createDataFrame(rows)
    enc = model.Encoder.fit(df)
    names = _names(enc)
    X = np.array([[1.0 if r[p] == c else 0.0 for p, c in (names[i] for i in range(len(names)))] for r in rows])
    y = np.array([r["y"] for r in rows], dtype=float)
    w = _newton_logreg(X, y)
    fitted = model.fit_target(enc.transform(df), "y", len(rows))
    assert fitted.intercept == pytest.approx(w[0], abs=1e-5)
    assert fitted.coefficients.toArray() == pytest.approx(w[1:], abs=1e-5)
    # counted into cells, the same examples give the same fit
    counted = model.cells(df, ("y",), by=())
    assert counted.count() < len(rows)
    encoded = enc.encode(counted)
    by_cells = model.fit_target(encoded, "y", len(rows), n="n")
    assert by_cells.intercept == pytest.approx(w[0], abs=1e-6)
    assert by_cells.coefficients.toArray() == pytest.approx(w[1:], abs=1e-6)
    assert by_cells.coefficients.toArray() == pytest.approx(fitted.coefficients.toArray(), abs=1e-6)
    # the certificate: no gradient at the optimum; a coefficient moved by 1e-4 shows in the fourth place
    spoilt = model.score(by_cells, encoded).select(*cats, F.lit("y").alias("target"), "score")
    coefs = model.coefficient_table({"y": by_cells}, enc)
    found = model.certificate(df, spoilt, coefs, ("y",))
    assert found.count() == len(names) + 1 and max(abs(r.gradient) for r in found.collect()) < 2e-5
    for p, c in list(names.values())[:3]:
        moved = F.when((F.col("predictor") == p) & (F.col("category") == c), F.col("coefficient") + 1e-4).otherwise(F.col("coefficient"))
        logit = F.log(F.col("score") / (1 - F.col("score"))) + F.when(F.col(p) == c, 1e-4).otherwise(0.0)
        off = model.certificate(df, spoilt.withColumn("score", 1 / (1 + F.exp(-logit))), coefs.withColumn("coefficient", moved), ("y",))
        assert max(abs(r.gradient) for r in off.collect()) > 1e-3


def test_scores_join_back_by_combination(spark):
    rows = [(f"u{i}", "ab"[i % 2], "xyz"[i % 3]) for i in range(12)]
    frame = spark.createDataFrame(rows, "user_id string, p1 string, p2 string")
    scores = frame.select("p1", "p2").distinct().withColumn("target", F.lit("t")).withColumn("score", F.ascii("p1") + F.ascii("p2") * 0.001)
    got = {r.user_id: r.score for r in model.score_rows(frame, scores, ("p1", "p2")).collect()}
    assert got == {u: pytest.approx(ord(a) + ord(b) * 0.001) for u, a, b in rows}
    with pytest.raises(ValueError):
        model.checked_predictors(("gender",))


def test_rank_events_hot_key_matches_window(spark):
    from pyspark.sql import Window

    from cohortlens.operators.windows import group_size, rank_events

    rnd = random.Random(2)
    rows = [("hot" if i % 3 else f"u{i % 17}", rnd.randint(0, 50), float(rnd.randint(0, 3))) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(7)
    got = rank_events(df, "k", [F.col("t"), F.col("v")], "rn")
    w = Window.partitionBy("k").orderBy("t", "v")
    want = df.withColumn("rn", F.row_number().over(w))
    # numbers are a permutation 1..n per key, and agree with the window up to ties
    key = lambda r: (r.k, r.t, r.v)
    g = sorted((key(r), r.rn) for r in got.collect())
    h = sorted((key(r), r.rn) for r in want.collect())
    assert [x for x, _ in g] == [x for x, _ in h]
    by_key = {}
    for (k, t, v), rn in g:
        by_key.setdefault(k, []).append(rn)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_key.values())
    # same multiset of (row, number-range) per tie group
    import itertools

    for (_, a), (_, b) in zip(itertools.groupby(g, key=lambda x: x[0]), itertools.groupby(h, key=lambda x: x[0])):
        assert sorted(x[1] for x in a) == sorted(x[1] for x in b)
    sizes = {r.k: r.n for r in group_size(df, "k", "n").select("k", "n").distinct().collect()}
    assert sizes["hot"] == 2000


def test_one_row_counts_and_pivot_rank(spark):
    from cohortlens.operators.aggregates import one_row_counts, pivot_rank
    from cohortlens.operators.windows import rank_events

    a = spark.range(5)
    b = spark.range(3)
    r = one_row_counts(spark, a=a, b=b).first()
    assert (r.a, r.b) == (5, 3)
    rows = [("u", 2, 10.0), ("u", 1, 20.0), ("v", 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    ranked = rank_events(df, "k", [F.col("t")], "rn")
    out = {x.k: x for x in pivot_rank(ranked, "k", "rn", 2, ["t", "v"]).collect()}
    assert (out["u"].t_1, out["u"].v_1, out["u"].t_2, out["u"].v_2) == (1, 20.0, 2, 10.0)
    assert out["v"].t_2 is None


@pytest.mark.parametrize("kind", ["double", "bigint", "string"])
def test_count_below_brute_force(spark, kind):
    from cohortlens.operators.quantiles import count_below

    rnd = random.Random(kind)
    if kind == "double":
        cuts = sorted({round(rnd.uniform(-5, 5), 3) for _ in range(40)})
        vals = [round(rnd.uniform(-6, 6), 3) for _ in range(300)] + cuts[:5] + [None]
    elif kind == "bigint":
        cuts = sorted({rnd.randint(-100, 100) for _ in range(33)})
        vals = [rnd.randint(-120, 120) for _ in range(300)] + [None]
    else:
        pool = ["a", "b", "O'Brien", "back\\\\slash", "é", "", "zz", "Z", "m n", "x'y\\\\z"]
        cuts = sorted(set(pool[:7]))
        vals = pool + [None]
    df = spark.createDataFrame([(v,) for v in vals], f"x {kind}")
    for strict in (True, False):
        got = [r.n for r in df.select(count_below("x", cuts, strict).alias("n"), "x").orderBy("x").collect()]
        rows = sorted(vals, key=lambda v: (v is not None, v))
        want = [0 if v is None else sum(1 for c in cuts if (c < v if strict else c <= v)) for v in rows]
        assert got == want
