"""Conversion models: chronological split, one-hot encoding, logistic
regression (Spark ML), threshold choice and evaluation, coefficient tables.

The evaluation operators (``threshold_metrics``, ``select_threshold``,
``roc_auc``, ``evaluate``) take any frame with a 0/1
label and a score column, so they serve the fitted model and any other
scorer alike. They aggregate on the executors; only bounded results reach
the driver: the two dates that begin a part, how many categories each
predictor has, the model coefficients, at most 47 threshold-bucket rows and
scalar metrics.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import count_below, prefix_sums, sorted_ranges
from ..operators.sets import union_all
from ..operators.windows import rank_events, top_k_per_group
from ..sources.sinks import reliable_checkpoint
from ..sources.schemas import (
    PREDICTORS,
    TARGETS,
    TRAIN_DATE_SHARE,
    UNKNOWN,
    VALIDATION_DATE_SHARE,
    threshold_grid,
)
from .quality import validate_features, validate_splits

MODEL_NAME = "logistic_regression"
#: Relative change of the mean loss at which the solver stops. It passes over
#: cells, so the passes that full convergence takes are cheap.
SOLVER_TOLERANCE = 1e-13


# ------------------------------------------------------------------- L1


@dataclass
class Split:
    frame: DataFrame  # input rows plus a `split` column
    validation_start: object
    test_start: object


def split_chronologically(
    df: DataFrame,
    date_col: str = "attribution_date",
    train_share: float = TRAIN_DATE_SHARE,
    validation_share: float = VALIDATION_DATE_SHARE,
) -> Split:
    """Split by distinct dates: the first ``int(n * train_share)`` dates train,
    up to ``int(n * (train_share + validation_share))`` validate, the rest
    test. The distinct dates are numbered in Spark; the two that begin a part
    reach the driver. Rows without a date belong to no part; all together they
    count as one more date, after the others."""
    d = F.to_date(F.col(date_col))
    # one row per calendar day
    days = df.select(d.alias("d")).where(F.col("d").isNotNull()).distinct()
    numbered = days.withColumn("i", F.row_number().over(Window.orderBy("d")) - 1)
    n = days.count() + df.where(d.isNull()).limit(1).count()
    train_end = int(n * train_share)
    validation_end = int(n * (train_share + validation_share))
    if train_end <= 0 or validation_end <= train_end or validation_end >= n:
        raise ValueError(f"{n} distinct dates can't be cut into three parts that each hold one")
    begins = {r.i: r.d for r in numbered.where(F.col("i").isin(train_end, validation_end)).collect()}
    if len(begins) < 2:
        raise ValueError("the test part would begin with the rows that have no date")
    v_start, t_start = begins[train_end], begins[validation_end]
    # half-open periods [.., v_start), [v_start, t_start), [t_start, ..)
    split = (
        F.when(d.isNull(), F.lit(None).cast("string"))
        .when(d < F.lit(v_start), F.lit("training"))
        .when(d < F.lit(t_start), F.lit("validation"))
        .otherwise(F.lit("test"))
    )
    return Split(df.withColumn("split", split), v_start, t_start)


# ------------------------------------------------------------------- L2


def prepare_predictors(df: DataFrame, predictors=PREDICTORS) -> DataFrame:
    """Predictors as strings, missing -> ``unknown``."""
    return df.withColumns({p: F.coalesce(F.col(p).cast("string"), F.lit(UNKNOWN)) for p in predictors})


def category_table(train: DataFrame, predictors=PREDICTORS) -> DataFrame:
    """(predictor, category, at): every predictor's training categories in
    alphabetical order, numbered through from 0 over all predictors by a
    range-partitioned sort (``prefix_sums``): a predictor's categories never
    meet in one task."""
    pairs = train.select(F.explode(_long(predictors)).alias("p")).select("p.*").distinct()
    return prefix_sums(pairs.withColumn("one", F.lit(1)), ["predictor", "category"], ["one"]).select("predictor", "category", F.col("one_before").alias("at"))


def _long(predictors) -> Column:
    """The predictors of a row as an array of (predictor, category)."""
    return F.array(*[F.struct(F.lit(p).alias("predictor"), F.col(p).alias("category")) for p in predictors])


@dataclass
class Encoder:
    """One-hot encoding with the first category of each predictor as the
    reference (all zeros), like any value unseen in training.

    The dictionary is a table (``category_table``), joined to what is encoded:
    no category reaches the driver, only how many each predictor has. What is
    encoded are distinct combinations of the predictors, not rows. Within a
    predictor, slots run from the last category to the second; vectors are
    sparse (one active slot per predictor, whatever the number of categories),
    built by Spark ML's ``OneHotEncoder`` and ``VectorAssembler``."""

    predictors: tuple
    categories: DataFrame  # predictor, category, at
    sizes: dict = field(default_factory=dict)  # predictor -> number of categories
    starts: dict = field(default_factory=dict)  # predictor -> number of its first category
    onehot: object = None

    @classmethod
    def fit(cls, train: DataFrame, predictors=PREDICTORS) -> Encoder:
        from pyspark.ml.feature import OneHotEncoder

        predictors = tuple(predictors)
        table = reliable_checkpoint(category_table(train, predictors))
        found = table.groupBy("predictor").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).collect()
        enc = cls(predictors, table, {r.predictor: r.n for r in found}, {r.predictor: r.first for r in found})
        sizes = enc.sizes
        # the encoder learns from one row with the greatest index of each predictor
        greatest = train.sparkSession.range(1).select(*[F.lit(float(sizes[p] - 1)).alias(f"__{p}_idx") for p in predictors])
        enc.onehot = OneHotEncoder(
            inputCols=[f"__{p}_idx" for p in predictors], outputCols=[f"__{p}_vec" for p in predictors], dropLast=True
        ).fit(greatest)
        return enc

    def _place(self) -> Column:
        """A category's place in its predictor, from 0."""
        return F.col("at") - F.create_map(*[F.lit(x) for p in self.predictors for x in (p, self.starts[p])])[F.col("predictor")]

    def _index(self) -> Column:
        """A category's index in its predictor's vector; the first category has
        the last one, which the encoder drops."""
        return F.create_map(*[F.lit(x) for p in self.predictors for x in (p, self.sizes[p] - 1)])[F.col("predictor")] - self._place()

    def feature_table(self) -> DataFrame:
        """(slot, predictor, category) of every vector slot."""
        before, begins = 0, {}
        for p in self.predictors:
            begins[p], before = before, before + self.sizes[p] - 1
        begin = F.create_map(*[F.lit(x) for p in self.predictors for x in (p, begins[p])])
        return self.categories.where(self._place() > 0).select((begin[F.col("predictor")] + self._index()).cast("long").alias("slot"), "predictor", "category")

    def reference_table(self) -> DataFrame:
        """(predictor, reference_category)."""
        return self.categories.where(self._place() == 0).select("predictor", F.col("category").alias("reference_category"))

    def encode(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with vectors, by a join with the dictionary per predictor: a
        small dictionary is broadcast by its measured size, a large one meets
        the rows by a shuffle on the predictor."""
        from pyspark.ml.feature import VectorAssembler

        for p in self.predictors:
            own = self.categories.where(F.col("predictor") == p).select(F.col("category").alias(p), self._index().cast("double").alias(f"__{p}_idx"))
            df = df.join(own, p, "left")
        # unseen, like the reference: the last index, which the encoder drops
        last = {f"__{p}_idx": F.coalesce(F.col(f"__{p}_idx"), F.lit(float(self.sizes[p] - 1))) for p in self.predictors}
        vectors = self.onehot.transform(df.withColumns(last))
        assembled = VectorAssembler(inputCols=[f"__{p}_vec" for p in self.predictors], outputCol=out).transform(vectors)
        return assembled.drop(*[f"__{p}_{k}" for p in self.predictors for k in ("idx", "vec")])

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Rows with vectors: each distinct combination is encoded once and
        joined back."""
        return df.join(self.encode(df.select(*self.predictors).distinct(), out), list(self.predictors))


# ------------------------------------------------------------------- L3/L4


def cells(frame: DataFrame, targets=TARGETS, predictors=PREDICTORS, by=("split",)) -> DataFrame:
    """Sufficient statistics of rows whose predictors are all categories: per
    combination (and ``by``) the rows ``n`` and the positives of each target,
    written once. Whatever reads the rows' labels and
    scores reads these."""
    sums = [F.sum(F.col(t).cast("long")).alias(t) for t in targets]
    return reliable_checkpoint(frame.groupBy(*by, *predictors).agg(F.count(F.lit(1)).alias("n"), *sums))


def fit_target(train: DataFrame, target: str, n_train: int, predictors=PREDICTORS, n: str | None = None):
    """L2-penalised logistic regression with the penalty ``0.5 * |w|^2`` on
    the summed log-loss (Spark averages the loss, hence ``regParam = 1/n``);
    intercept unpenalised; no standardisation. ``train`` has a row per example,
    or, with ``n`` naming a count of rows, is ``cells`` with the target's
    positives: each is two weighted examples then."""
    if n is not None:
        weights = F.array(*[F.struct(F.lit(y).alias("label"), w.alias("weight")) for y, w in ((1.0, F.col(target)), (0.0, F.col(n) - F.col(target)))])
        train = train.select("features", F.explode(weights).alias("w")).select("features", "w.label", F.col("w.weight").cast("double").alias("weight"))
        train = train.where("weight > 0")
    else:
        train = train.select("features", F.col(target).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        regParam=1.0 / n_train,
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=1000,
        tol=SOLVER_TOLERANCE,
    )
    return lr.fit(train)


def checked_predictors(predictors) -> tuple:
    """The leakage rule: conversion models use the onboarding-time predictors
    and no others."""
    if tuple(predictors) != tuple(PREDICTORS):
        raise ValueError("both targets use the same onboarding-time predictors only")
    return tuple(predictors)


def score(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1."""
    return model.transform(df).withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "rawPrediction", "probability", "prediction"
    )


def score_rows(frame: DataFrame, scores: DataFrame, predictors=PREDICTORS) -> DataFrame:
    """Rows of ``frame`` with the scores of their combination, one per target
    (``target``, ``score``)."""
    return frame.join(scores, list(predictors))


# ------------------------------------------------------------------- L5-L10


def score_cells(scored: DataFrame, by: tuple = (), n: str | Column = "label", score_col: str = "score", thresholds=None) -> DataFrame:
    """(by..., bucket, n, pos): rows and positives per bucket, a bucket being
    how many thresholds a score reaches. At most ``len(thresholds) + 1`` rows
    per group leave the aggregation. ``n`` names the label column, or a frame
    of distinct scores has ``n`` and ``pos`` already."""
    bucket = count_below(score_col, sorted(thresholds or threshold_grid()), strict=False).alias("bucket")
    if n == "n":
        rows = scored.select(*by, bucket, "n", "pos")
    else:
        rows = scored.select(*by, bucket, F.lit(1).alias("n"), F.col(n).cast("long").alias("pos"))
    return rows.groupBy(*by, "bucket").agg(F.sum("n").cast("long").alias("n"), F.sum("pos").cast("long").alias("pos"))


def _reached(part: str, at: str, what: str) -> str:
    """SQL: the sum of ``what`` over a part's cells that reach threshold ``at``."""
    return f"aggregate(filter(cells, c -> c.part = '{part}' and c.bucket >= {at}), 0L, (a, c) -> a + c.{what})"


def _share(above: str, below: str) -> str:
    return f"if({below} > 0, cast({above} as double) / {below}, 0.0D)"


def with_sweep(cells: DataFrame, by: tuple = (), part: Column | None = None, swept: str = "validation", thresholds=None) -> DataFrame:
    """One row per group: ``cells``, an array of its cells with their ``part``,
    and ``sweep``, per threshold precision, recall, F1 and predicted-positive
    rate over the part ``swept`` (zero division gives 0)."""
    thresholds = sorted(thresholds or threshold_grid())
    part = F.lit(swept) if part is None else part
    rows = cells.groupBy(*by).agg(F.collect_list(F.struct(part.alias("part"), "bucket", "n", "pos")).alias("cells"))
    grid = "array(" + ", ".join(f"{t!r}D" for t in thresholds) + ")"
    counts = (
        f"transform(sequence(1, {len(thresholds)}), i -> named_struct('i', i, 'threshold', element_at({grid}, i), "
        f"'tp', {_reached(swept, 'i', 'pos')}, 'pp', {_reached(swept, 'i', 'n')}, "
        f"'p', {_reached(swept, '0', 'pos')}, 'n', {_reached(swept, '0', 'n')}))"
    )
    metrics = (
        f"transform(counts, x -> named_struct('f1_score', {_share('2 * x.tp', '(x.p + x.pp)')}, 'precision', {_share('x.tp', 'x.pp')}, "
        f"'recall', {_share('x.tp', 'x.p')}, 'threshold', x.threshold, 'predicted_positive_rate', {_share('x.pp', 'x.n')}, 'i', x.i))"
    )
    return rows.withColumn("counts", F.expr(counts)).withColumn("sweep", F.expr(metrics)).drop("counts")


_SWEEP_COLUMNS = ("threshold", "precision", "recall", "f1_score", "predicted_positive_rate")


def threshold_metrics(scored: DataFrame, label: str = "label", score_col: str = "score",
                      thresholds: list[float] | None = None, target: str | None = None) -> DataFrame:
    """Precision, recall, F1 and predicted-positive rate at each threshold
    (predict 1 when ``score >= t``; zero division gives 0), from one
    aggregation by bucket."""
    swept = with_sweep(score_cells(scored, (), label, score_col, thresholds), thresholds=thresholds)
    name = F.lit(target) if target is not None else F.lit(None).cast("string")
    return swept.select(F.explode("sweep").alias("x")).select(name.alias("target"), *[f"x.{c}" for c in _SWEEP_COLUMNS])


def select_threshold(metrics: DataFrame) -> DataFrame:
    """Per target the row with the best F1; ties by precision, recall, then the
    higher threshold."""
    order = [F.col(c).desc() for c in ("f1_score", "precision", "recall", "threshold")]
    return top_k_per_group(metrics, ["target"], order, 1, "__r").drop("__r")


def distinct_scores(scored: DataFrame, by: tuple = (), label: str = "label", score_col: str = "score") -> DataFrame:
    """(by..., s, pos, n): positives and rows per distinct score of a group.
    ``scored`` has a row per example with its label, or per cell
    with ``pos`` and ``n``."""
    cell = {"pos", "n"} <= set(scored.columns)
    pos, n = (F.sum("pos"), F.sum("n")) if cell else (F.sum(F.col(label).cast("long")), F.count(F.lit(1)))
    return scored.groupBy(*by, F.col(score_col).alias("s")).agg(pos.alias("pos"), n.alias("n"))


def ordered_scores(per_score: DataFrame, by: tuple = ()) -> DataFrame:
    """Distinct scores with ``pos_before`` and ``n_before``, the positives and
    rows of their group below each, and ``n_all``, the group's rows. All groups
    are one order, written in that order and summed up by ranges
    (``prefix_sums``); a group's sums count from where it begins, a row per group.
    ``per_score`` may be in that order already (``sorted_ranges``)."""
    rows = prefix_sums(per_score, [*by, "s"], ["pos", "n"])
    groups = rows.groupBy(*[F.col(c).alias(f"of_{c}") for c in by]).agg(
        F.min("pos_before").alias("pos_from"), F.min("n_before").alias("n_from"), F.sum("n").alias("n_all")
    )
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return rows.join(groups, same).select(
        *by, "s", "pos", "n", "n_all", (F.col("pos_before") - F.col("pos_from")).alias("pos_before"), (F.col("n_before") - F.col("n_from")).alias("n_before")
    )


def _auc() -> Column:
    """Exact ROC AUC of ordered scores, ties counted half (Mann-Whitney); null
    when a class is absent."""
    positives, negatives = F.sum("pos").cast("double"), F.sum(F.col("n") - F.col("pos")).cast("double")
    below = F.col("n_before") - F.col("pos_before") + F.lit(0.5) * (F.col("n") - F.col("pos"))
    return F.sum(F.col("pos") * below) / F.nullif(positives * negatives, F.lit(0.0))


def roc_auc(scored: DataFrame, label: str = "label", score_col: str = "score") -> Column:
    """Exact ROC AUC as a scalar column."""
    return ordered_scores(distinct_scores(scored, (), label, score_col)).agg(_auc().alias("auc")).scalar()


def _rank_value(rank: Column) -> Column:
    """The score at a rank (from 0) of a group's rows."""
    return F.max(F.when((F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n")), F.col("s")))


# ------------------------------------------------------------------- L11


# The columns of the metrics record.
METRIC_COLUMNS = (
    "target", "model_name", "prediction_threshold", "validation_start_date", "test_start_date", "train_rows",
    "validation_rows", "test_rows", "train_positive_rate", "validation_positive_rate", "test_positive_rate",
    "validation_roc_auc", "validation_f1", "roc_auc", "precision", "recall", "f1_score",
    "predicted_positive_rate", "minimum_probability", "median_probability", "maximum_probability",
    "true_negative", "false_positive", "false_negative", "true_positive",
)


@dataclass
class Evaluation:
    sweep: DataFrame  # per target and threshold
    chosen: DataFrame  # the best threshold's row per target
    confusion: DataFrame  # the test part's four cells per target
    metrics: DataFrame  # the metrics record per target


def evaluate(scored: DataFrame, split: Split, model_name: str = MODEL_NAME) -> Evaluation:
    """Threshold sweep on validation, the chosen threshold applied to test, of
    every target in ``scored`` (target, split, score and label, or pos and n of
    cells) at once. They are read once, into one row per distinct (target, split, score); all that
    follows reads that table, and joins are between rows per target."""
    by = ("target", "split")
    per_score = sorted_ranges(distinct_scores(scored.where(F.col("split").isNotNull()), by), [*by, "s"])
    part = ordered_scores(per_score, by).groupBy(*by).agg(
        F.sum("n").alias("rows"),
        (F.sum("pos").cast("double") / F.sum("n")).alias("rate"),
        _auc().alias("auc"),
        F.min("s").alias("lowest"),
        F.max("s").alias("highest"),
        _rank_value(F.floor((F.col("n_all") - 1) / 2)).alias("below"),
        _rank_value(F.ceil((F.col("n_all") - 1) / 2)).alias("above"),
    )
    facts = [c for c in part.columns if c not in by]
    parts = part.groupBy("target").agg(
        *[F.max(F.when(F.col("split") == p, F.struct(*facts))).alias(p) for p in ("training", "validation", "test")]
    )
    best = F.array_max("sweep")  # by F1, precision, recall, then the higher threshold
    swept = with_sweep(score_cells(per_score, by, "n", "s"), ("target",), F.col("split")).withColumn("best", best)
    cells = {
        "true_positive": _reached("test", "best.i", "pos"),
        "predicted": _reached("test", "best.i", "n"),
        "positive": _reached("test", "0", "pos"),
        "total": _reached("test", "0", "n"),
    }
    at = swept.select("target", "best", *[F.expr(sql).alias(name) for name, sql in cells.items()])
    tp, predicted, positive, total = (F.col(c) for c in cells)
    confusion = {
        "true_negative": total - predicted - positive + tp,
        "false_positive": predicted - tp,
        "false_negative": positive - tp,
        "true_positive": tp,
    }
    metrics = at.join(parts, "target").select(
        "target",
        F.lit(model_name).alias("model_name"),
        F.col("best.threshold").alias("prediction_threshold"),
        F.lit(split.validation_start).cast("date").alias("validation_start_date"),
        F.lit(split.test_start).cast("date").alias("test_start_date"),
        F.col("training.rows").alias("train_rows"),
        F.col("validation.rows").alias("validation_rows"),
        F.col("test.rows").alias("test_rows"),
        F.col("training.rate").alias("train_positive_rate"),
        F.col("validation.rate").alias("validation_positive_rate"),
        F.col("test.rate").alias("test_positive_rate"),
        F.col("validation.auc").alias("validation_roc_auc"),
        F.col("best.f1_score").alias("validation_f1"),
        F.col("test.auc").alias("roc_auc"),
        F.expr(_share("true_positive", "predicted")).alias("precision"),
        F.expr(_share("true_positive", "positive")).alias("recall"),
        F.expr(_share("2 * true_positive", "(predicted + positive)")).alias("f1_score"),
        F.expr(_share("predicted", "total")).alias("predicted_positive_rate"),
        F.col("test.lowest").alias("minimum_probability"),
        (F.col("test.below") + (F.col("test.above") - F.col("test.below")) * 0.5).alias("median_probability"),
        F.col("test.highest").alias("maximum_probability"),
        *[c.alias(name) for name, c in confusion.items()],
    )
    sweep = swept.select("target", F.explode("sweep").alias("x")).select("target", *[f"x.{c}" for c in _SWEEP_COLUMNS])
    chosen = swept.select("target", *[f"best.{c}" for c in _SWEEP_COLUMNS])
    return Evaluation(sweep, chosen, at.select("target", *[c.alias(name) for name, c in confusion.items()]), metrics)


# ------------------------------------------------------------------- L12/L13


def coefficient_table(models: dict, encoder: Encoder) -> DataFrame:
    """One row per target and non-reference category, for ``models`` by target.
    The coefficients come from the driver, where the solver keeps them; their
    names from the dictionary, by slot."""
    w = {t: m.coefficients.toArray().astype(float) for t, m in models.items()}
    slots = pd.concat([pd.DataFrame({"target": t, "slot": np.arange(len(v), dtype=np.int64), "coefficient": v}) for t, v in w.items()])
    slots = encoder.categories.sparkSession.createDataFrame(slots, "target string, slot long, coefficient double")
    c = F.col("coefficient")
    return encoder.feature_table().join(slots, "slot").select(
        "target",
        "predictor",
        "category",
        F.concat_ws("=", "predictor", "category").alias("feature"),
        c.alias("coefficient"),
        F.abs(c).alias("absolute_importance"),
        F.when(c > 0, "positive").when(c < 0, "negative").otherwise("neutral").alias("direction"),
        F.exp(c).alias("odds_ratio"),
    )


def by_importance(coefs: DataFrame) -> DataFrame:
    """Coefficients with ``importance_rank`` within their target, the largest
    first, sorted so."""
    order = [F.col("absolute_importance").desc(), F.col("feature")]
    ranked = coefs.withColumn("importance_rank", F.row_number().over(Window.partitionBy("target").orderBy(*order)))
    return ranked.orderBy("target", "importance_rank")


def reference_categories(encoder: Encoder, targets=TARGETS) -> DataFrame:
    """(target, predictor, reference_category), read off the dictionary."""
    each = F.explode(F.array(*[F.lit(t) for t in targets])).alias("target")
    return encoder.reference_table().select(each, "predictor", "reference_category")


def certificate(train: DataFrame, scores: DataFrame, coefficients: DataFrame, targets=TARGETS, predictors=PREDICTORS) -> DataFrame:
    """The optimality conditions of the fit, from the training rows themselves:
    per target and feature its rows, its positives, and ``gradient``, the sum of
    x (p - y) plus the penalty's share w. At the optimum every gradient is 0
    (the intercept's, without penalty, is the row ``(intercept)``)."""
    rows = score_rows(train, scores, predictors)
    y = F.when(F.col("target") == targets[0], F.col(targets[0]))
    for t in targets[1:]:
        y = y.when(F.col("target") == t, F.col(t))
    intercept = F.struct(F.lit("").alias("predictor"), F.lit("(intercept)").alias("category"))
    long = rows.select("target", "score", y.cast("long").alias("y"), F.explode(F.array_append(_long(predictors), intercept)).alias("p"))
    long = long.select("target", "score", "y", F.when(F.col("p.predictor") == "", F.col("p.category")).otherwise(F.concat_ws("=", "p.predictor", "p.category")).alias("feature"))
    sums = long.groupBy("target", "feature").agg(
        F.count(F.lit(1)).alias("training_rows"), F.sum("y").alias("positives"), F.sum(F.col("score") - F.col("y")).alias("excess")
    )
    fitted = sums.join(coefficients.select("target", "feature", "coefficient"), ["target", "feature"], "left")
    kept = fitted.where((F.col("feature") == "(intercept)") | F.col("coefficient").isNotNull())
    return kept.select("target", "feature", "training_rows", "positives", (F.col("excess") + F.coalesce("coefficient", F.lit(0.0))).alias("gradient"))


def fit_flag(frame: DataFrame, flag: Column, targets=TARGETS) -> DataFrame:
    """(target, intercept, coefficient) of models with one binary predictor:
    small enough to be solved by hand, by the same path as the full ones."""
    flagged = frame.where(F.col("split") == "training").withColumn("flag", F.when(flag, "yes").otherwise("no"))
    encoder = Encoder.fit(flagged, ("flag",))
    counted = cells(flagged, targets, ("flag",), ())
    encoded = encoder.encode(counted)
    n_train = counted.agg(F.sum("n")).first()[0]
    rows = []
    for t in targets:
        model = fit_target(encoded, t, n_train, ("flag",), n="n")
        rows.append((t, float(model.intercept), float(model.coefficients[0])))
    return frame.sparkSession.createDataFrame(rows, "target string, intercept double, coefficient double")


@dataclass
class ModelOutputs:
    model_metrics: DataFrame
    feature_importance: DataFrame
    reference_categories: DataFrame
    threshold_metrics: DataFrame
    scores: DataFrame = None  # per target and combination of the predictors
    training: DataFrame = None  # the training rows, with the split's other columns

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "model_metrics": self.model_metrics,
            "feature_importance": self.feature_importance,
            "reference_categories": self.reference_categories,
            "threshold_metrics": self.threshold_metrics,
        }


def train_models(features: DataFrame, targets=TARGETS, predictors=PREDICTORS) -> ModelOutputs:
    """Validate, split by date, count the rows into cells, fit one model per
    target on the training cells, and evaluate all targets in one pass. All
    predictors are categories, so rows with the same ones get the same score:
    the rows are read once, to count them; the solver, the scorer and the
    evaluation read cells."""
    predictors = checked_predictors(predictors)
    validate_features(features, targets, predictors)
    split = split_chronologically(prepare_predictors(features, predictors))
    validate_splits(split.frame, targets)
    counted = cells(split.frame.where(F.col("split").isNotNull()), targets, predictors)
    encoder = Encoder.fit(counted.where(F.col("split") == "training"), predictors)
    encoded = reliable_checkpoint(encoder.encode(counted))
    train = encoded.where(F.col("split") == "training")
    n_train = train.agg(F.sum("n")).first()[0]
    # the targets are independent: their jobs run side by side
    with ThreadPoolExecutor(max_workers=len(targets)) as pool:
        fitted = dict(zip(targets, pool.map(lambda t: fit_target(train, t, n_train, predictors, n="n"), targets)))
    scored = union_all(
        *[score(fitted[t], encoded).select(*predictors, "split", F.lit(t).alias("target"), "score", F.col(t).alias("pos"), "n") for t in targets]
    )
    found = evaluate(scored, split)
    metrics, sweep = _small(found.metrics.select(*METRIC_COLUMNS)), _small(found.sweep)
    # a combination has one score, whatever the splits it is in
    scores = scored.groupBy(*predictors, "target").agg(F.min("score").alias("score"))
    coefs = by_importance(coefficient_table(fitted, encoder)).drop("importance_rank")
    training = split.frame.where(F.col("split") == "training")
    return ModelOutputs(metrics, coefs, reference_categories(encoder, targets), sweep, scores, training)


def _small(df: DataFrame) -> DataFrame:
    """A bounded result (46 threshold rows or one row a target) re-created from its rows, so it no
    longer depends on the scored data's lineage."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


# ------------------------------------------------- reference scorer (checks)


def category_rate_scores(split_df: DataFrame, target: str, by: str = "onboarding_name",
                         score_col: str = "score") -> DataFrame:
    """Score = the training-period positive rate of the row's ``by``
    category (the overall training rate for unseen categories); ``label`` =
    the target. A deterministic, solver-free scorer with heavy ties, used
    to check the evaluation operators against plain SQL."""
    train = split_df.where(F.col("split") == "training")
    rate = F.sum(F.col(target)).cast("double") / F.count(F.lit(1))
    rates = train.groupBy(by).agg(rate.alias("__rate"))
    overall = train.select(rate).scalar()
    return split_df.join(rates, by, "left").select(
        "user_id",
        "split",
        F.lit(target).alias("target"),
        F.col(target).cast("int").alias("label"),
        F.coalesce(F.col("__rate"), overall).alias(score_col),
    )


def category_rate_coefficients(split_df: DataFrame, target: str, references: DataFrame, predictors=PREDICTORS) -> DataFrame:
    """A solver-free coefficient table: how far each category's training-period
    positive rate lies from the overall one; reference categories are left out.
    For checks of the report tables against plain SQL."""
    train = split_df.where(F.col("split") == "training")
    pairs = train.select(F.col(target).cast("long").alias("y"), F.explode(F.array(
        *[F.struct(F.lit(p).alias("predictor"), F.col(p).alias("category")) for p in predictors]
    )).alias("p")).select("p.*", "y")
    overall = train.select(F.sum(target).cast("double") / F.count(F.lit(1))).scalar()
    rates = pairs.groupBy("predictor", "category").agg((F.sum("y").cast("double") / F.count(F.lit(1)) - overall).alias("coefficient"))
    refs = references.where(F.col("target") == target).select("predictor", F.col("reference_category").alias("category"))
    left = rates.join(refs, ["predictor", "category"], "left_anti")
    c = F.col("coefficient")
    return left.select(
        F.lit(target).alias("target"), "predictor", "category", F.concat_ws("=", "predictor", "category").alias("feature"), c.alias("coefficient"),
        F.abs(c).alias("absolute_importance"),
        F.when(c > 0, "positive").when(c < 0, "negative").otherwise("neutral").alias("direction"),
        F.exp(c).alias("odds_ratio"),
    )
