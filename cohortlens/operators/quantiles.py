"""Exact order statistics without a global sort or a single-task group.

``exact_quantiles`` gives ``quantile_cont`` (linear interpolation between
the order statistics at 0-based positions ``(n - 1) * p``) over all rows:

1. values are collapsed to ``(v, w)`` (value, multiplicity) by a
   partial-aggregating ``groupBy``: a value held by a third of the rows
   becomes one row;
2. the distinct values are sorted by a range-partitioned sort and written; a
   row's partition is its range, and the ranges and where they start (the
   weights of all ranges before) are a table, one row per range;
3. the wanted ranks are looked up in that table, and joined to it are only the
   ranges that hold one: each is summed up in order in its own window
   partition.

Nothing of this is in the plan's text: its size depends neither on the number
of ranges nor on the values, and no value passes through the driver. Spark's
exact ``percentile`` would instead merge a map of every distinct value into the
one task that finishes a global aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import reliable_checkpoint


def value_weights(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values with their multiplicity: ``(v, w)``."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("w"))


def _sql_literal(x) -> str | None:
    if isinstance(x, bool):
        return None
    if isinstance(x, str):
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(x, int):
        return str(x)
    if isinstance(x, float) and x == x and abs(x) != float("inf"):
        return f"{x!r}D"  # shortest repr round-trips exactly
    return None


def _case_tree(ref: str, lits: list[str], op: str, base: int) -> str:
    if not lits:
        return str(base)
    mid = len(lits) // 2
    right = _case_tree(ref, lits[mid + 1 :], op, base + mid + 1)
    left = _case_tree(ref, lits[:mid], op, base)
    return f"CASE WHEN {ref} {op} {lits[mid]} THEN {right} ELSE {left} END"


def count_below(c: str | Column, cuts: list, strict: bool = True) -> Column:
    """Number of ``cuts`` (sorted, distinct) below ``c`` (``cut < c``, or
    ``cut <= c`` when not ``strict``), as a balanced CASE tree:
    log2(len(cuts)) code-generated comparisons per row. A null ``c`` gives 0.
    For a column name and numeric cuts the tree is one SQL expression (one
    parse instead of a call per node)."""
    op = ">" if strict else ">="
    lits = [_sql_literal(x) for x in cuts]
    if isinstance(c, str) and all(v is not None for v in lits):
        return F.expr(_case_tree(f"`{c}`", lits, op, 0))

    col = F.col(c) if isinstance(c, str) else c

    def tree(cs: list, base: int) -> Column:
        if not cs:
            return F.lit(base)
        mid = len(cs) // 2
        above = col > F.lit(cs[mid]) if strict else col >= F.lit(cs[mid])
        return F.when(above, tree(cs[mid + 1 :], base + mid + 1)).otherwise(tree(cs[:mid], base))

    return tree(list(cuts), 0)


def sorted_ranges(df: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` sorted by ``order`` and written, with ``__at`` (a number that
    rises along the whole order) and ``__range`` (the partition of the sort,
    which rises too). As many ranges as the session sorts into, or ``ranges``."""
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order) if ranges else df.orderBy(*order)
    written = reliable_checkpoint(ordered.withColumn("__at", F.monotonically_increasing_id()))
    return written.withColumn("__range", F.shiftright("__at", 33))


def range_starts(placed: DataFrame, weights: list[str]) -> DataFrame:
    """Per range the sums of ``weights``, as ``{w}_start`` those of all ranges
    before it and as ``{w}_all`` those of all: a row per partition of the sort."""
    order = Window.orderBy("__range")
    before, every = (order.rowsBetween(Window.unboundedPreceding, end) for end in (-1, Window.unboundedFollowing))
    totals = placed.groupBy("__range").agg(*[F.sum(w).alias(w) for w in weights])
    starts = [F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{w}_start") for w in weights]
    return totals.select("__range", *weights, *starts, *[F.sum(w).over(every).alias(f"{w}_all") for w in weights])


def _with_sums(placed: DataFrame, starts: DataFrame, weights: list[str]) -> DataFrame:
    """Rows with ``{w}_before``, the sum of ``w`` over all rows before them in
    the order; each range is summed in its own window partition."""
    inside = Window.partitionBy("__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.join(starts.select("__range", *[f"{w}_start" for w in weights]), "__range")
    sums = {f"{w}_before": F.col(f"{w}_start") + F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights}
    return rows.withColumns(sums).drop(*[f"{w}_start" for w in weights])


def prefix_sums(df: DataFrame, order: str | list[str], weights: list[str], buckets: int | None = None) -> DataFrame:
    """For a frame with one row per value of ``order`` (one column or several),
    add ``{w}_before``: the sum of ``w`` over all rows before it. No task sees
    more than one range of the sort. What ``sorted_ranges`` gave is not sorted
    again."""
    placed = df if "__range" in df.columns else sorted_ranges(df, [order] if isinstance(order, str) else order, buckets)
    return _with_sums(placed, range_starts(placed, weights), weights).drop("__at", "__range")


def exact_quantiles(
    df: DataFrame, col: str, probs: list[float], names: list[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """One row: the exact interpolated quantile of ``col`` for each ``p``
    (null when ``col`` has no non-null value). ``buckets``: ranges to sort
    into, by default as the session does."""
    names = names or [f"q{i}" for i in range(len(probs))]
    placed = sorted_ranges(value_weights(df, col), ["v"], buckets)
    starts = range_starts(placed, ["w"])
    at = [(F.col("w_all") - 1).cast("double") * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(h).cast("long"), F.ceil(h).cast("long")) for h in at])))
    held = F.filter(ranks, lambda k: (k >= F.col("w_start")) & (k < F.col("w_start") + F.col("w")))
    # at most two ranks per probability, whatever the data
    wanted = starts.select("__range", "w_start", "w_all", held.alias("ranks")).where(F.size("ranks") > 0)
    local = placed.join(wanted.select("__range", "w_all", "ranks"), "__range")
    rows = _with_sums(local, wanted, ["w"])
    hit = rows.select(F.col("v").cast("double").alias("v"), F.explode("ranks").alias("k"), "w_before", "w", "w_all")
    hit = hit.where((F.col("k") >= F.col("w_before")) & (F.col("k") < F.col("w_before") + F.col("w")))
    out = []
    for name, h in zip(names, at, strict=True):
        low, high = (F.max(F.when(F.col("k") == f(h).cast("long"), F.col("v"))) for f in (F.floor, F.ceil))
        place = F.max(h)  # the same in every row
        out.append((low + (place - F.floor(place)) * (high - low)).alias(name))
    return hit.agg(*out)
