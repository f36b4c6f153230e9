"""Aggregation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_event_summary(
    df: DataFrame,
    key: str,
    ts: str,
    kind: str,
    kinds: dict[str, str],
    value: str | None = None,
    valued: tuple[str, ...] = (),
) -> DataFrame:
    """Per ``key`` and per event kind: first timestamp ``{p}_at``, event count
    ``{p}_count``; for kinds in ``valued`` also the value total
    ``{p}_total`` and the value at the first timestamp ``{p}_initial``
    (all events tied at the first timestamp summed).

    Two partial-aggregating levels, ``(key, ts)`` then ``key``, replace the
    self-join to the per-key minimum; a key holding a large share of the
    rows is spread by the first level and collapsed map-side by the second.

    ``{p}_initial`` follows the self-join form exactly: with the sum of
    ``case when ts = first then value else 0 end`` over the kind's rows it
    is 0 when the first timestamp is null, the (null-skipping) sum at the
    first timestamp when no other rows exist, and that sum with null read as
    0 when other rows exist. It is null for keys without rows of the kind.
    """
    level1 = []
    for k, p in kinds.items():
        is_k = F.col(kind) == F.lit(k)
        level1.append(F.count_if(is_k).alias(f"__n_{p}"))
        if k in valued:
            level1.append(F.sum(F.when(is_k, F.col(value))).alias(f"__v_{p}"))
    by_ts = df.where(F.col(kind).isin(list(kinds))).groupBy(key, ts).agg(*level1)

    level2 = []
    for k, p in kinds.items():
        n = F.col(f"__n_{p}")
        at = F.when(n > 0, F.col(ts))
        level2 += [F.min(at).alias(f"{p}_at"), F.sum(n).alias(f"{p}_count")]
        if k in valued:
            v = F.col(f"__v_{p}")
            level2 += [
                F.sum(v).alias(f"{p}_total"),
                F.min_by(v, at).alias(f"__vfirst_{p}"),
                F.min_by(n, at).alias(f"__nfirst_{p}"),
            ]
    out = by_ts.groupBy(key).agg(*level2)

    for k, p in kinds.items():
        if k not in valued:
            continue
        n_all, n_first, v_first = F.col(f"{p}_count"), F.col(f"__nfirst_{p}"), F.col(f"__vfirst_{p}")
        initial = (
            F.when(n_all == 0, F.lit(None).cast("double"))
            .when(F.col(f"{p}_at").isNull(), F.lit(0.0))
            .when(n_all > n_first, F.coalesce(v_first, F.lit(0.0)))
            .otherwise(v_first)
        )
        out = out.withColumn(f"{p}_initial", initial).drop(f"__vfirst_{p}", f"__nfirst_{p}")
    return out


def distinct_sorted(df: DataFrame, c: str) -> DataFrame:
    """Distinct non-null values, ascending."""
    return df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c)


def null_counts_long(df: DataFrame, table: str) -> DataFrame:
    """Null count of every column in one pass, in long form
    ``(table_name, column_name, null_count)``."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.selectExpr(
        f"'{table}' AS table_name", f"stack({len(df.columns)}, {stack}) AS (column_name, null_count)"
    )


def one_row_counts(spark, **frames: DataFrame) -> DataFrame:
    """One row with the row count of each frame, as scalar subqueries
    (``select (select count(*) from a) as a, ...``): no join of frames."""
    return spark.range(1).select(*[df.select(F.count(F.lit(1))).scalar().alias(n) for n, df in frames.items()])


def pivot_rank(ranked: DataFrame, key: str, rank_col: str, n: int, cols: list[str]) -> DataFrame:
    """``max(case when rank = i then c end)`` for i in 1..n: the first ``n``
    ranked rows of each key side by side (``{c}_{i}``), in one
    partial-aggregating ``groupBy(key)``."""
    r = F.col(rank_col)
    return ranked.groupBy(key).agg(
        *[F.max(F.when(r == i, F.col(c))).alias(f"{c}_{i}") for i in range(1, n + 1) for c in cols]
    )
