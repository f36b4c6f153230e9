"""Window helpers. No window here spans rows of a whole table: they are
partitioned by a bounded group, or run over a row per partition of a sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_events(df: DataFrame, key: str, order: list[Column], name: str = "rn", size: str | None = None) -> DataFrame:
    """``row_number() over (partition by key order by ..)`` and, as ``size``,
    ``count(*) over (partition by key)``, without holding a key's rows in one
    task.

    The rows are sorted globally by (key, order..., input position): the
    range partitioning behind ``orderBy`` samples the whole composite key, so
    a key with a third of all rows spans many partitions. The sorted rows are
    written once (reliable checkpoint) so that every later pass sees the same
    order. A row's global position is its partition's offset plus its index in
    the partition; its number is that position minus the first position of its
    key. First positions and sizes come from one partial aggregation per key,
    joined back with AQE splitting a hot key's side.
    Ties in ``order`` are numbered in an arbitrary but fixed order, as SQL
    leaves them."""
    from ..sources.sinks import reliable_checkpoint

    cols = df.columns
    tagged = df.withColumn("__in", F.monotonically_increasing_id())
    ordered = tagged.orderBy(F.col(key).asc_nulls_first(), *order, F.col("__in"))
    pos = reliable_checkpoint(ordered.withColumn("__mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("__mid"), 33)
    pos = pos.select(*cols, pid.alias("__pid"), (F.col("__mid") - F.shiftleft(pid, 33)).alias("__idx"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    # one row per partition of the sort: at most spark.sql.shuffle.partitions rows
    placed = pos.join(F.broadcast(offsets), "__pid").select(*cols, (F.col("__offset") + F.col("__idx")).alias("__g"))
    per_key = placed.groupBy(F.col(key).alias("__key")).agg(F.min("__g").alias("__first"), F.count(F.lit(1)).alias("__size"))
    joined = placed.join(per_key, F.col(key).eqNullSafe(F.col("__key")))
    sizes = [F.col("__size").alias(size)] if size else []
    return joined.select(*cols, (F.col("__g") - F.col("__first") + 1).cast("int").alias(name), *sizes)


def group_size(df: DataFrame, key: str, name: str = "group_size") -> DataFrame:
    """``count(*) over (partition by key)``, as a partial-aggregating count
    joined back on ``key`` (rows with a null key get the null group's size,
    as the window would). A hot key costs one partial row per map task,
    and the join back is split by AQE's skew handling."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, df[key].eqNullSafe(sizes[key])).drop(sizes[key])


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rn") -> DataFrame:
    """First ``k`` rows per group in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
