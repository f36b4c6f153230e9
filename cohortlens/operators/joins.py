"""Join helpers: orphans (anti-join), their counts, key overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent row. A null child key is an orphan,
    as with ``left join .. where parent.key is null``."""
    parent_key = parent_key or key
    keys = parent.select(F.col(parent_key).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    matched = child.join(keys, child[key] == keys["__pk"], "left_anti")
    return matched


def orphan_counts(child: DataFrame, parent: DataFrame, key: str, counted: str) -> DataFrame:
    """(key, row_count, user_count) of the keys without a parent row: rows and
    distinct ``counted`` values. The child is aggregated by (key, counted) and
    by key before the anti-join, so a code that holds a third of all rows is
    one row there."""
    pairs = child.groupBy(*dict.fromkeys([key, counted])).agg(F.count(F.lit(1)).alias("n"))
    per_key = pairs.groupBy(F.col(key).alias("__key")).agg(F.sum("n").alias("row_count"), F.count(counted).alias("user_count"))
    return orphans(per_key, parent, "__key", key).withColumnRenamed("__key", key)


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both frames."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "inner")
