"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
