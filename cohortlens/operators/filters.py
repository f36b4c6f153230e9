"""Row filters shared by models and reports: plain comparisons, which Catalyst
pushes into the parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_event(df: DataFrame, event_type: str, col: str = "event_type") -> DataFrame:
    return df.where(F.col(col) == F.lit(event_type))


def by_sign(coefficients: DataFrame, positive: bool = True) -> DataFrame:
    c = F.col("coefficient")
    return coefficients.where(c > 0 if positive else c < 0)
