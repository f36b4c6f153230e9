"""Conflict resolution for keys with several source rows.

A key with duplicated rows resolves each attribute to its single distinct
value, or to a fallback when the rows disagree. "Exactly one distinct
non-null value" is tested as ``min(x) == max(x)``: that needs no
``count(distinct)`` (which Spark rewrites with an Expand that multiplies the
rows by the number of distinct aggregates), is idempotent over exact
duplicate rows (so no ``distinct`` pass is needed first), and aggregates
partially on the map side, so a key holding a third of all rows still
arrives at the reducer as one partial row per map task.

String ``min``/``max`` aggregate sort-based, in one exchange and without any
look at the data beforehand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_col


@dataclass(frozen=True)
class Resolution:
    """How to resolve one attribute.

    ignore: a value that never counts as information (e.g. ``unknown``);
    on_conflict: the result when there is not exactly one informative value
    (``None`` gives null).
    """

    column: str
    ignore: str | None = None
    on_conflict: str | None = "unknown"
    conflict_flag: str | None = None


def _informative(c: Column, ignore: str | None) -> Column:
    return F.when(c != F.lit(ignore), c) if ignore is not None else c


def resolve_value(c, ignore: str | None = None, on_conflict: str | None = "unknown") -> Column:
    x = _informative(as_col(c), ignore)
    lo, hi = F.min(x), F.max(x)
    fallback = F.lit(on_conflict) if on_conflict is not None else F.lit(None).cast("string")
    return F.when(lo == hi, lo).otherwise(fallback)


def has_conflict(c, ignore: str | None = None) -> Column:
    """True when more than one distinct informative value exists."""
    x = _informative(as_col(c), ignore)
    return F.coalesce(F.min(x) != F.max(x), F.lit(False))


def resolve(df: DataFrame, key: str, rules: list[Resolution]) -> DataFrame:
    """One row per ``key``: resolved attributes, then the conflict flags."""
    values = [resolve_value(r.column, r.ignore, r.on_conflict).alias(r.column) for r in rules]
    flags = [has_conflict(r.column, r.ignore).alias(r.conflict_flag) for r in rules if r.conflict_flag]
    return df.groupBy(key).agg(*values, *flags)
