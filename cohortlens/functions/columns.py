"""Column expressions shared by the models, checks and reports.

Every function here returns a ``pyspark.sql.Column`` built from Spark
built-ins, so it stays inside whole-stage codegen and needs no Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnLike) -> Column:
    return as_col(c).cast("string")


def norm_text(c: ColumnLike) -> Column:
    """Trim only (names, ids)."""
    return F.trim(as_text(c))


def norm_code(c: ColumnLike, blank_null: bool = False) -> Column:
    """Key normaliser ``upper(trim(x))``; optionally blank -> null."""
    out = F.upper(F.trim(as_text(c)))
    return F.nullif(out, F.lit("")) if blank_null else out


def norm_category(c: ColumnLike, default: str = "unknown") -> Column:
    """``coalesce(nullif(lower(trim(x)), ''), default)``."""
    return F.coalesce(F.nullif(F.lower(F.trim(as_text(c))), F.lit("")), F.lit(default))


def map_sentinels(
    c: ColumnLike,
    sentinels: Iterable[str],
    default: str = "unknown",
    case: str = "lower",
) -> Column:
    """Null or a sentinel spelling -> ``default``; otherwise the cased, trimmed
    value. An empty string is *not* a sentinel unless listed."""
    caser = F.lower if case == "lower" else F.upper
    cleaned = caser(F.trim(as_text(c)))
    return (
        F.when(as_col(c).isNull(), F.lit(default))
        .when(cleaned.isin(list(sentinels)), F.lit(default))
        .otherwise(cleaned)
    )


def keep_when(c: ColumnLike, cond: Column) -> Column:
    """Value when ``cond`` holds, null otherwise."""
    return F.when(cond, as_col(c))


def flag(cond: Column) -> Column:
    """Integer 0/1 flag; a null condition counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def coalesce0(c: ColumnLike, zero: float | int = 0) -> Column:
    return F.coalesce(as_col(c), F.lit(zero))


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``cast(num as double) / nullif(coalesce(den, 0), 0)``: null, never an
    error or infinity, when the divisor is zero or missing."""
    return as_col(num).cast("double") / F.nullif(F.coalesce(as_col(den), F.lit(0)), F.lit(0))


def campaign_label(campaign_id: ColumnLike, campaign_name: ColumnLike) -> Column:
    """``id || ' - ' || coalesce(name, 'Unmapped campaign')``; a null id gives null."""
    return F.concat(
        as_col(campaign_id), F.lit(" - "), F.coalesce(as_col(campaign_name), F.lit("Unmapped campaign"))
    )


def weekday_name(d: ColumnLike) -> Column:
    """English weekday name in lower case (``monday`` .. ``sunday``)."""
    return F.lower(F.date_format(as_col(d), "EEEE"))


def month_num(d: ColumnLike) -> Column:
    return F.month(as_col(d)).cast("int")


def plain_double(c: ColumnLike) -> Column:
    """A double as text in the surrogate key's form: shortest digits, positional
    from 1e-4 up to 1e16, else ``1.5e+20``; Spark's own cast turns to exponents
    at 1e7 and 1e-3."""
    x = as_col(c)
    text = x.cast("string")
    exact = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    positional = F.when(F.endswith(exact, F.lit(".")), F.concat(exact, F.lit("0"))).otherwise(exact)
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    power_text = F.concat(F.when(power < 0, F.lit("-")).otherwise(F.lit("+")), F.format_string("%02d", F.abs(power)))
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(F.abs(x) == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~F.contains(text, F.lit("E")), text)
        .when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), positional)
        .otherwise(F.concat(mantissa, F.lit("e"), power_text))
    )


# Fixed value: the text the surrogate-key convention puts in place of a null
# field, and the separator between fields.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def surrogate_key(*cols: ColumnLike) -> Column:
    """Deterministic md5 key over the string forms of ``cols``; nulls are
    replaced by a fixed marker so that they still contribute."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SURROGATE_SEP))
        parts.append(F.coalesce(as_text(c), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


def sum_flag(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``; null over an empty input,
    as in SQL."""
    return F.sum(flag(cond))


def percent(c: ColumnLike) -> Column:
    return as_col(c) * F.lit(100)
