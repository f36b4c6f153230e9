"""Readers for raw sources and materialised tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sets import union_all
from .schemas import RAW_COLUMNS, RAW_TYPED_SCHEMAS
from .tables import Store


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required minus present column names (driver-small: schema only)."""
    present = set(df.columns)
    return sorted(c for c in required if c not in present)


def require_columns(df: DataFrame, required, what: str = "table") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"The {what} is missing these columns: {', '.join(missing)}")
    return df


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The first row of one CSV file, by Spark's own reader: it reads the head
    of the file. An empty file has none."""
    rows = spark.read.csv(path).head(1)
    return tuple(v or "" for v in rows[0]) if rows else ()


def _columns_by_name(header: tuple[str, ...], required, what: str) -> dict[str, int]:
    """Where each required column is in a file's header; names count
    regardless of case and of blanks around them."""
    names = [h.strip("\ufeff ").lower() for h in header]
    twice = sorted(c for c in required if names.count(c.lower()) > 1)
    if twice:
        raise ValueError(f"The {what} has these columns more than once: {', '.join(twice)}")
    missing = sorted(c for c in required if c.lower() not in names)
    if missing:
        raise ValueError(f"The {what} is missing these columns: {', '.join(missing)}")
    return {c: names.index(c.lower()) for c in required}


def read_csv_by_name(spark: SparkSession, paths: str | list[str], required, what: str = "file") -> DataFrame:
    """CSV files as strings, columns taken by the names in each file's header:
    files may order them differently and hold others. A missing or repeated
    column raises before any row is read.

    Files with the same header are one scan; there are as many scans as
    different headers. Each scan checks the files' headers against the schema
    it was given (``enforceSchema=false``), so a file that is replaced meanwhile
    fails the job instead of filling the wrong columns. A file of no bytes has
    no rows."""
    files = [unquote(f) for f in spark.read.text(paths).inputFiles()]  # the listing; nothing is read
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda f: csv_header(spark, f), files))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for header, path in zip(headers, files, strict=True):
        if header:
            by_header.setdefault(header, []).append(path)
    if not by_header:
        raise ValueError(f"The {what} is missing these columns: {', '.join(sorted(required))}")
    parts = []
    for header, group in by_header.items():
        at = _columns_by_name(header, required, f"{what} ({group[0]})")
        # names that a schema can't hold (empty or repeated ones of other columns) can't be checked again
        nameable = all(header) and len({h.lower() for h in header}) == len(header)
        names = list(header) if nameable else [f"c{i}" for i in range(len(header))]
        schema = T.StructType([T.StructField(h, T.StringType()) for h in names])
        rows = spark.read.option("header", True).option("enforceSchema", not nameable).schema(schema).csv(group)
        parts.append(rows.toDF(*[f"c{i}" for i in range(len(header))]).select(*[F.col(f"c{at[c]}").alias(c) for c in required]))
    return union_all(*parts)


def read_raw(spark: SparkSession, base: str, name: str, fmt: str = "csv") -> DataFrame:
    """Scan one raw source by name: ``{base}/{name}.csv`` (a file or a folder
    of files with headers; every column a string, no inference pass) or
    ``{base}/{name}.parquet``. Columns go by name either way: the declared ones
    must be there, others are left out of a CSV."""
    path = f"{base.rstrip('/')}/{name}.{fmt}"
    if fmt == "csv":
        return read_csv_by_name(spark, path, RAW_COLUMNS[name], f"raw source {name}")
    return require_columns(spark.read.format(fmt).load(path), RAW_COLUMNS[name], f"raw source {name}")


def read_raw_sources(spark: SparkSession, base: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {name: read_raw(spark, base, name, fmt) for name in RAW_COLUMNS}


def load(spark: SparkSession, name: str, base: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a materialised table: a catalog table when ``base`` is None, else
    the published version under ``base``, or plain files at ``{base}/{name}``
    where nothing was published."""
    if base is None:
        return spark.table(name)
    store = Store(spark, base)
    if name in store.published():
        return store.read(name)
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}")


def typed_raw(df: DataFrame, name: str) -> DataFrame:
    """A raw source with its declared column types (dates, timestamps,
    doubles), as a typing CSV reader would give them; a malformed value
    raises (ANSI cast). Staging does its own casts; profiles read this."""
    fields = {f.name: f.dataType for f in RAW_TYPED_SCHEMAS[name].fields}
    return df.select(*[F.col(c).cast(fields[c]).alias(c) if c in fields else F.col(c) for c in df.columns])
