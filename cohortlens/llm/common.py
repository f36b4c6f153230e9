"""Small helpers of the operators: tables, written intermediates, row packing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.sinks import checkpoint_base

#: ASCII white space: \x20 and \x09-\x0D.
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder."""
    return f"{checkpoint_base(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back.
    A lost executor then re-reads files instead of running the plan above
    again, and a join of the result gets its own exchange, so that adaptive
    execution can split a skewed side."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The whole input row as one struct ``row`` beside the named columns:
    input columns can't clash with an operator's own names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The input columns of a packed frame, some of them replaced."""
    return df.select(*[(replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in columns])


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
