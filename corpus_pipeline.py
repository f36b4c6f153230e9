"""A corpus from raw documents to sampled token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; its result is written as Parquet and read again as the next
one's input. All but the last return the columns of ``documents``.

1. quality rules: documents that fail the base rules or the compression bands go;
2. line dedup: lines found in three documents or more stay in one of them;
3. MinHash near-dedup: of each group of near copies the smallest id stays;
4. mixing: documents by domain, language and source budgets, in at most two
   epochs (a document taken twice is two rows);
5. SentencePiece: sampled ids of each text.

Nulls and odd rows are treated as each operator's docstring says; an empty
``documents`` table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import line_dedup, mixing, near_dup, pieces, quality
from cohortlens.llm.common import unpacked
from cohortlens.llm.queries import MIX_WEIGHTS, domain_of
from cohortlens.sources.sinks import checkpoint_base


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the dropped lines; ``n_chars`` follows. A document that
    loses nothing stays as it is; one that loses all its lines goes."""
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    changed = F.col("n_dropped") > 0
    out = out.where(F.expr("n_dropped = 0 or n_dropped < n_lines"))
    return unpacked(
        out,
        docs.columns,
        text=F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
        n_chars=F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")),
    )


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicate(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return unpacked(mixing.mix(docs, MIX_WEIGHTS, domain_of()).select("row"), docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pieces.encode(docs, carry=["doc_id", "lang", "source"])
    return out.select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("mixture", mixture),
    ("sentencepiece", sentencepiece_ids),
]

#: Compression bands, near copies and sampled ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    base = f"{checkpoint_base(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        kept.write.option("compression", "zstd").parquet(f"{base}/{name}")
        docs = spark.read.schema(kept.schema).parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
