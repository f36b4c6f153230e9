"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import chat, collocation, html_text, line_dedup, lm, mixing, near_dup, packing, pieces, quality, repair, secrets, topk
from cohortlens.llm.common import scratch, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled ids of every document, and whether they decode to its text."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(text, 256).alias("sha"))
    back = pieces.decode(pieces.encode(docs, carry=["doc_id", "sha"]))
    return back.select("row.doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (F.sha2("text", 256) == F.col("row.sha")).alias("lossless"))


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


#: Four domains, the languages weighted within each; sources weigh alike.
MIX_WEIGHTS = {"domain": {"*": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2, "*": 1}, "source": {"*": 1}}


def domain_of(source: str = "source"):
    """The domain of a source: its number's last two bits."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.concat(F.lit("domain"), F.coalesce(number.try_cast("int"), F.lit(0)) % 4)


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix(docs, MIX_WEIGHTS, domain_of())
    return out.select(F.col("doc").alias("doc_id"), "domain", "lang", "source", "n_tokens", F.col("epoch").cast("long").alias("epoch"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a history of two versions, one with the even ids and
    one with all: the second run scans only what the first one's log lacks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    log = scratch(spark, "secret-ledger")
    secrets.scan_into(log, docs.where("doc_id % 2 = 0"))
    paths, found = secrets.scan_into(log, docs)
    out = secrets.by_path(paths, found)
    joined = "array_join(transform({}, s -> concat_ws(':', s.rule, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.rule in ({}))".format(", ".join(f"'{k}'" for k in secrets.BASE))
    counts = [F.expr(f"cast(coalesce(size(filter(spans, s -> s.rule = '{k}')), 0) as long)").alias(f"n_{k}") for k in secrets.BASE]
    return out.withColumn("spans", F.coalesce("spans", F.expr("filter(array(struct(0 as start, 0 as place, 0 as `end`, '' as rule)), s -> false)"))).select(
        "row.doc_id",
        *counts,
        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    turns = turns.unionByName(
        spark.range(2).select(
            F.lit(-7).cast("long").alias("conv_id"),
            F.col("id").alias("turn"),
            F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
            F.lit(planted).alias("text"),
        )
    )
    out = chat.format_chats(turns).select(
        "conv", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return out.select(F.col("doc").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.main_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return out.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with faults planted by a hash of
    conversation and turn; nulls in role, text or the hashed key are one space."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    kind, text = F.crc32(key) % 20, F.coalesce("text", F.lit(" "))
    return (
        turns.withColumn("kind", kind)
        .where(F.col("kind") != 0)
        .withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        )
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = repair.marked_turns(damaged(turns))
    told = repair.digests(repair.repair(repair.blocks(marked))).join(repair.turn_gaps(marked), "conv")
    original = turns.select(F.struct(F.col("conv_id").alias("id")).alias("conv")).distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return original.join(told, "conv", "left").select(
        F.col("conv.id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    out = lm.score(table(spark, sf_dir, "documents"), held_out, ["doc_id"])
    return out.select(
        "row.doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_sentencepiece, op2_minhash_near_dup, op3_mixture, op4_secrets, op5_quality, op6_packed_tokens, op7_chat, op8_line_dedup,
            op9_exact_top_k, op10_main_text, op11_conversation_repair, op12_collocations, op13_lm_score,
        )
    }
