"""Line dedup: lines found in many documents stay in one of them only.

Lines become 128-bit key hashes with their document and position. Hashes are
range-partitioned and sorted by document and position; a window streams each
key's run and marks the lines that go. What is returned is a keep bitmap per
document, not text. A bitmap is compressed: it lists only the 64-bit words that
lose a line, as (word, kept), bit ``i % 64`` of word ``i / 64`` set if line
``i`` stays. A document that keeps all its lines has no bitmap.

A key with more than ``HOT_LINES`` lines never enters the range sort: lines are
counted per key by partial aggregation, the documents of the hot keys are
counted by another one, and their lines are marked where they lie. The table of
hot keys has at most a row per ``HOT_LINES`` lines and no broadcast hint:
beyond Spark's size limit for broadcasts the join shuffles, and adaptive
execution splits the hot key's lines. A key's route never changes the result.

Nulls and odd rows: a null or empty text is one empty line. A row without
document id keeps all its lines and counts for no key. Rows that repeat a
document id are one document; a bitmap belongs to an id and a text, so two
texts under one id don't mix. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.common import WHITE, ascii_lower, packed, written

#: Most lines of a key that meet in one window partition.
HOT_LINES = 10_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """(h1, h2, doc, version, pos) of every line whose key has ``min_chars``
    code points. Key: the line without white space at its ends, A-Z in lower
    case."""
    text = F.col(text_col)
    lines = (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"), F.posexplode(_lines(text)).alias("pos", "line"))
        .select("doc", "version", "pos", F.btrim("line", F.lit(WHITE)).alias("line"))
        .where(F.length("line") >= min_chars)
        .select("doc", "version", "pos", ascii_lower(F.col("line")).alias("key"))
    )
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "version", "pos")


def _hot_keys(keys: DataFrame) -> DataFrame:
    """(h1, h2) of the keys with more than ``HOT_LINES`` lines."""
    return keys.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") > HOT_LINES).select("h1", "h2")


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """(doc, version, bitmap) of every document that loses a line: a key found
    in ``min_docs`` documents or more stays in the largest id holding it.
    ``version`` is the text's xxhash64."""
    keys = written(line_keys(docs, id_col, text_col, min_chars), "line-keys")
    hot = written(_hot_keys(keys), "hot-keys")

    # the usual keys: one range shuffle, then a streamed run per key
    run = Window.partitionBy("h1", "h2").orderBy(F.desc("doc"), "pos")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    usual = (
        keys.join(hot, ["h1", "h2"], "left_anti")
        .repartitionByRange("h1", "h2")
        .sortWithinPartitions("h1", "h2", F.desc("doc"), "pos")
        .withColumn("nth_doc", F.dense_rank().over(Window.partitionBy("h1", "h2").orderBy(F.desc("doc"))))
        .withColumn("n_docs", F.last("nth_doc").over(whole))
        .where((F.col("nth_doc") > 1) & (F.col("n_docs") >= min_docs))
        .select("doc", "version", "pos")
    )

    # the hot ones: documents counted before any shuffle of lines
    hot_lines = keys.join(hot, ["h1", "h2"], "left_semi")
    stats = (
        hot_lines.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("doc").alias("last_doc"))
        .where(F.col("n_docs") >= min_docs)
    )
    hot_drops = hot_lines.join(written(stats, "hot-documents"), ["h1", "h2"]).where("doc < last_doc").select("doc", "version", "pos")

    words = (
        usual.union(hot_drops)
        .select("doc", "version", F.floor(F.col("pos") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, pos % 64)").alias("bit"))
        .repartition("doc")
        .groupBy("doc", "version", "word").agg(F.expr("~bit_or(bit)").alias("kept"))
    )
    return words.groupBy("doc", "version").agg(F.array_sort(F.collect_list(F.struct("word", "kept"))).alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: ``row`` (the input row as a struct), ``doc``, ``n_lines``,
    ``n_dropped`` and ``kept_text``."""
    rows = packed(docs, doc=F.col(id_col), version=F.xxhash64(F.col(text_col)), text=F.coalesce(F.col(text_col), F.lit("")))
    joined = rows.join(bitmaps, ["doc", "version"], "left")
    # unfolded once per document (``w``), up to its last word that loses a line
    words = (
        "flatten(transform(bitmap, (x, i) -> "
        "concat(array_repeat(-1L, x.word - if(i = 0, -1, bitmap[i - 1].word) - 1), array(x.kept))))"
    )
    stays = "(shiftright(coalesce(get(w, cast(floor(i / 64) as int)), -1L), i % 64) & 1L) = 1L"
    kept = F.expr(f"transform(array({words}), w -> filter(split(text, '\\n'), (l, i) -> {stays}))[0]")
    out = joined.select(
        "row", "doc", "text", "bitmap",
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("bitmap").isNotNull(), kept).alias("kept"),
    )
    return out.select(
        "row", "doc", "n_lines",
        F.when(F.col("bitmap").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
    )
