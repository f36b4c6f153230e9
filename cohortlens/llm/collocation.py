"""Phrase collocations by stripes: each prefix keys a counter of its next words.

Three levels, one structure: the stripe of the empty prefix counts words, the
stripes of single words count pairs, the stripes of pairs count triples. A task
gathers its texts' stripes in memory-bounded rounds and emits each as one row
(language, prefix, next words, counts), so a prefix travels once for all its
extensions. Stripes of one prefix meet by hash and are merged elementwise. What
comes out, (language, prefix, next, f), holds the extensions (its rows), the
prefix totals (a prefix's own row one level up, with n as the total of the empty
prefix) and the subsumption maxima (the greatest entry of a pair's stripe, and
of the stripes that the pair ends).

A hot prefix would put all its stripes into one task. Each level knows how often
the next level's prefixes occur: those with more than 1 / ``SHARES`` of all
words (so under 2 * ``SHARES`` of them, whatever the input) are cut into as many
shards, by a hash of the next word, as they have shares. The pairs found often
enough are marked in a bitmap of ``BITS`` bits, and the third level leaves out
triples with an unmarked pair: such a triple is too rare itself. A mark too many
costs work only, so results don't depend on its size.

Words, pieces and candidates are as ``collocations`` says. All arithmetic on
counts is decimal: exact to counts of 10^16.

Nulls and odd rows: a null or empty text has no words; a null language is
``und``. Repeated rows count each time. A text is cut at piece ends, and pieces
over ``CUT`` bytes between words (with the words before the cut repeated as
context), so memory doesn't grow with a text but for its single words. Columns
beside the two named ones are ignored, whatever their names. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written
from cohortlens.operators.windows import top_k_per_group

#: Parts of all words that a prefix may hold before it is cut into shards.
SHARES = 4096
#: Bits of the bitmap of frequent pairs (2 MiB).
BITS = 1 << 24
#: Bytes of one language's text that a task turns into stripes at a time, and
#: that it holds of all languages together. A round takes some 18 times its text.
ROUND, HELD = 8 << 20, 16 << 20
CUT = 4 << 20
#: Rows of stripes that a record batch holds.
ROWS = 1 << 12
_BREAK = b"\xff"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" ")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _parts(text: bytes, context: int, cut: int) -> Iterator[bytes]:
    """A text in parts of about ``cut`` bytes; none cuts a run of ``context`` + 1 words."""
    text = text.translate(_TABLE)
    if len(text) <= cut:
        yield text
        return
    for piece in re.finditer(rb"[^\xff]+", text):
        if piece.end() - piece.start() <= cut:
            yield piece.group()
            continue
        words, before = (w.group() for w in re.finditer(rb"[^ ]+", piece.group())), []
        while part := list(islice(words, cut // 8)):
            yield b" ".join(chain(before, part))
            before = (before + part)[-context:] if context else []


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The number of each word and of the piece it is in, and the words by
    number. Words are told from gaps on the bytes as they are: an object for
    each word would take many times the text's memory."""
    letters = np.frombuffer(text, np.uint8)
    broken = letters == _BREAK[0]
    gap = broken | (letters == 0x20)
    edges = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts = edges[::2]
    pieces = np.searchsorted(np.flatnonzero(broken), starts).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(edges[1::2] - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters[~gap])])
    del letters, broken, gap, edges, starts
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), pieces, coded.dictionary.cast(pa.binary())


def _hashes(words: pa.Array) -> np.ndarray:
    each = chain.from_iterable(words.slice(a, ROWS).to_pylist() for a in range(0, len(words), ROWS))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, each), np.uint64, len(words))


def _pair_bits(first: np.ndarray, second: np.ndarray, lang: str, n_bits: int) -> np.ndarray:
    """Places in a bitmap of ``n_bits`` of pairs of word hashes."""
    x = (first * _GOLDEN + second) ^ np.uint64(xxhash.xxh3_64_intdigest(lang))
    x = (x ^ (x >> np.uint64(31))) * _GOLDEN
    return ((x >> np.uint64(40)) % np.uint64(n_bits)).astype(np.int64)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys.sort()
    at = _runs(keys)
    return keys[at], np.diff(np.append(at, len(keys)))


def stripes_of(parts: list[bytes], lang: str, level: int, shares: int, hot: dict[bytes, int], bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The stripes of some texts' prefixes of ``level`` words; ``parts`` is
    emptied."""
    text = _BREAK.join(parts)
    parts.clear()
    seq, pieces, words = _words(text)
    del text
    n = len(words)
    if level == 0:
        counts = np.bincount(seq, minlength=n)
        group, nexts = np.zeros(n, np.int64), np.arange(n)
        prefixes, shards = pa.array([b""], pa.binary()), np.array([shares])
    else:
        at = np.flatnonzero(pieces[:-level] == pieces[level:])
        if level == 2 and bits is not None:
            hashed = _hashes(words)[seq]
            place = _pair_bits(hashed[:-1], hashed[1:], lang, 64 * len(bits))
            marked = (bits[place >> 6] >> (place & 63) & 1).astype(bool)
            del hashed, place
            at = at[marked[at] & marked[at + 1]]
        keys = seq[at].astype(np.int64)
        prefixes = words
        if level == 2:  # pairs by number, so that a key fits 64 bits
            keys *= n
            keys += seq[at + 1]
            known, keys = np.unique(keys, return_inverse=True)
            prefixes = pc.binary_join_element_wise(words.take(pa.array(known // n)), words.take(pa.array(known % n)), b" ")
            del known
        keys *= n
        keys += seq[at + level]
        del at
        keys, counts = _counted(keys)
        group, nexts = keys // n, keys % n
        del keys
        shards = None
        if hot:
            found = pc.index_in(prefixes, value_set=pa.array(list(hot), pa.binary())).fill_null(len(hot))
            shards = np.append(list(hot.values()), 1)[found.to_numpy()]
    del seq, pieces
    if not len(nexts):
        return
    if shards is None:
        shard = np.zeros(len(group), np.int32)
        begins = _runs(group)
    else:
        shard = (_hashes(words)[nexts] % shards[group].astype(np.uint64)).astype(np.int32)
        order = np.argsort(group * (2 * shares) + shard, kind="stable")
        group, shard, nexts, counts = group[order], shard[order], nexts[order], counts[order]
        del order
        begins = _runs(group * (2 * shares) + shard)
    for a in range(0, len(begins), ROWS):
        rows = begins[a : a + ROWS]
        end = begins[a + ROWS] if a + ROWS < len(begins) else len(nexts)
        offsets = pa.array(np.append(rows, end) - rows[0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(rows)),
                prefixes.take(pa.array(group[rows])),
                pa.array(shard[rows], pa.int32()),
                pa.ListArray.from_arrays(offsets, words.take(pa.array(nexts[rows[0] : end]))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[rows[0] : end], pa.int64())),
            ],
            names=["lang", "prefix", "shard", "nexts", "counts"],
        )


def stripes(texts: DataFrame, level: int, hot: dict[tuple[str, str], int] | None = None, bits: np.ndarray | None = None) -> DataFrame:
    """(lang, prefix, shard, nexts, counts) of all (lang, text); partial sums."""
    by_lang: dict[str, dict[bytes, int]] = {}
    for (lang, prefix), shards in (hot or {}).items():
        by_lang.setdefault(lang, {})[prefix.encode()] = shards
    shares, round_size, held_size, cut = SHARES, ROUND, HELD, CUT
    shared = texts.sparkSession.sparkContext.broadcast((by_lang, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_of, bits = shared.value
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def emit(lang: str) -> Iterator[pa.RecordBatch]:
            size.pop(lang)
            yield from stripes_of(held.pop(lang), lang, level, shares, hot_of.get(lang, {}), bits)

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1).cast(pa.binary()), strict=True):
                for part in _parts(text.as_py(), level, cut):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part) + 1
                    if size[lang] >= round_size:
                        yield from emit(lang)
                    elif sum(size.values()) >= held_size:
                        yield from emit(max(size, key=size.get))
        for lang in list(held):
            yield from emit(lang)

    return texts.mapInArrow(run, "lang string, prefix binary, shard int, nexts array<binary>, counts array<long>")


def merged(striped: DataFrame) -> DataFrame:
    """(lang, prefix, next, f): stripes of one prefix and shard meet in a task
    and are added up elementwise there, without another exchange."""
    met = striped.repartition("lang", "prefix", "shard")
    entries = met.select("lang", "prefix", "shard", F.inline(F.arrays_zip("nexts", "counts")))
    added = entries.groupBy("lang", "prefix", "shard", "nexts").agg(F.sum("counts").alias("f"))
    return added.select("lang", F.col("prefix").cast("string").alias("prefix"), F.col("nexts").cast("string").alias("next"), "f")


def _phrase(prefix: str = "prefix"):
    return F.when(F.col(prefix) == "", F.col("next")).otherwise(F.concat(prefix, F.lit(" "), "next"))


def hot_prefixes(cells: DataFrame, total: int) -> dict[tuple[str, str], int]:
    """Phrases with more than a share of all ``total`` words, and the shares
    each has: under 2 * ``SHARES`` phrases, as their counts sum to ``total`` at
    most."""
    share = max(1, total // SHARES)
    rows = cells.where(F.col("f") > share).select("lang", _phrase().alias("phrase"), "f").collect()
    return {(r["lang"], r["phrase"]): min(2 * SHARES, -(-r["f"] // share)) for r in rows}


def frequent_bits(pairs: DataFrame) -> np.ndarray:
    """The bitmap of ``pairs`` (lang, prefix, next), 64 places a number:
    ``BITS`` bits, whatever the number of pairs."""
    n_bits = BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            first, second = (_hashes(batch.column(k).cast(pa.binary())) for k in (1, 2))
            for lang in dict.fromkeys(langs):
                mine = langs == lang
                place = np.unique(_pair_bits(first[mine], second[mine], lang, n_bits))
                yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array(np.left_shift(np.int64(1), place & 63))], names=["at", "bit"])

    words = pairs.select("lang", "prefix", "next").mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("word"))
    out = np.zeros(n_bits // 64, np.int64)
    for row in words.collect():
        out[row["at"]] = row["word"]
    return out


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Texts with A-Z in lower case fall into pieces at ``.,;:!?`` and line
    controls, pieces into words at spaces and tabs. Candidates are phrases of
    two or three words of one piece found ``a`` times, ``least`` or more. A cut
    into a first part found l times and a rest found r times scores
    floor(10^6 a^2 / (l r)); the cut with the lowest score counts, the first of
    equals. A candidate inside a longer one that is found at least ``percent``
    per cent as often goes."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = texts.where(F.col("text") != "")
    words = written(merged(stripes(texts, 0)), "stripes-0")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = int(words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0])
    often = F.col("f") >= least
    pairs = written(merged(stripes(texts, 1, hot_prefixes(words.where(often), total))).where(often), "stripes-1")
    triples = written(merged(stripes(texts, 2, hot_prefixes(pairs, total), frequent_bits(pairs))).where(often), "stripes-2")

    def found(cells: DataFrame, name: str) -> DataFrame:
        """Phrases of one level with their count, to be joined on lang and ``name``."""
        return cells.select("lang", _phrase().alias(name), F.col("f").alias(f"f_{name}"))

    words = words.where(often)
    two = pairs.select("lang", _phrase().alias("phrase"), F.col("f").alias("a"), F.col("prefix").alias("first"), F.col("next").alias("rest"))
    two = two.join(found(words, "first"), ["lang", "first"]).join(found(words, "rest"), ["lang", "rest"])
    two = two.select("lang", "phrase", "a", F.array(F.struct(F.col("f_first").alias("l"), F.col("f_rest").alias("r"))).alias("cuts"))
    pair = F.split("prefix", " ")
    three = triples.select(
        "lang", _phrase().alias("phrase"), F.col("f").alias("a"), F.col("prefix").alias("front"), F.col("next").alias("last"),
        pair[0].alias("first"), F.concat(pair[1], F.lit(" "), "next").alias("back"),
    )
    inside = three.select("lang", F.explode(F.array("front", "back")).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    for cells, name in ((words, "first"), (words, "last"), (pairs, "front"), (pairs, "back")):
        three = three.join(found(cells, name), ["lang", name])
    cuts = [F.struct(F.col(f"f_{a}").alias("l"), F.col(f"f_{b}").alias("r")) for a, b in (("first", "back"), ("front", "last"))]
    three = three.select("lang", "phrase", "a", F.array(*cuts).alias("cuts"))
    two = two.join(inside, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {percent} * a").drop("longer")

    scored = F.expr(
        """transform(cuts, (c, k) -> struct(
            (cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * 1000000) div (cast(c.l as decimal(19,0)) * cast(c.r as decimal(19,0))) as score, k, c.l as l, c.r as r))"""
    )
    kept = two.unionByName(three).withColumn("cut", F.array_min(scored)).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    kept = top_k_per_group(kept, ["lang", "part"], order, top, "rank").drop("rank", "part")
    best = top_k_per_group(kept, ["lang"], order, top, "rank")
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
