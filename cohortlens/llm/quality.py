"""Quality rules: base counts and zstandard compression bands.

A text's compressed size over its size tells repetition (low) and noise
(high). Two measures are taken: the ratio of the whole document, held to
limits that depend on its length, and the ratios of its fixed chunks, which
find a bad stretch inside a document whose whole looks normal. What is left
after the full chunks, and a text under one chunk, is judged in smaller pieces
with limits for their length. Nothing moves between rows, so the operator is
one pass without a shuffle.

Noise over few letters (hex, random letters) compresses like short prose. So a
text must also repeat its pairs of neighbouring characters more often than the
same characters in random order would (``pair_repeats``): about once in noise
of any alphabet, 1.4 times and more in prose.

Nulls and odd rows: a null or empty text has no words, fails the base rule and
isn't kept. A row without id is judged like any other. Equal rows get equal
results. Long texts are read whole: compression runs over all bytes, chunk by
chunk. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WHITE, unpacked

LEVEL = 3
#: (bytes at least, least ratio, greatest ratio) of a whole document, the
#: longest class first. Short texts compress badly whatever they say, hence
#: wider limits. The limits lie a little outside the least and greatest ratios of
#: the documents that pass the base rule (README).
WHOLE_BANDS = (
    (16384, 0.25, 0.50), (4096, 0.27, 0.53), (2048, 0.29, 0.58), (1024, 0.31, 0.64), (512, 0.34, 0.71), (256, 0.38, 0.76), (0, 0.0, 0.90),
)
#: Wider upper limits where characters have several bytes, per byte above one;
#: lower limits are divided by the bytes per character.
WIDER = 0.2
#: Least pair repeats of prose, judged from so many expected repeats.
PAIR_REPEATS, EXPECTED_REPEATS = 1.3, 20
CHUNK = 4096
CHUNK_BAND = (0.25, 0.58)
#: A document goes if more than this share of its full chunks is out of the band.
BAD_CHUNKS = 0.1
#: It goes too if more than this share of its bytes lies in bad pieces (full
#: chunks, and the rest in pieces of ``PIECE``), or so many bytes on end.
BAD_BYTES, BAD_RUN = 0.1, 8192
PIECE, LEAST_PIECE = 1024, 512
MIN_WORDS = 50

_SPACE = WHITE.encode()
#: Bytes that continue a UTF-8 character.
_CONTINUE = bytes(range(0x80, 0xC0))
#: White space and the bytes that continue a UTF-8 character.
_NOT_COUNTED = _SPACE + _CONTINUE
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    # windows by number: pairs first, so that two numbers always fit in 64 bits
    _, pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[window] > 1)
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[starts + k] = True
    return int(inside.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text.translate(None, _NOT_COUNTED)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def pair_repeats(text: bytes) -> tuple[float, float]:
    """Equal pairs of neighbouring characters over those expected if characters
    followed each other by chance, and the number expected. Characters count by
    the low byte of their code point: that leaves chance at 1."""
    low = np.frombuffer(text.decode("utf-8", "ignore").encode("utf-32-le"), np.uint8)[::4]
    n = len(low)
    if n < 3:
        return 1.0, 0.0
    single = np.bincount(low).astype(np.float64)
    pair = np.bincount(low[:-1].astype(np.int64) * 256 + low[1:])
    pair = pair[pair > 1].astype(np.float64)
    chance = (single @ (single - 1) / (n * (n - 1.0))) ** 2
    expected = chance * (n - 1) * (n - 2) / 2
    return (float(pair @ (pair - 1)) / 2 / expected, expected) if expected else (1.0, 0.0)


def by_chance(text: bytes) -> bool:
    """The text's characters follow each other as in noise."""
    repeats, expected = pair_repeats(text)
    return bool(expected >= EXPECTED_REPEATS and repeats < PAIR_REPEATS)


def bytes_per_char(text: bytes) -> float:
    return max(1.0, len(text) / (len(text.translate(None, _CONTINUE)) or 1))


def in_band(ratio: float, low: float, high: float, width: float = 1.0) -> bool:
    """``width``: bytes per character."""
    return low / width <= ratio <= high * (1 + WIDER * (width - 1))


def bad_piece(piece: bytes, band: tuple[float, float], compressor: zstandard.ZstdCompressor) -> bool:
    ratio = len(compressor.compress(piece)) / len(piece)
    return not in_band(ratio, *band, bytes_per_char(piece)) or by_chance(piece)


def rest_pieces(text: bytes) -> list[tuple[int, bytes]]:
    """What follows the full chunks, or a text under one chunk, in pieces: how
    many bytes are new in each, and the piece. The last one reaches back to
    have ``LEAST_PIECE`` bytes, where the text has as many."""
    out = []
    for at in range(len(text) // CHUNK * CHUNK, len(text), PIECE):
        end = min(at + PIECE, len(text))
        out.append((end - at, text[max(0, min(at, end - LEAST_PIECE)) : end]))
    return out


def measures(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, float, float, int]:
    """Compressed share of the whole text, the share of its full chunks that
    are out of ``CHUNK_BAND`` or noise by their pairs, the share of its bytes
    in bad pieces, and the most such bytes on end."""
    if not text:
        return 0.0, 0.0, 0.0, 0
    whole = len(compressor.compress(text)) / len(text)
    n = len(text) // CHUNK
    bad = [(CHUNK, bad_piece(text[i * CHUNK : (i + 1) * CHUNK], CHUNK_BAND, compressor)) for i in range(n)]
    chunks = sum(b for _, b in bad) / n if n else 0.0
    bad += [(size, bad_piece(piece, band_of(len(piece)), compressor)) for size, piece in rest_pieces(text)]
    run = longest = total = 0
    for size, is_bad in bad:
        run = run + size if is_bad else 0
        total += size * is_bad
        longest = max(longest, run)
    return whole, chunks, total / len(text), longest


def band_of(size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in WHOLE_BANDS if size >= least)


def in_bands(size: int, whole: float, bad_chunks: float, width: float = 1.0, bad_bytes: float = 0.0, bad_run: int = 0) -> bool:
    good = bad_chunks <= BAD_CHUNKS and bad_bytes <= BAD_BYTES and bad_run <= BAD_RUN
    return good and in_band(whole, *band_of(size), width)


def judged(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple:
    counts = base_counts(text)
    whole, bad, bad_bytes, bad_run = measures(text, compressor)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > 50 * counts[0]
    kept = not failed and in_bands(len(text), whole, bad, bytes_per_char(text), bad_bytes, bad_run) and not by_chance(text)
    return (*counts, whole, bad, failed, kept)


_FIELDS = (
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("ratio", pa.float64()), ("bad_chunks", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = [judged(t.as_buffer().to_pybytes() if t.is_valid else b"", compressor) for t in batch.column("text")]
        columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
        found = [pa.array(values, kind) for values, (_, kind) in zip(columns, _FIELDS, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *found], names=["row", *[n for n, _ in _FIELDS]])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of the input as a struct, by default only
    the id) and per row the base counts, ``ratio``, ``bad_chunks``,
    ``base_failed`` and ``kept``."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry or [id_col]])
    rows = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    kinds = {pa.int64(): "long", pa.float64(): "double", pa.bool_(): "boolean"}
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{n} {kinds[k]}" for n, k in _FIELDS)
    return rows.mapInArrow(_judge, schema)


def passing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return unpacked(quality(docs, id_col, text_col, carry=docs.columns).where("kept").select("row"), docs.columns)
