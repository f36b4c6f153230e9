"""Token ids in packed binary rows.

Documents are tokenised, each ended by ``END``. A document longer than a row is
split: its full parts fill rows of their own, the remainder is packed like a
short document. Remainders are packed best-fit-decreasing: longest first, each
into the open row with the least room that still holds it. That row is found in
a segment tree over room sizes, in the logarithm of the row length.

Packing runs in windows of ``WINDOW`` tokens inside the input's own partitions,
so ids never cross the network and a window is all that a task holds. A lost
task's rows are made again from the same input rows.

Output, a row per packed row: ``ids`` (little-endian uint16 matrix row of
``row_length`` ids, filled up with ``END``), ``positions`` (as many uint16,
restarting at 0 with each segment), ``cu_seqlens`` (cumulative segment lengths,
from 0), ``docs`` and ``starts`` (each segment's document and its first token's
place in it).

Nulls and odd rows: a null or empty text is the single id ``END``. A null id is
kept as null; repeated rows are packed as often as they occur. An empty table
gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokeniser's vocabulary splits words (a fixed value of that vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
ROW_LENGTH = 2048
WINDOW = 1 << 20


@lru_cache(maxsize=2)
def tokeniser(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Rooms:
    """Open rows by room: a segment tree whose leaves count rows of a room."""

    def __init__(self, largest: int):
        self.leaves = 1 << largest.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of the smallest room that isn't under ``least``."""
        node = self.leaves + least
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.count[node]
        room = node - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], row_length: int) -> list[list[int]]:
    """Items of each row; every length is between 1 and ``row_length``."""
    rooms, rows = Rooms(row_length), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[item])
        if found is None:
            found = row_length, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(item)
        if room > lengths[item]:
            rooms.put(room - lengths[item], row)
    return rows


def _window(docs: list[tuple[int | None, np.ndarray]], row_length: int) -> pa.RecordBatch:
    """The packed rows of the documents (id, ids)."""
    rows, rest = [], []
    for doc, ids in docs:
        full = len(ids) // row_length * row_length
        rows += [[(doc, at, ids[at : at + row_length])] for at in range(0, full, row_length)]
        if full < len(ids):
            rest.append((doc, full, ids[full:]))
    rows += [[rest[i] for i in row] for row in best_fit([len(part) for _, _, part in rest], row_length)]
    ids = np.full((len(rows), row_length), END, np.uint16)
    positions = np.zeros((len(rows), row_length), np.uint16)
    count = np.arange(row_length, dtype=np.uint16)
    ends = []
    for r, row in enumerate(rows):
        at = 0
        ends.append([0])
        for _, _, part in row:
            ids[r, at : at + len(part)] = part
            positions[r, at : at + len(part)] = count[: len(part)]
            at += len(part)
            ends[-1].append(at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x.tobytes() for x in ids], pa.binary()),
            pa.array([x.tobytes() for x in positions], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([[doc for doc, _, _ in row] for row in rows], pa.list_(pa.int64())),
            pa.array([[at for _, at, _ in row] for row in rows], pa.list_(pa.int64())),
        ],
        names=["ids", "positions", "cu_seqlens", "docs", "starts"],
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_length: int = ROW_LENGTH, ranks: str = RANKS) -> DataFrame:
    """The packed rows of ``docs``. ``row_length``: 65,536 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokeniser(ranks).encode_ordinary
        held, tokens = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END], np.uint16)
                held.append((doc, ids))
                tokens += len(ids)
                if tokens >= WINDOW:
                    yield _window(held, row_length)
                    held, tokens = [], 0
        if held:
            yield _window(held, row_length)

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "ids binary, positions binary, cu_seqlens array<int>, docs array<long>, starts array<long>")
