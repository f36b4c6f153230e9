"""SentencePiece encoding by sampling, and decoding.

Encoding draws a segmentation from the lattice of all ways to write a text in
the model's pieces, by forward filtering and backward sampling: the forward
pass sums the weights of all segmentations of every prefix, the backward pass
draws the last piece by its share, then the one before, and so on. A
segmentation's probability is proportional to the product of its pieces'
weights to the power ``alpha``: the model's own, or, where its scores are ranks
(BPE), Zipf weights 1 / (rank + 10).

The draw at a position is a hash of the seed, the row's key and the position,
so a row's segmentation doesn't depend on partitions, batches, retries or other
rows. A lattice falls apart wherever no piece spans two neighbours: before runs
of spaces, as no piece has a space after another character (checked for each
model; segments between them are taken once per slab of texts), and at every
other place that the pieces found leave uncovered, as around line ends, in noise
and in scripts of few pieces. The forward pass runs over all parts side by side,
and by itself over the rest of those that outlast the others, so texts without
spaces cost about what others do.

Decoding is lossless for every text: spaces are the piece character U+2581, a
leading one is added as the model's own encoder does, characters without a
piece (and U+2581 itself) become byte pieces.

Nulls and odd rows: a null or empty text gives an empty list, and decodes to an
empty text. Rows without key share the key "". Repeated rows get equal
segmentations. A text is one row's work, in blocks of bounded size, but for a
run of millions of characters that pieces cover without a gap (one letter again
and again): that is one block. Columns beside the carried ones are ignored,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of text that share a forward pass: what a Python worker needs
#: grows with them, by about 130 bytes for each where most words are new.
SLAB = 1_000_000
#: Pieces up to this length get a column each; segments that a longer piece
#: fits into are done apart, with columns for all lengths.
NARROW = 8
#: Ids that are decoded at a time.
DECODED = 1 << 18
_SPACE = "▁"
#: Stands for a U+2581 of the text itself: no text holds a lone surrogate.
_OWN = "\ud800"
#: So few parts left, the forward pass goes on with one at a time.
FEW = 6
_ROWS = 4096
_UNIT = np.float32(2.0**-24)
_SLOTS = 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pieces:
    """A model's pieces, as a trie for lattices and as bytes for decoding."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        usable: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                usable[piece] = i
                self.bytes[i] = piece.replace(_SPACE, " ").encode()
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.all_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        scores = {p: model.get_score(i) for p, i in usable.items()}
        if all(float(x).is_integer() for x in scores.values()):  # ranks
            order = sorted(usable, key=lambda p: -scores[p])
            weight = {p: -alpha * np.log(rank + 10) for rank, p in enumerate(order)}
            self.unknown = -alpha * np.log(10.0 * (n + 10))
        else:  # log probabilities
            weight = {p: alpha * x for p, x in scores.items()}
            self.unknown = alpha * (min(scores.values()) - 10)
        self.longest = max(map(len, usable))
        #: Whether every piece begins a run of spaces or has none: texts can be cut there unseen.
        self.spaces_lead = not any(_SPACE in p.lstrip(_SPACE) for p in usable)
        # trie: a state per prefix; steps in a table by a hash of (state, character)
        states = {p: s for s, p in enumerate(sorted({p[:k] for p in usable for k in range(1, len(p) + 1)}), 1)}
        self.piece = np.full(len(states) + 1, -1, np.int32)
        self.weight = np.full(len(states) + 1, -np.inf, np.float32)
        for p, i in usable.items():
            self.piece[states[p]], self.weight[states[p]] = i, weight[p]
        self.first = np.zeros(0x110000, np.int32)
        self.step_key, self.step_to = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, np.int32)
        for p, s in states.items():
            if len(p) == 1:
                self.first[ord(p)] = s
                continue
            key = (states[p[:-1]] << 21) | ord(p[-1])
            slot = int(self._slot(np.array([key]))[0])
            while self.step_key[slot] >= 0:
                slot = (slot + 1) % _SLOTS
            self.step_key[slot], self.step_to[slot] = key, s

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 19)).astype(np.int64)

    def step(self, state: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The states after one more character; 0: no piece goes on so."""
        key = (state.astype(np.int64) << 21) | chars
        slot = self._slot(key)
        there = self.step_key[slot]
        out = np.where(there == key, self.step_to[slot], 0)
        at = np.flatnonzero((there != key) & (there >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) % _SLOTS
            there = self.step_key[slot[at]]
            hit = there == key[at]
            out[at[hit]] = self.step_to[slot[at[hit]]]
            at = at[~hit & (there >= 0)]
        return out


def arcs(chars: np.ndarray, lengths: np.ndarray, model: Pieces) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """All pieces of two characters or more within segments that lie one after
    another: per length their first characters and their states."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    state = model.first[chars]
    at = np.flatnonzero(state > 0).astype(np.int32 if len(chars) + model.longest < 1 << 31 else np.int64)
    state, found = state[at], []
    for length in range(2, model.longest + 1):
        going = at + (length - 1) < ends[at]
        at, state = at[going], state[going]
        state = model.step(state, chars[at + (length - 1)])
        going = state > 0
        at, state = at[going], state[going]
        if not len(at):
            break
        known = model.piece[state] >= 0
        found.append((at[known], length, state[known]))
    return found


def uncovered(n: int, found: list[tuple[np.ndarray, int, np.ndarray]]) -> np.ndarray:
    """Places between ``n`` characters (place i is before character i) that no
    piece spans: every segmentation has a cut there, so that the lattice falls
    apart and both sides are drawn independently."""
    over = np.zeros(n + 1, np.int64)
    for at, length, _ in found:
        over += np.bincount(at + 1, minlength=n + 1)
        over -= np.bincount(at + length, minlength=n + 1)[: n + 1]
    return np.flatnonzero(np.cumsum(over)[:n] == 0)


class Lattices:
    """The lattices of some parts of a flat text, side by side: characters lie
    by position, at each position by part, the longer ones first, so that all
    parts take a step of the forward pass as one slice."""

    def __init__(self, chars: np.ndarray, begins: np.ndarray, lengths: np.ndarray, chosen: np.ndarray, found: list, model: Pieces, width: int):
        """``begins`` and ``lengths`` of all parts, ``chosen`` marks the ones
        laid out here; ``found``: ``arcs``."""
        mine = np.flatnonzero(chosen)
        self.lengths = lengths
        order = mine[np.argsort(-lengths[mine], kind="stable")]
        self.rank = np.full(len(lengths), -1, np.int64)
        self.rank[order] = np.arange(len(order))
        #: parts that have each position, and where its slice begins
        longest = lengths[order[0]] if len(order) else 0
        self.here = np.searchsorted(-lengths[order], -np.arange(1, longest + 1), side="right")
        self.begin = np.concatenate([[0], np.cumsum(self.here)])
        part = np.repeat(mine, lengths[mine])
        position = np.arange(len(part)) - np.repeat(np.cumsum(lengths[mine]) - lengths[mine], lengths[mine])
        source = begins[part] + position
        place = np.full(len(chars), -1, np.int64)
        place[source] = self.begin[position] + self.rank[part]
        #: Of all pieces that end at each character, by length: weights and ids.
        #: An id under 0 is a character written in bytes: -1 - character.
        n = len(part)
        self.weights = np.full((n, width), -np.inf, np.float32)
        self.ids = np.zeros((n, width), np.int32)
        state = model.first[chars[source]]
        alone = model.piece[state] < 0
        self.weights[place[source], 0] = np.where(alone, model.unknown, model.weight[state])
        self.ids[place[source], 0] = np.where(alone, -1 - chars[source], model.piece[state])
        for at, length, states in found:
            to = place[at + (length - 1)]
            here = to >= 0
            self.weights[to[here], length - 1] = model.weight[states[here]]
            self.ids[to[here], length - 1] = model.piece[states[here]]

    def forward(self) -> None:
        """Forward filtering: per character the cumulative shares of the
        lengths of the piece that ends there, in place of the weights."""
        width = self.weights.shape[1]
        sums = [np.zeros(self.here[0])] if len(self.here) else []
        for p, n in enumerate(self.here):
            if n <= FEW and p >= width:
                for rank in range(n):
                    self._forward_one(rank, p, [float(x[rank]) for x in sums])
                return
            x = np.full((n, width), -np.inf)
            part = self.weights[self.begin[p] : self.begin[p + 1]]
            for back in range(min(width, p + 1)):
                np.add(sums[-1 - back][:n], part[:, back], out=x[:, back])
            top = x.max(axis=1)
            x -= top[:, None]
            share = np.exp(x.astype(np.float32))
            share = np.cumsum(share, axis=1, out=share)
            sums.append(top + np.log(share[:, -1].astype(np.float64)))
            part[:] = share / share[:, -1:]
            if len(sums) > width:
                sums.pop(0)

    def _forward_one(self, rank: int, p: int, sums: list[float]) -> None:
        """The rest of one long part, character by character: where few parts
        are left, slices cost more than their numbers."""
        end = int(np.searchsorted(-self.here, -rank, side="left"))  # positions that this part has
        for a in range(p, end, _ROWS):
            rows = self.begin[a : min(a + _ROWS, end)] + rank
            out = []
            for weights in self.weights[rows].tolist():
                x = [s + w for s, w in zip(reversed(sums), weights, strict=True)]
                top = max(x)
                total, shares = 0.0, []
                for v in x:
                    if v > top - 100:
                        total += exp(v - top)
                    shares.append(total)
                out.append([v / total for v in shares])
                sums.append(top + log(total))
                del sums[0]
            self.weights[rows] = out

    def backward(self, kind: np.ndarray, keys: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, int]]]:
        """Backward sampling of occurrences of the parts ``kind``, a piece a
        round: how many pieces each has, and what was drawn, as (occurrences,
        ids, pieces after it). What outlasts many rounds is one occurrence with
        all its ids, the last one first. The draw at a character is a hash of
        the text's key and its place."""
        rank, left = self.rank[kind], self.lengths[kind]
        who, rounds, count = np.arange(len(kind)), [], np.zeros(len(kind), np.int64)
        while len(who):
            if len(rounds) > _ROWS and len(who) <= FEW:
                for i in range(len(who)):
                    ids = self._backward_one(int(rank[i]), int(left[i]), keys[i], int(offset[i]))
                    rounds.append((who[i], ids, int(count[who[i]])))
                    count[who[i]] += len(ids)
                break
            end = self.begin[left - 1] + rank
            draw = _mix(keys + (offset + left).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            u = (draw >> np.uint64(40)).astype(np.float32) * _UNIT
            length = (self.weights[end] <= u[:, None]).sum(axis=1)
            rounds.append((who, self.ids[end, length], len(rounds)))
            count[who] += 1
            left = left - length - 1
            going = left > 0
            who, left, rank, keys, offset = who[going], left[going], rank[going], keys[going], offset[going]
        return count, rounds

    def _backward_one(self, rank: int, left: int, key: np.uint64, offset: int) -> np.ndarray:
        """Ids of the first ``left`` characters of one part, the last one first:
        drawn at every character, then walked through."""
        ends = self.begin[:left] + rank
        length = np.empty(left, np.int64)
        for a in range(0, left, 1 << 16):
            places = np.arange(offset + a + 1, offset + min(a + (1 << 16), left) + 1).astype(np.uint64)
            u = (_mix(key + places * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.float32) * _UNIT
            length[a : a + (1 << 16)] = (self.weights[ends[a : a + (1 << 16)]] <= u[:, None]).sum(axis=1)
        steps, at = length.tolist(), []
        while left:
            at.append(left - 1)
            left -= steps[left - 1] + 1
        return self.ids[ends[at], length[at]]


@lru_cache(maxsize=4)
def load(path: str, alpha: float = 1.0) -> Pieces:
    return Pieces(path, alpha)


def segments(text: str) -> list[str]:
    """The text, with a space before it, cut before each run of spaces; the
    first space of each segment is left out."""
    if "  " not in text and not text.startswith(" "):
        return text.split(" ")
    return [s[1:] for s in re.findall(" +[^ ]*", " " + text)]


def sample(texts: list[str], keys: np.ndarray, model: Pieces, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and how many each text has. ``start``: characters that
    went before (a block of a longer text, which then has no space before it)."""
    kinds: dict[str, int] = {}
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            text = text.replace(_SPACE, _OWN)
            if start:
                own = [text.replace(" ", _SPACE)]
            elif model.spaces_lead:
                own = [_SPACE + s.replace(" ", _SPACE) if " " in s else _SPACE + s for s in segments(text)]
            else:
                own = [_SPACE + text.replace(" ", _SPACE)]
            counts[i] = len(own)
            flat += [kinds.setdefault(s, len(kinds)) for s in own]
    if not flat:
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    kind, names = np.array(flat, np.int64), list(kinds)
    del flat, kinds
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    chars = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    del names
    found = arcs(chars, lengths, model)
    # parts: what lies between the places that no piece spans
    begins = uncovered(len(chars), found)
    sizes = np.diff(np.append(begins, len(chars)))
    wide = np.zeros(len(begins), bool)
    for at, length, _ in found:
        if length > NARROW:
            wide[np.searchsorted(begins, at, side="right") - 1] = True
    first_part = np.searchsorted(begins, np.cumsum(lengths) - lengths)
    n_parts = np.diff(np.append(first_part, len(begins)))

    # occurrences of parts, in the order of the texts
    text_of = np.repeat(np.arange(len(texts)), counts)
    many = n_parts[kind]
    part = np.repeat(first_part[kind] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    text_of = np.repeat(text_of, many)
    before = np.cumsum(sizes[part]) - sizes[part]
    opening = np.searchsorted(text_of, np.arange(len(texts)))
    offset = start + before - before[np.minimum(opening, len(before) - 1)][text_of]

    n_pieces, rounds = np.zeros(len(part), np.int64), []
    for chosen, width in ((~wide, min(NARROW, model.longest)), (wide, model.longest)):
        if not chosen.any():
            continue
        lattices = Lattices(chars, begins, sizes, chosen, [f for f in found if f[1] <= width], model, width)
        lattices.forward()
        who = np.flatnonzero(chosen[part])
        n_pieces[who], drawn = lattices.backward(part[who], keys[text_of[who]], offset[who])
        del lattices
        rounds += [(who[x], ids, k) for x, ids, k in drawn]
        del drawn
    last = np.cumsum(n_pieces) - 1
    out = np.empty(int(last[-1]) + 1, np.int32)
    for who, piece, k in rounds:
        if np.ndim(who):
            out[last[who] - k] = piece
        else:
            out[last[who] - k - np.arange(len(piece))] = piece
    per_text = np.bincount(text_of, n_pieces, len(texts)).astype(np.int64)
    return _with_bytes(out, per_text, model)


def sample_long(text: str, key: np.ndarray, model: Pieces) -> np.ndarray:
    """Ids of one text over ``SLAB``, in blocks cut where no piece spans, so
    that memory doesn't grow with the text (but for a run that no place cuts)."""
    out, begin, size = [], 0, SLAB
    while begin < len(text):
        block = text[begin : begin + size]
        if begin + size < len(text):
            seen = (block if begin else " " + block).replace(_SPACE, _OWN).replace(" ", _SPACE)
            chars = np.frombuffer(seen.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            cuts = uncovered(len(chars), arcs(chars, np.array([len(chars)]), model)) - (begin == 0)
            cuts = cuts[(cuts > 0) & (cuts <= size - model.longest)]  # further on, pieces may go on beyond the block
            if not len(cuts):
                size *= 2
                continue
            block = block[: int(cuts[-1])]
        # places count from the space before the text
        out.append(sample([block], key, model, begin + 1 if begin else 0)[0])
        begin, size = begin + len(block), SLAB
    return np.concatenate(out)


def _with_bytes(ids: np.ndarray, per_text: np.ndarray, model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Characters without piece (ids under 0) as the pieces of their bytes."""
    where = np.flatnonzero(ids < 0)
    if not len(where):
        return ids, per_text
    chars, which = np.unique(-1 - ids[where], return_inverse=True)
    spelled = [chr(c if c != ord(_OWN) else ord(_SPACE)).encode() for c in chars.tolist()]
    extra = np.array([len(b) - 1 for b in spelled])[which]
    times = np.ones(len(ids), np.int64)
    times[where] += extra
    begin = np.cumsum(times) - times
    out = np.repeat(ids, times)
    order = np.argsort(which, kind="stable")
    bounds = np.searchsorted(which[order], np.arange(len(spelled) + 1))
    for c, b in enumerate(spelled):
        at = begin[where[order[bounds[c] : bounds[c + 1]]]]
        for k, byte in enumerate(b):
            out[at + k] = model.byte_id[byte]
    text_of = np.repeat(np.arange(len(per_text)), per_text)
    return out, per_text + np.bincount(text_of[where], extra, len(per_text)).astype(np.int64)


def _offsets(column: pa.Array) -> np.ndarray:
    """Where the column's strings or lists begin and end in its values."""
    wide = pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def _slabs(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of texts with about ``SLAB`` bytes; a longer text is one by itself."""
    begin = size = 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > SLAB:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, seed: int = 7,
           alpha: float = 1.0, model: str = MODEL) -> DataFrame:
    """``row`` (the columns ``carry`` as a struct, by default the id) and
    ``ids`` of every row's text."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or [id_col]]).alias("row"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model, alpha)
        for batch in batches:
            column = batch.column("text")
            keys = np.array([xxhash.xxh3_64_intdigest(f"{seed}:{k}") for k in batch.column("key").to_pylist()], np.uint64)
            for part in _slabs(np.diff(_offsets(column))):
                texts = column[part].to_pylist()
                if len(texts) == 1 and len(texts[0]) > SLAB:
                    ids = sample_long(texts[0], keys[part], pieces)
                    counts = np.array([len(ids)])
                else:
                    ids, counts = sample(texts, keys[part], pieces)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(part.start, len(counts)), lists], names=["row", "ids"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>")


def decoded(ids: np.ndarray, counts: np.ndarray, model: Pieces) -> pa.Array:
    """The texts of lists of ids that lie one after another: the pieces' bytes,
    without each text's first space."""
    start, size = model.start[ids], model.size[ids]
    first = (np.cumsum(counts) - counts)[counts > 0]
    start[first] += 1
    size[first] -= 1
    ends = np.cumsum(size)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for a in range(0, len(ids), DECODED):
        part = size[a : a + DECODED]
        to = int(ends[a] - size[a])
        n = int(part.sum())
        data[to : to + n] = model.all_bytes[np.repeat(start[a : a + DECODED] - (ends[a : a + DECODED] - part - to), part) + np.arange(n)]
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
    return pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(data))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` (row, ids) with ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            lists = batch.column("ids").fill_null([])
            texts = decoded(lists.flatten().to_numpy(), np.diff(_offsets(lists)), pieces)
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists, texts], names=["row", "ids", "text"])

    encoded = encoded.select("row", "ids")
    return encoded.mapInArrow(run, f"row {encoded.schema['row'].dataType.simpleString()}, ids array<int>, text string")
