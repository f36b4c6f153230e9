"""Language-model scores: context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z in lower case, closed by one end byte and
preceded by ``depth`` of them (0xFF, which UTF-8 doesn't have). A byte is eight
binary decisions, most significant bit first; each of the 255 places in that
decision tree has a context tree of its own, whose contexts are the last 0 to
``depth`` bytes. A node with a zeros and b ones has the Krichevsky-Trofimov
estimate KT(a, b); its weighted probability is

    W = (KT + product of W over its children) / 2, and W = KT at full depth.

The next bit's probability, given training, is the tree's W with the bit over W
without it, which unrolls along the path of contexts: a node stops with
probability KT / 2W and uses its own estimate, else asks its child. The model is
learned once and doesn't learn from the text it scores, so rows are independent.
The score is the sum over bits; ``bits_per_byte`` is the code length.

As Spark work:

1. ``chunks``: texts in chunks of about ``CHUNK`` bytes, as they are scanned;
2. ``gathered``: each chunk's different (context, byte) strings, with how often
   training texts hold them, and each chunk's different words;
3. ``subtrees``: strings added up and dealt by their last two context bytes; a
   task works through whole subtrees, so all weights below depth two are known
   there. What is above are 65,280 nodes at most: those go to the driver;
4. ``replies``: each chunk's strings are joined with their probabilities, words
   with their counts, and come back to the chunk's texts, which look them up.

The model is never in one place, and grows with what the corpus holds. Strings
and words of a chunk meet its texts in one task; a chunk's size is bounded (a
longer text is a chunk), so is that task's.

Nulls and odd rows: a null or empty text is the end byte alone. Repeated rows
count each time. Carried columns come back in ``row``, whatever their names;
others are ignored. Without training texts every bit has probability 1/2. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, log10

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortlens.llm.common import written

DEPTH = 4
CHUNK = 32 << 20
#: Bytes of text that become strings at a time.
SLICE = 1 << 20
#: Strings that a task of ``subtrees`` works on at a time (whole subtrees).
BLOCK = 200_000
_END = b"\xff"
_LN2 = log(2)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _strings(bodies: list[bytes], depth: int, size_limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (context, byte) strings of texts, in slices of ``size_limit``
    bytes: as numbers, the latest context byte first and the byte itself last,
    and whose text each is from."""

    def slices() -> Iterator[tuple[int, bytes]]:
        for i, body in enumerate(bodies):
            whole = _END * depth + body + _END
            for a in range(0, len(whole) - depth, size_limit):
                yield i, whole[a : a + size_limit + depth]

    def numbers(part: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(b"".join(b for _, b in part), np.uint8).astype(np.int64)
        lengths = np.array([len(b) for _, b in part])
        ends = np.cumsum(lengths)
        usable = np.ones(ends[-1], bool)
        usable[(ends[:, None] - 1 - np.arange(depth)).ravel()] = False
        usable = usable[: len(x) - depth]
        n = len(usable)
        out = np.zeros(n, np.int64)
        for back in range(1, depth + 1):
            out = (out << 8) | x[depth - back : depth - back + n]
        out = (out << 8) | x[depth : depth + n]
        return out[usable], np.repeat(np.array([i for i, _ in part]), lengths - depth)

    part: list[tuple[int, bytes]] = []
    size = 0
    for piece in slices():
        part.append(piece)
        size += len(piece[1])
        if size >= size_limit:
            yield numbers(part)
            part, size = [], 0
    if part:
        yield numbers(part)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[at], np.add.reduceat(weights, at) if len(at) else weights


def chunks(docs: DataFrame, held_out: Column, carry: list[str], text_col: str) -> DataFrame:
    """chunk, row, trains and the text's bytes, lower-cased and compressed."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        (~F.coalesce(held_out, F.lit(False))).alias("trains"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("body"),
    )
    schema = StructType.fromDDL("chunk long").add(rows.schema["row"]).add("trains", "boolean").add("body", "binary")

    limit = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            number, packed = [], []
            for body in batch.column(2):
                body = body.as_py().translate(_LOWER)
                if size and size + len(body) > limit:
                    chunk, size = chunk + 1, 0
                size += len(body)
                number.append(chunk)
                packed.append(packer.compress(body))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), batch.column(0), batch.column(1), pa.array(packed, pa.binary())], schema=to_arrow_schema(schema))

    return written(rows.mapInArrow(run, schema), "lm-chunks")


def _by_chunk(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Runs of texts of one chunk, with about ``size`` bytes each."""
    unpacker = zstandard.ZstdDecompressor()
    now, bodies, trains, held = None, [], [], 0
    for batch in batches:
        for chunk, train, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if bodies and (chunk != now or held >= size):
                yield now, bodies, np.array(trains, np.int64)
                bodies, trains, held = [], [], 0
            now = chunk
            bodies.append(unpacker.decompress(body.as_py()))
            trains.append(train)
            held += len(bodies[-1])
    if bodies:
        yield now, bodies, np.array(trains, np.int64)


def gathered(chunked: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """(chunk, string, n) and (chunk, word, n): what each chunk holds, and how
    often its training texts do."""
    texts, limit = chunked.select("chunk", "trains", "body"), SLICE

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, np.empty(0, np.int64), np.empty(0, np.int64)

        def told() -> Iterator[pa.RecordBatch]:
            for a in range(0, len(keys), 1 << 16):
                n = len(keys[a : a + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.array([now] * n, pa.int64()), pa.array(keys[a : a + n]), pa.array(counts[a : a + n])], names=["chunk", "string", "n"])

        for chunk, bodies, trains in _by_chunk(batches, limit):
            if chunk != now:
                yield from told()
                now, keys, counts = chunk, np.empty(0, np.int64), np.empty(0, np.int64)
            for found, of in _strings(bodies, depth, limit):
                found = (found << 1) | trains[of]
                found.sort()
                single = found >> 1
                at = np.flatnonzero(np.concatenate([[True], single[1:] != single[:-1]]))
                keys, counts = _summed(np.concatenate([keys, single[at]]), np.concatenate([counts, np.add.reduceat(found & 1, at)]))
        yield from told()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, {}

        def told() -> Iterator[pa.RecordBatch]:
            names, counts = list(seen), list(seen.values())
            for a in range(0, len(names), 1 << 16):
                part = names[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([now] * len(part), pa.int64()), pa.array(part, pa.binary()), pa.array(counts[a : a + len(part)], pa.int64())], names=["chunk", "word", "n"])

        for chunk, bodies, trains in _by_chunk(batches, limit):
            if chunk != now:
                yield from told()
                now, seen = chunk, {}
            for body, train in zip(bodies, trains.tolist(), strict=True):
                for word in body.split():
                    seen[word] = seen.get(word, 0) + train
        yield from told()

    return (
        written(texts.mapInArrow(strings, "chunk long, string long, n long"), "lm-strings"),
        written(texts.mapInArrow(words, "chunk long, word binary, n long"), "lm-words"),
    )


_SMALL = np.array([lgamma(i / 2 + 0.5) for i in range(8192)])


def _lgamma(twice: np.ndarray) -> np.ndarray:
    """ln gamma(twice / 2 + 1/2), elementwise, of whole numbers."""
    out = _SMALL[np.minimum(twice, len(_SMALL) - 1)]
    large = np.flatnonzero(twice >= len(_SMALL))
    if len(large):
        x = twice[large] / 2 + 0.5
        out[large] = (x - 0.5) * np.log(x) - x + 0.5 * log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov estimate of so many zeros and ones."""
    return _lgamma(2 * zeros) + _lgamma(2 * ones) - log(np.pi) - _lgamma(2 * (zeros + ones) + 1)


class Nodes:
    """The nodes of one context length and one place of a byte (``k`` bits of it
    known), in order of (context, known bits): counts, ln KT and ln W."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray, k: int):
        byte = strings & 255
        keys = ((strings >> 8) << 8) | (1 << k) | (byte >> (8 - k))
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ones = (byte >> (7 - k)) & 1
        self.keys = keys[at]
        self.ones = np.add.reduceat(counts * ones, at)
        self.zeros = np.add.reduceat(counts * (1 - ones), at)
        self.kt = log_kt(self.zeros, self.ones)
        self.weighted = self.kt

    def weight(self, children: np.ndarray) -> None:
        """``children``: the sum of ln W over each node's children."""
        self.weighted = np.logaddexp(self.kt, children) - _LN2

    def mixed(self, at: np.ndarray, bit: np.ndarray, below: np.ndarray | None) -> np.ndarray:
        """Probability of ``bit`` at the nodes ``at``; ``below`` is the
        children's, None at full depth."""
        own = (np.where(bit, self.ones[at], self.zeros[at]) + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)
        if below is None:
            return own
        stop = np.exp(self.kt[at] - self.weighted[at] - _LN2)
        return stop * own + (1 - stop) * below


def weigh(strings: np.ndarray, counts: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, list[Nodes]]:
    """For whole subtrees below contexts of ``least`` bytes: the probabilities
    of each string's eight bits there (strings x 8), and that level's nodes."""
    byte = strings & 255
    levels = {depth: (strings, counts)}
    for d in range(depth - 1, least - 1, -1):
        above, n = levels[d + 1]
        levels[d] = _summed(((above >> 16) << 8) | (above & 255), n)
    probabilities, tops = np.empty((len(strings), 8)), []
    for k in range(8):
        bit = ((byte >> (7 - k)) & 1).astype(bool)
        below, p = None, None
        for d in range(depth, least - 1, -1):
            nodes = Nodes(*levels[d], k)
            if below is not None:
                parent = np.searchsorted(nodes.keys, ((below.keys >> 16) << 8) | (below.keys & 255))
                nodes.weight(np.bincount(parent, below.weighted, len(nodes.keys)))
            key = ((strings >> (8 * (depth - d) + 8)) << 8) | (1 << k) | (byte >> (8 - k))
            p = nodes.mixed(np.searchsorted(nodes.keys, key), bit, p)
            below = nodes
        probabilities[:, k] = p
        tops.append(below)
    return probabilities, tops


def subtrees(strings: DataFrame, depth: int) -> DataFrame:
    """For every string its bits' probabilities at contexts of two bytes; and,
    in rows without string, the sums over those contexts by their last byte:
    node, zeros, ones and ln W."""
    root = F.shiftright("string", 8 * (depth - 1)).alias("root")
    summed = strings.select(root, "string", "n").repartition("root").groupBy("root", "string").agg(F.sum("n").alias("n"))

    def block(part: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = (np.concatenate([b.column(c).to_numpy() for b in part]) for c in (1, 2))
        p, tops = weigh(keys, counts, depth, 2)
        for a in range(0, len(keys), 1 << 14):
            n = len(keys[a : a + (1 << 14)])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 8, pa.int32()), pa.array(p[a : a + n].ravel()))
            none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + n]), lists, *none], names=names)
        node = np.concatenate([((t.keys >> 16) << 8) | (t.keys & 255) for t in tops])
        n = len(node)
        columns = [np.concatenate([getattr(t, f) for t in tops]) for f in ("zeros", "ones", "weighted")]
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.float64())), pa.array(node), *map(pa.array, columns)], names=names)

    least = BLOCK
    names = ["string", "p", "node", "zeros", "ones", "weighted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = [], 0
        for batch in batches:
            roots = batch.column(0).to_numpy()
            if held >= least and batch.num_rows:  # up to the first new root
                same = int(np.argmax(roots != part[-1].column(0)[-1].as_py())) if roots[-1] != part[-1].column(0)[-1].as_py() else len(roots)
                if same < len(roots):
                    yield from block([*part, batch.slice(0, same)])
                    part, held, batch = [], 0, batch.slice(same)
            part.append(batch)
            held += batch.num_rows
        if held:
            yield from block(part)

    ordered = summed.sortWithinPartitions("root", "string")
    return written(ordered.mapInArrow(run, "string long, p array<double>, node long, zeros long, ones long, weighted double"), "lm-subtrees")


class Top:
    """The nodes of contexts of one byte and of none: stop probabilities and
    own estimates of a one, by node number (context << 8 | known bits)."""

    def __init__(self, rows: list):
        """``rows``: (node, zeros, ones, sum of the children's ln W) of contexts of one byte."""
        node = np.array([r[0] for r in rows], np.int64)
        zeros, ones = (np.array([r[c] for r in rows], np.int64) for c in (1, 2))
        below = np.array([r[3] for r in rows], np.float64)
        self.levels = []
        for size in (1 << 16, 1 << 8):
            kt = log_kt(zeros, ones)
            weighted = np.logaddexp(kt, below) - _LN2
            stop, own = np.full(size, 0.5), np.full(size, 0.5)
            stop[node], own[node] = np.exp(kt - weighted - _LN2), (ones + 0.5) / (zeros + ones + 1.0)
            self.levels.append((stop, own))
            above = node & 255
            node, zeros = _summed(above, zeros)
            ones, below = _summed(above, ones)[1], _summed(above, weighted)[1]

    def log10(self, strings: np.ndarray, p: np.ndarray, depth: int) -> np.ndarray:
        """log10 of each string's byte, from its bits' probabilities below."""
        byte, context = strings & 255, strings >> (8 * depth)
        out = np.zeros(len(strings))
        for k in range(8):
            place, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
            q = p[:, k]
            for (stop, own), node in zip(self.levels, ((context << 8) | place, place), strict=True):
                mine = np.where(bit, own[node], 1 - own[node])
                q = stop[node] * mine + (1 - stop[node]) * q
            out += np.log10(q)
        return out


def replies(strings: DataFrame, weighed: DataFrame, depth: int) -> DataFrame:
    """(chunk, string, value): log10 of the probability of every chunk's strings."""
    sums = weighed.where("string is null").groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted"))
    top = strings.sparkSession.sparkContext.broadcast(Top(sums.collect()))  # 256 contexts x 255 places at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            values = top.value.log10(keys, batch.column(1).flatten().to_numpy().reshape(-1, 8), depth)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["string", "value"])

    values = weighed.where("string is not null").select("string", "p").mapInArrow(run, "string long, value double")
    return strings.select("chunk", "string").join(values, "string")


def score(docs: DataFrame, held_out: Column, carry: list[str], text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """row (the columns ``carry``), trains, n_bytes, score (log10 of the
    text's probability), bits_per_byte (end byte included), and for comparison
    the words' add-0.1 estimate: n_tokens, n_known, train_tokens, base_score.
    The model learns from the texts that ``held_out`` is not true for."""
    if not 3 <= depth <= 6:
        raise ValueError("depth: 3 to 6 bytes")
    chunked = chunks(docs, held_out, carry, text_col)
    strings, words = gathered(chunked, depth)
    known = replies(strings, subtrees(strings, depth), depth)

    counts = written(words.groupBy("word").agg(F.sum("n").alias("c")), "lm-vocabulary")
    n_words, n_different = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n_ends = chunked.where("trains").count()
    all_tokens, different = n_words + n_ends, n_different + (n_ends > 0)
    share = log10(all_tokens + 0.1 * (different + 1))
    told = words.select("chunk", "word").join(counts, "word")

    row = chunked.schema["row"]
    # one narrow shape for the three kinds of rows, in the order a chunk reads them
    kinds = (
        (known, F.col("string"), F.col("value"), F.lit(None).cast("binary"), F.lit(None).cast(row.dataType)),
        (told, F.lit(None).cast("long"), F.col("c").cast("double"), F.col("word"), F.lit(None).cast(row.dataType)),
        (chunked, F.col("trains").cast("long"), F.lit(None).cast("double"), F.col("body"), F.col("row")),
    )
    arrivals = None
    for kind, (df, *columns) in enumerate(kinds):
        part = df.select("chunk", F.lit(kind).alias("kind"), *[c.alias(n) for c, n in zip(columns, ("number", "value", "blob", "row"), strict=True)])
        arrivals = part if arrivals is None else arrivals.unionByName(part)
    limit, out = SLICE, StructType([row]).add("trains", "boolean").add("n_bytes", "long").add("score", "double").add("bits_per_byte", "double")
    out = out.add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        now, parts, table, vocabulary = None, [], None, {}
        for batch in batches:
            chunk, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            tag = chunk * 4 + kind
            begins = np.flatnonzero(np.concatenate([[True], tag[1:] != tag[:-1]])) if len(tag) else []
            for a, b in zip(begins, [*begins[1:], len(tag)], strict=True):
                if chunk[a] != now:
                    now, parts, table, vocabulary = chunk[a], [], None, {}
                piece = batch.slice(a, b - a)
                if kind[a] == 0:
                    parts.append((piece.column(2).to_numpy(), piece.column(3).to_numpy()))
                elif kind[a] == 1:
                    vocabulary.update(zip(piece.column(4).to_pylist(), piece.column(3).to_pylist(), strict=True))
                else:
                    if table is None:
                        keys, values = (np.concatenate([p[c] for p in parts]) for c in (0, 1))
                        order = np.argsort(keys)
                        table, parts = (keys[order], values[order]), []
                    yield scored(piece, table, vocabulary, unpacker)

    def scored(piece: pa.RecordBatch, table: tuple[np.ndarray, np.ndarray], vocabulary: dict[bytes, float], unpacker) -> pa.RecordBatch:
        bodies = [unpacker.decompress(b.as_py()) for b in piece.column(4)]
        totals = np.zeros(len(bodies))
        for keys, of in _strings(bodies, depth, limit):
            totals += np.bincount(of, table[1][np.searchsorted(table[0], keys)], len(bodies))
        n_tokens, n_known, base = [], [], []
        for body in bodies:
            tokens = body.split()
            c = np.fromiter(map(vocabulary.__getitem__, tokens), np.float64, len(tokens))
            n_tokens.append(len(tokens) + 1)
            n_known.append(int((c > 0).sum()) + (n_ends > 0))
            base.append(float(np.log10(c + 0.1).sum()) + log10(n_ends + 0.1) - (len(tokens) + 1) * share)
        n_bytes = np.array([len(b) for b in bodies], np.int64)
        return pa.RecordBatch.from_arrays(
            [
                piece.column(5), pa.array(piece.column(2).to_numpy() == 1), pa.array(n_bytes), pa.array(totals), pa.array(-totals / log10(2) / (n_bytes + 1)),
                pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([all_tokens] * len(bodies), pa.int64()), pa.array(base),
            ],
            schema=to_arrow_schema(out),
        )

    return arrivals.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(run, out)
