"""MinHash near-dedup with b-bit signatures.

1. Features, one pass over the text: the document's set of 5-word shingles as
   64-bit hashes, its size and a 128-bit digest of the set; ``BANDS * ROWS``
   minima; from the minima a key per band, and a signature that keeps the low
   2 bits of each minimum, packed into 64-bit words.
2. Equal sets are one class, represented by its smallest document id; copies
   go no further.
3. Candidates by band. Every class is compared with the smallest id of each
   of its buckets. Then, where a bucket still holds several components, its
   members outside the largest one are compared with all members of other
   components, in cells of at most ``CELL`` by ``CELL`` members; a pair is
   taken in the first band that it shares, and only its link leaves the cell.
   Two classes that share a bucket thus end in one component or are compared,
   and a bucket of copies costs one comparison a member.
4. A comparison estimates the similarity by counting equal 2-bit fields of the
   signatures (xor and bit counts), corrected for chance agreement of 1/4;
   pairs under ``MARGIN`` go, the others are confirmed on their full sets.
5. Components by large-star / small-star over written edge tables.

Missed links: with 32 bands of 6 rows a pair at the threshold 0.85 shares no
bucket with probability 2.7e-7; its estimate falls 6 standard deviations under
the margin with probability about 1e-9.

Nulls and odd rows: a null, empty or blank text has an empty set and is linked
with nothing. A text under five words has one shingle, its whole sequence. Rows
without an id take no part: they get a null component and stay. Rows repeating
an id are one document. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import packed, unpacked, written

SHINGLE = 5
BANDS, ROWS = 32, 6
FIELDS = BANDS * ROWS
#: Least threshold: a pair at it shares no band with probability 6e-5.
LEAST_PERCENT = 80
#: 2-bit fields in a signature word.
FIELDS_PER_WORD = 32
#: Least estimate that is confirmed on full sets, as a distance from the threshold.
MARGIN = 0.2

_rng = np.random.RandomState(20240501)
_A = (_rng.randint(0, 2**32, FIELDS, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _rng.randint(0, 2**32, FIELDS, dtype=np.uint64).astype(np.uint32)[:, None]
_WORD_MIX = _rng.randint(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_MIX = _rng.randint(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _rng.randint(0, 2**63, BANDS, dtype=np.uint64)
_BLOCK = 2048
#: Members on either side of a cell of a bucket.
CELL = 1024


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hash of a word, remembered; emptied now and then, so it stays small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    total = np.full(n, min(len(h), SHINGLE), np.uint64)
    for i in range(min(SHINGLE, len(h))):
        total += _mix(h[i : i + n]) * _WORD_MIX[i]
    return np.unique(_mix(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of ``FIELDS`` permutations."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(FIELDS, 2**32 - 1, np.uint32)
    buffer = np.empty((FIELDS, min(_BLOCK, len(x))), np.uint32)
    for i in range(0, len(x), _BLOCK):
        part = x[None, i : i + _BLOCK]
        room = buffer[:, : part.shape[1]]
        np.multiply(_A, part, out=room)
        np.add(room, _B, out=room)
        np.minimum(low, room.min(axis=1), out=low)
    return low


def signature(low: np.ndarray) -> np.ndarray:
    """The minima's low 2 bits (after folding the halves), packed."""
    fields = ((low ^ (low >> np.uint32(16))) & np.uint32(3)).astype(np.uint64).reshape(-1, FIELDS_PER_WORD)
    return np.bitwise_or.reduce(fields << (np.arange(FIELDS_PER_WORD, dtype=np.uint64) * np.uint64(2)), axis=1)


def band_keys(low: np.ndarray) -> np.ndarray:
    return _mix((low.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_MIX).sum(axis=1) + _BAND_ADD)


def _long_lists(rows: list[np.ndarray | None]) -> pa.Array:
    lengths = [0 if r is None else len(r) for r in rows]
    values = [r.view(np.int64) for r in rows if r is not None]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.empty(0, np.int64)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        sizes, classes, signatures, bands = [], [], [], []
        for text in batch.column(1):
            s = shingle_set(text.as_buffer().to_pybytes() if text.is_valid else b"", hashes)
            sizes.append(len(s))
            if not len(s):
                classes.append(None), signatures.append(None), bands.append(None)
                continue
            low = minima(s)
            classes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            signatures.append(signature(low))
            bands.append(band_keys(low))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), _long_lists(signatures), _long_lists(bands)],
            names=["doc", "n_shingles", "class", "signature", "bands"],
        )


def _agreement(a: Column, b: Column) -> Column:
    """Estimated similarity of two signatures. Equal fields are counted on
    whole words; for unlike minima a 2-bit field agrees with chance 1/4."""
    words = FIELDS // FIELDS_PER_WORD
    unlike = sum(
        (F.bit_count((d := a[i].bitwiseXOR(b[i])).bitwiseOR(F.shiftright(d, 1)).bitwiseAND(F.lit(0x5555555555555555))) for i in range(words)),
        F.lit(0),
    )
    return ((1 - unlike / FIELDS) - 0.25) / 0.75


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Two sorted sets: 100 * intersection >= percent * union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * same >= percent * (len(x) + len(y) - same)


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    both = (
        pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        last, last_set = None, None
        for batch in batches:
            linked = []
            for text_a, text_b in zip(batch.column(2), batch.column(3), strict=True):
                raw = text_a.as_buffer().to_pybytes()
                if raw != last:
                    last, last_set = raw, shingle_set(raw, hashes)
                linked.append(_linked(last_set, shingle_set(text_b.as_buffer().to_pybytes(), hashes), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(check, "a long, b long").distinct()


def _cell_links(cell: list[tuple], key: int, least: float, percent: int, hashes: dict) -> list[tuple[int, int]]:
    """Links between the cell's rows and columns (is_row, stray, node, label,
    text, signature, bands) that join different labels. A pair is taken in the
    first band it shares; two strays meet with the smaller one as row."""
    rows, columns = [x for x in cell if x[0]], [x for x in cell if not x[0]]
    if not rows or not columns:
        return []
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    sets: dict[int, np.ndarray] = {}

    def set_of(x: tuple) -> np.ndarray:
        if x[2] not in sets:
            sets[x[2]] = shingle_set(x[4].encode("utf-8"), hashes)
        return sets[x[2]]

    signatures = np.array([x[5] for x in columns], np.int64).view(np.uint64)
    bands = np.array([x[6] for x in columns], np.int64)
    own = [np.array(x[5], np.int64).view(np.uint64) for x in rows]
    mask = np.uint64(0x5555555555555555)
    out = []
    for x, mine in zip(rows, own, strict=True):
        d = signatures ^ mine
        unlike = np.bitwise_count((d | (d >> np.uint64(1))) & mask).sum(axis=1)
        alike = np.flatnonzero(((1 - unlike / FIELDS) - 0.25) / 0.75 >= least)
        here = np.array(x[6], np.int64)
        for i in alike[(here[(bands[alike] == here).argmax(axis=1)] == key)].tolist():
            y = columns[i]
            if (y[1] and y[2] <= x[2]) or find(x[3]) == find(y[3]):
                continue
            if _linked(set_of(x), set_of(y), percent):
                root[find(x[3])] = find(y[3])
                out.append((x[2], y[2]))
    return out


def _across(active: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, least: float, percent: int) -> DataFrame:
    """Links (a, b) between members (key, node) of a bucket that are in
    different components so far."""
    labelled = written(active.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label")), "labelled")
    counted = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = counted.groupBy("key").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("n_main"), F.count("*").alias("parts")
    )
    mixed = written(
        mixed.where("parts > 1").select(
            "key", "main", F.expr(f"cast(ceil(n / {CELL}) as int)").alias("columns"), F.expr(f"cast(ceil((n - n_main) / {CELL}) as int)").alias("rows")
        ),
        "mixed-buckets",
    )
    rest = labelled.join(mixed, "key").withColumn("stray", F.col("label") != F.col("main"))
    place = F.xxhash64("node")
    columns = rest.withColumn("c", F.pmod(place, F.col("columns")).cast("int")).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    rows = rest.where("stray").withColumn("r", F.pmod(place, F.col("rows")).cast("int"))
    rows = rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
    names = ["key", "r", "c", "stray", "node", "label"]
    cells = columns.select(F.lit(False).alias("is_row"), *names).union(rows.select(F.lit(True).alias("is_row"), *names))
    known = written(texts.join(classes, F.col("doc") == F.col("node")).select("node", "text", "signature", "bands"), "cell-members")
    cells = cells.join(known, "node").select("key", "r", "c", "is_row", "stray", "node", "label", "text", "signature", "bands")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        at, cell = None, []

        def links() -> pa.RecordBatch:
            found = _cell_links(cell, at[0], least, percent, hashes)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for key, r, c, *member in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (key, r, c) != at:
                    if cell:
                        yield links()
                    at, cell = (key, r, c), []
                cell.append(tuple(member))
        if cell:
            yield links()

    return cells.repartition("key", "r", "c").sortWithinPartitions("key", "r", "c").mapInArrow(check, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the
    smallest node reachable. Alternates large-star and small-star until the
    edges stand still. The minimum of each node is written before it is joined
    back, so that a hub's edges can be split."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "edges")
    before = state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-minima")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "star-minima")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """Per row: ``doc``, ``n_shingles``, ``component`` and ``kept``. Documents
    are linked from ``percent`` hundredths of similarity; a component's
    smallest id stays. Under ``LEAST_PERCENT`` the bands would miss pairs."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent is {percent}: the bands find pairs from {LEAST_PERCENT} to 100 only")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    features = written(
        texts.mapInArrow(_features, "doc long, n_shingles long, class binary, signature array<long>, bands array<long>"), "features"
    )
    known = features.where("class is not null and doc is not null")
    classes = written(
        known.groupBy("class").agg(F.min("doc").alias("node"), F.first("signature").alias("signature"), F.first("bands").alias("bands")),
        "classes",
    )
    signatures = classes.select("node", "signature")

    # members of buckets that hold several classes
    members = classes.select(F.explode("bands").alias("key"), "node")
    first = members.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    first = written(first.where("first < last").select("key", "first"), "bucket-first")
    members = written(members.join(first, "key").join(signatures, "node"), "bucket-members")
    least = percent / 100 - MARGIN

    # of these, members that look like another one of the bucket; only their texts are read again
    other = members.select(F.col("key").alias("k"), F.col("node").alias("o"), F.col("signature").alias("s"))
    alike = _agreement(F.col("signature"), F.col("s")) >= least
    active = members.join(other, (F.col("key") == F.col("k")) & (F.col("node") != F.col("o")) & alike, "left_semi")
    active = written(active.select("key", "node").distinct(), "active-members")
    wanted = active.select(F.col("node").alias("doc")).distinct().hint("shuffle_hash")
    texts = written(texts.join(wanted, "doc", "left_semi"), "candidate-texts")

    # each against the bucket's smallest id
    heads = written(first.join(signatures.select(F.col("node").alias("first"), F.col("signature").alias("s")), "first"), "bucket-heads")
    stars = members.select("key", "node", "signature").join(heads, "key").where((F.col("node") != F.col("first")) & alike)
    links = written(_confirm(stars.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), texts, percent), "links")
    labels = written(components(links), "labels")

    # buckets that still hold several components
    more = written(_across(active, labels, classes, texts, least, percent), "links")
    if not more.isEmpty():
        stars_now = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = written(components(stars_now.union(more)), "labels")

    named = classes.select("class", "node").join(labels, "node", "left").select("class", F.coalesce("component", "node").alias("component"))
    named = written(named, "class-components")
    out = features.select("doc", "n_shingles", "class").join(named, "class", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return out.select("doc", "n_shingles", component.alias("component"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``docs`` whose document is kept (rows without id stay)."""
    gone = near_duplicates(docs, id_col, text_col, percent).where("not kept").select("doc").distinct()
    gone = written(gone, "duplicates")
    rows = packed(docs, doc=F.col(id_col).cast("long")).join(gone, "doc", "left_anti")
    return unpacked(rows, docs.columns)
