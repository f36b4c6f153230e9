"""Context-tree weighting against whole-tree probabilities."""

import re
from collections import Counter, defaultdict
from math import exp, lgamma, log, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import lm, queries

SCHEMA = "id long, text string, held boolean"
LOWER = {i: i + 32 for i in range(65, 91)}


class PlainTree:
    """A context tree per known bits, its whole probability computed anew for
    every bit, with the bit counted and without."""

    def __init__(self, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)

    def path(self, context, known):
        return [(context[len(context) - d :], known) for d in range(self.depth + 1)]

    def add(self, context, known, bit, by=1):
        nodes = self.path(context, known)
        for upper, node in zip(nodes, nodes[1:], strict=False):
            self.children[upper].add(node)
        for node in nodes:
            self.counts[node][bit] += by

    def log_weighted(self, node):
        a, b = self.counts[node]
        kt = lgamma(a + 0.5) + lgamma(b + 0.5) - 2 * lgamma(0.5) - lgamma(a + b + 1)
        if len(node[0]) == self.depth:
            return kt
        below = sum(self.log_weighted(c) for c in self.children[node])
        top = max(kt, below)
        return top + log(exp(kt - top) + exp(below - top)) - log(2)

    def decisions(self, text):
        data = b"\xff" * self.depth + text + b"\xff"
        for i in range(self.depth, len(data)):
            for k in range(8):
                yield data[i - self.depth : i], (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1

    def score(self, text):
        total = 0.0
        for context, known, bit in self.decisions(text):
            before = self.log_weighted((b"", known))
            self.add(context, known, bit)
            total += self.log_weighted((b"", known)) - before
            self.add(context, known, bit, -1)
        return total / log(10)


def lowered(text):
    return (text or "").translate(LOWER).encode()


def plain_base(rows):
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", lowered(t)) for i, t, _ in rows}
    train = Counter()
    for i, _, held in rows:
        if not held:
            train.update([*words[i], None])
    n, v = sum(train.values()), len(train)
    return {
        i: (len(words[i]) + 1, sum(train[w] > 0 for w in [*words[i], None]), n, sum(log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words[i], None]))
        for i in words
    }


def told(df, **options):
    out = lm.score(df, F.col("held"), ["id"], **options)
    return {r["row"]["id"]: r for r in out.collect()}


def sentences(rng, n):
    words = "the cat Sat on a mat été 漢字 x9 ... ﬀ".split()
    return [" ".join(words[rng.randint(len(words))] for _ in range(rng.randint(0, 7))) for _ in range(n)]


@pytest.mark.parametrize("depth", [3, 5])
def test_scores_against_whole_trees(spark, depth, monkeypatch):
    """Slices of a few bytes, small chunks, subtrees a few at a time."""
    monkeypatch.setattr(lm, "SLICE", 16)
    monkeypatch.setattr(lm, "CHUNK", 100)
    monkeypatch.setattr(lm, "BLOCK", 10)
    rng = np.random.RandomState(depth)
    rows = [(i, t, bool(rng.rand() < 0.3)) for i, t in enumerate(sentences(rng, 25))] + [(100, None, False), (101, "", True), (102, "zq\x00 Zq", True)]
    tree = PlainTree(depth)
    for _, text, held in rows:
        if not held:
            for context, known, bit in tree.decisions(lowered(text)):
                tree.add(context, known, bit)
    got, base = told(spark.createDataFrame(rows, SCHEMA).repartition(3), depth=depth), plain_base(rows)
    for i, text, held in rows:
        expected = tree.score(lowered(text))
        assert got[i]["score"] == pytest.approx(expected, rel=1e-9)
        assert got[i]["bits_per_byte"] == pytest.approx(-expected / log10(2) / (len(lowered(text)) + 1))
        assert got[i]["trains"] is (not held) and got[i]["n_bytes"] == len(lowered(text))
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == base[i][:3]
        assert got[i]["base_score"] == pytest.approx(base[i][3], rel=1e-9)


def test_next_bytes_are_a_distribution(spark):
    """The probabilities of all texts of no byte and all continuations sum to
    one: P(first byte) over the 256 bytes, the end byte among them."""
    rows = [(0, "abc abd abe", False), (1, "xyz", False)]
    strings = np.array([(0xFFFFFFFF << 8) | b for b in range(256)], np.int64)
    texts = [lowered(t) for _, t, _ in rows]
    found = np.concatenate([s for s, _ in lm._strings(texts, 4, lm.SLICE)])
    keys, counts = lm._summed(np.concatenate([found, strings]), np.concatenate([np.ones(len(found), np.int64), np.zeros(256, np.int64)]))
    p, tops = lm.weigh(keys, counts, 4, 2)
    node = np.concatenate([((t.keys >> 16) << 8) | (t.keys & 255) for t in tops])
    sums = {}
    for n, *values in zip(node.tolist(), *[np.concatenate([getattr(t, f) for t in tops]).tolist() for f in ("zeros", "ones", "weighted")], strict=True):
        sums[n] = [a + b for a, b in zip(sums.get(n, [0, 0, 0]), values, strict=True)]
    values = lm.Top([(n, *v) for n, v in sums.items()]).log10(keys, p, 4)
    first = np.isin(keys, strings)
    assert np.sum(10 ** values[first]) == pytest.approx(1, abs=1e-12)


def test_held_out_text_of_the_same_kind_scores_better(spark):
    rng = np.random.RandomState(9)
    vocabulary = ["".join(rng.choice(list("aeioulnrst"), rng.randint(2, 8))) for _ in range(300)]
    rows = [(i, " ".join(vocabulary[min(299, int(rng.exponential(40)))] for _ in range(80)), i % 10 == 0) for i in range(400)]
    noise = "".join(rng.permutation(list(rows[0][1])))
    got = told(spark.createDataFrame([*rows, (1000, noise, True)], SCHEMA).repartition(4))
    held = [got[i]["bits_per_byte"] for i in range(0, 400, 10)]
    assert max(held) < 3.5 and got[1000]["bits_per_byte"] > 1.5 * max(held)
    assert all(got[i]["score"] > got[i]["base_score"] - 60 for i in range(0, 400, 10))


def test_odd_tables(spark):
    assert told(spark.createDataFrame([], SCHEMA)) == {}
    got = told(spark.createDataFrame([(1, "ab", True), (2, None, True)], SCHEMA))  # nothing to learn from
    assert got[1]["score"] == pytest.approx(-24 * log10(2)) and got[2]["n_tokens"] == 1 and got[1]["base_score"] == pytest.approx(0)
    rows = [(1, "A word. " * 1_500_000, False), (2, "a word.", True), (2, "a word.", True), (None, "a", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("chunk", "string", "row", "kind", "value", "body")})
    out = lm.score(df, F.col("held"), ["id", "chunk"])
    got = [tuple(r["row"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (2, 1), (None, 1)], key=str)
    with pytest.raises(ValueError):
        told(df, depth=2)


def test_query_against_plain_base(spark, scratch):
    from zlib import crc32

    rng = np.random.RandomState(4)
    rows = [(i, t) for i, t in enumerate(sentences(rng, 60))] + [(None, "the end"), (-3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    held = {i: crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows}
    base = plain_base([(i, t, held[i]) for i, t in rows])
    for r in queries.op13_lm_score(spark, scratch).collect():
        expected = base[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[:3]
        assert r["base_score"] == pytest.approx(expected[3]) and r["score"] < 0
