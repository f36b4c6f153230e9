"""Collocations against plain counting."""

import os
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import collocation

SCHEMA = "lang string, text string"
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least=10, percent=50, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * c >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in candidates.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def told(df, **options):
    return sorted(tuple(r) for r in collocation.collocations(df, **options).collect())


def random_rows(rng, n, length=60):
    words = ["of", "THE", "the", "new", "york", "Y", "a", "in", "l'été", "x1", "#", "ﬀ", " ", "\xa0b"]
    rows = []
    for _ in range(n):
        text = "".join(words[min(len(words) - 1, int(rng.exponential(4)))] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\x0b"]) for _ in range(rng.randint(0, length)))
        rows.append((("en", "de", None, "")[rng.randint(4)], text if rng.rand() > 0.05 else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_against_plain_counts(spark, seed):
    rows = random_rows(np.random.RandomState(seed), 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit("x") for c in ("prefix", "next", "f", "n", "phrase")})
    expected = plain(rows)
    assert len(expected) > 60 and told(df) == expected


def test_small_rounds_shards_and_cuts(spark, monkeypatch):
    """Rounds of some hundred bytes, texts cut within pieces, prefixes in
    shards, a bitmap so small that unmarked pairs hardly exist."""
    monkeypatch.setattr(collocation, "ROUND", 400)
    monkeypatch.setattr(collocation, "HELD", 900)
    monkeypatch.setattr(collocation, "CUT", 64)
    monkeypatch.setattr(collocation, "BITS", 128)
    monkeypatch.setattr(collocation, "SHARES", 16)
    rng = np.random.RandomState(3)
    rows = random_rows(rng, 60, 200) + [("en", " ".join(("new york in the a of".split())[rng.randint(6)] for _ in range(3000)))]
    assert told(spark.createDataFrame(rows, SCHEMA).repartition(3), top=5) == plain(rows, top=5)


def test_hot_prefix_is_split(spark):
    """A pair and a word that hold a third of all words: their stripes are
    dealt to many shards, each prefix found rarely stays in one."""
    rows = [("en", f"hot pair w{i % 997} other{i} thing{i}") for i in range(4000)]
    texts = spark.createDataFrame(rows, SCHEMA)
    words = collocation.merged(collocation.stripes(texts, 0))
    hot = collocation.hot_prefixes(words, 20000)
    assert set(hot) == {("en", "hot"), ("en", "pair")} | {("en", f"w{i}") for i in range(997) if 4000 // 997 + (i < 12) > 20000 // 4096}
    pairs = collocation.stripes(texts, 1, hot).groupBy("prefix").agg(F.count_distinct("shard").alias("shards"))
    shards = {bytes(r[0]).decode(): r[1] for r in pairs.collect()}
    assert shards["pair"] > 500 and shards["other5"] == 1
    cells = {(r["prefix"], r["next"]): r["f"] for r in collocation.merged(collocation.stripes(texts, 1, hot)).collect()}
    assert cells["hot", "pair"] == 4000 and cells["pair", "w996"] == 4


def test_merging_adds_no_exchange(spark):
    plan = collocation.merged(collocation.stripes(spark.createDataFrame([("en", "a b")], SCHEMA), 1))._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1


def test_large_counts_are_exact(spark, monkeypatch):
    """Products past 64 bits: one stripe stands for 5 * 10^9 occurrences."""
    real = collocation.merged
    monkeypatch.setattr(collocation, "merged", lambda s: real(s).withColumn("f", F.col("f") * 500_000_003))
    rows = [("en", "a b c") for _ in range(10)] + [("en", "a x b")] * 3
    got = {r[2]: r[3:] for r in told(spark.createDataFrame(rows, SCHEMA))}
    m = 500_000_003
    assert got["a b c"] == (10 * m, 13 * m, 10 * m, 39 * m, 10**6 * 100 // 130)


def test_odd_tables(spark):
    assert told(spark.createDataFrame([], SCHEMA)) == []
    assert told(spark.createDataFrame([("en", None), (None, ""), ("de", "...")], SCHEMA)) == []
    rows = [(None, "same words here")] * 12 + [("en", "x" * 3_000_000 + " y")] * 2
    assert told(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_a_round_takes_little_memory():
    """A process of its own turns a full round of text into the stripes of each
    level: what that takes beside the text, in MB."""
    code = r"""
import re, numpy as np
from cohortlens.llm import collocation as c
peak = lambda: int(re.search(r"VmHWM:\s+(\d+)", open("/proc/self/status").read())[1]) // 1024
rng = np.random.RandomState(0)
words = [b"%x" % (i * 2654435761 % 2**25) for i in range(100_000)]
parts = []
while sum(map(len, parts)) < c.ROUND:
    parts.append(b" ".join(words[i] for i in np.minimum(rng.zipf(1.3, 20_000), len(words)) - 1))
before = peak()
found = [sum(b.column("counts").flatten().to_numpy().sum() for b in c.stripes_of(list(parts), "en", k, c.SHARES, {}, None)) for k in (0, 1, 2)]
print(peak() - before, *found, len(parts))
"""
    env = os.environ | {"PYTHONPATH": str(Path(collocation.__file__).parents[2])}
    said = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout.split()
    grown, *found, parts = map(int, said)
    assert found == [parts * (20_000 - k) for k in (0, 1, 2)]
    assert grown < 200
