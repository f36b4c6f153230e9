"""Sampled pieces of texts without spaces, long texts, other models."""

import base64
import os
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="tokenizer files not present")
KEY = np.array([5], np.uint64)


def plain_shares(text, model, names):
    """All segmentations of a text (as pieces' texts) and their shares."""
    text = "▁" + text.replace(" ", "▁")
    out = {}

    def grow(at, ids, weight):
        if at == len(text):
            out[tuple(ids)] = np.exp(weight)
            return
        if text[at] not in names:
            grow(at + 1, [*ids, text[at]], weight + model.unknown)
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in names:
                grow(end, [*ids, text[at:end]], weight + names[text[at:end]])

    grow(0, [], 0.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def names_of(model):
    out = {}
    for state in np.flatnonzero(model.piece >= 0).tolist():
        out[model.bytes[model.piece[state]].decode().replace(" ", "▁")] = float(model.weight[state])
    return out


def drawn(text, model, n):
    """Segmentations of ``n`` rows with the same text, as pieces' texts."""
    keys = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ids, counts = pieces.sample([text] * n, keys, model)
    starts, got = np.cumsum(counts) - counts, Counter()
    for s, c in zip(starts.tolist(), counts.tolist(), strict=True):
        got[tuple(model.bytes[i].decode().replace(" ", "▁") for i in ids[s : s + c].tolist())] += 1
    return got


def assert_drawn(text, model):
    n, want = 30_000, plain_shares(text, model, names_of(model))
    got = drawn(text, model, n)
    assert set(got) <= set(want)
    for k, p in want.items():
        assert abs(got[k] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


@pytest.mark.parametrize("text", ["on\nin", "no\n\nat", "x=in;", "aaaa"])
def test_cut_lattices_keep_the_distribution(text):
    assert_drawn(text, pieces.load(pieces.MODEL, 0.6))


def test_long_texts_without_spaces_take_seconds():
    rng = random.Random(1)
    model = pieces.load(pieces.MODEL)
    million = 1_000_000
    for text in (
        "a" * million,
        base64.b64encode(rng.randbytes(750_000)).decode(),
        "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(million)),
        "\n".join("".join(rng.choices("etaoinshr", k=rng.randint(1, 9))) for _ in range(million // 6)),
    ):
        began = time.time()
        ids, counts = pieces.sample([text], KEY, model)
        assert time.time() - began < 60
        assert pieces.decoded(ids, counts, model)[0].as_py() == text


def test_slices_and_single_parts_agree(monkeypatch):
    """The forward and backward pass of parts that outlast the others, done one
    by one, and texts in blocks, draw what the passes over all do."""
    model = pieces.load(pieces.MODEL)
    text = "a" * 9000 + " the " + "ab" * 9000 + "\nlast words"
    monkeypatch.setattr(pieces, "FEW", 0)
    want, _ = pieces.sample([text], KEY, model)
    monkeypatch.setattr(pieces, "FEW", 6)
    got, _ = pieces.sample([text], KEY, model)
    assert np.array_equal(got, want)
    prose = "Some words, and\nothers  here ▁ 漢字. " * 300 + "x" * 500
    want, _ = pieces.sample([prose], KEY, model)
    monkeypatch.setattr(pieces, "SLAB", 700)
    assert np.array_equal(pieces.sample_long(prose, KEY, model), want)


class OtherModel:
    """A model with probabilities of its own, and a piece with a space inside."""

    PIECES = [("<unk>", 0.0), ("▁", -2.5), ("a", -1.25), ("b", -3.5), ("▁a", -2.25), ("a▁b", -2.75), ("ab", -4.5)]

    def __init__(self, model_file):
        pass

    def get_piece_size(self):
        return len(self.PIECES)

    def id_to_piece(self, i):
        return self.PIECES[i][0]

    def get_score(self, i):
        return self.PIECES[i][1]

    def is_unknown(self, i):
        return i == 0

    is_byte = is_control = is_unused = lambda self, i: False


def test_a_model_s_own_probabilities_and_inner_spaces(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", OtherModel)
    model = pieces.Pieces("other", 1.0)
    assert not model.spaces_lead
    assert names_of(model)["a▁b"] == pytest.approx(-2.75)
    assert ("▁", "a▁b") in plain_shares("a b", model, names_of(model))
    assert_drawn("a b", model)
    assert_drawn("aba b", model)


def test_long_rows_and_clashing_columns(spark):
    rows = [(1, "no space" + "x1\n" * 1_200_000), (2, "short"), (3, None), (4, "漢" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("row", "key", "ids")})
    out = pieces.decode(pieces.encode(df, carry=["doc_id", "row", "ids"])).collect()
    assert {r["row"]["doc_id"]: r["text"] for r in out} == {i: t or "" for i, t in rows}
    assert all(r["row"]["row"] == r["row"]["ids"] == "?" for r in out)


def test_a_worker_s_memory_and_ids_by_slabs():
    """Texts of mostly new words, as much as one slab once held: two tasks' workers and the heap share an executor."""
    rng, model = random.Random(3), pieces.load(pieces.MODEL)
    texts = [" ".join("".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(300)) for _ in range(1500)]
    keys = np.arange(1, len(texts) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole, sizes = pieces.sample(texts, keys, model)
    got, counts = [], []
    tracemalloc.start()
    try:
        for part in pieces._slabs(np.array([len(t) for t in texts])):
            ids, n = pieces.sample(texts[part], keys[part], model)
            got.append(ids)
            counts.append(n)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(np.concatenate(got), whole) and np.array_equal(np.concatenate(counts), sizes)
    assert peak < 160 << 20
