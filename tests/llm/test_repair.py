"""Conversation repair against an exhaustive search over edits."""

import hashlib
import heapq
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """The first complete repair when partial ones are taken by (cost, audit)."""
    faults = plain_faults(rows)
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(lines)
        if not re.fullmatch("s?(ua)*u?", roles):
            continue
        for r in ("user", "assistant"):
            if len(roles) <= 2 * len(rows) + 2:
                heapq.heappush(heap, (cost + 2, audit + "I", i, roles + r[0], (*lines, r + ":")))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + (role[:1] or "?"), (*lines, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 2, audit + "R", i + 1, roles + r[0], (*lines, f"{r}:{text}")))


def plain(turns):
    """What the operator tells of (conv, turn, role, text) rows."""
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in convs.items():
        rows.sort()
        numbers = {t for known, t, _, _ in rows if known}
        pairs = [(r, x) for _, _, r, x in rows]
        faults = plain_faults(pairs)
        cost, audit, text = plain_repair(pairs)
        adjacent = [a[0][:1] + b[0][:1] for a, b in zip(pairs, pairs[1:], strict=False)]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a not in ("su", "ua", "au") for a in adjacent), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def told(turns):
    marked = repair.marked_turns(turns)
    out = repair.digests(repair.repair(repair.blocks(marked))).join(repair.turn_gaps(marked), "conv")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv"]["id"]: tuple(r[n] for n in names) for r in out.collect()}


def random_turns(rng, conv, n, roles=("user", "assistant", "system", "user", "assistant", "tool", "", None)):
    texts = ["Yes.", "No", "ok!", " ", "", "why? ", None, "a.\n", "x" * 3, "b . \t", "ü."]
    return [(conv, int(rng.randint(0, n + 2)) if rng.rand() > 0.05 else None, roles[rng.randint(len(roles))], texts[rng.randint(len(texts))] if rng.rand() < 0.5 else f"t{rng.randint(99)}.") for _ in range(n)]


@pytest.mark.parametrize("block", [64, 2])
def test_repairs_against_search(spark, monkeypatch, block):
    """Blocks of 64 turns, and of two (many checkpoints in each conversation)."""
    monkeypatch.setattr(repair, "LEAST_BLOCK", block)
    rng = np.random.RandomState(block)
    turns = [t for conv in range(60) for t in random_turns(rng, conv if conv else None, rng.randint(1, 7))]
    df = spark.createDataFrame(turns, SCHEMA).repartition(3)
    assert told(df) == plain(turns)


def test_costs_of_a_block_follow_from_its_halves():
    rng = np.random.RandomState(5)
    for _ in range(50):
        codes = "".join(rng.choice(list("ABCDEFGHIJKL"), rng.randint(2, 30)))
        cut = rng.randint(1, len(codes))
        halves = repair.apply_transfer(repair.transfer(codes[:cut]), repair.apply_transfer(repair.transfer(codes[cut:]), repair.END))
        assert halves == repair._vectors(codes, repair.END)[0]


def test_one_long_conversation(spark):
    """A conversation of thousands of turns beside short ones: blocks of about
    the square root, the same result as one pass over all turns."""
    rng = np.random.RandomState(7)
    long = [(1, i, ("user", "assistant")[rng.randint(2)], f"t{rng.randint(3000)}" + (".", "")[int(rng.rand() < 0.1)]) for i in range(9000)]
    short = [t for conv in range(2, 40) for t in random_turns(rng, conv, 4)]
    marked = repair.marked_turns(spark.createDataFrame(long + short, SCHEMA).repartition(4))
    cut = repair.blocks(marked)
    sizes = [r[0] for r in cut.where("conv.id = 1").select(F.size("turns")).collect()]
    assert len(sizes) == 95 and max(sizes) == 95
    got = repair.digests(repair.repair(cut)).where("conv.id = 1").first()
    codes = "".join(r["codes"] for r in cut.where("conv.id = 1").orderBy("block").collect())
    edits = repair.walk(codes, repair.START, repair.END, True)[1]
    assert got["audit"] == "".join(e for e, _, _ in edits)
    assert got["cost"] == repair._vectors(codes, repair.END)[0][repair.START]
    assert got["illegal"] == repair._illegal(codes)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert told(empty) == {}
    rows = [(1, 2**63 - 1, "user", "a."), (1, -(2**63), "assistant", "b."), (2, None, None, None), (3, 5, "user", "long. " * 200_000), (4, 1, "user", "x."), (4, 1, "user", "x.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "block", "n", "place", "codes")})
    got = told(df)
    assert got[1][0] == 2**63 - 1
    assert got[2] == (0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())
    assert got[3][6] == "KI" and got[4][2] == 1 and got[4][6] == "KDI"


def test_damage_and_query(spark, scratch):
    rng = np.random.RandomState(11)
    turns = [(c, i, ("user", "assistant")[i % 2], f"What is {rng.randint(50)}? So.") for c in range(300) for i in range(rng.randint(1, 6))]
    turns += [(None, 0, "user", "hi."), (900, None, None, None)]
    spark.createDataFrame(turns, SCHEMA).write.parquet(f"{scratch}/conversations.parquet")
    from zlib import crc32

    damaged = []
    for conv, turn, role, text in turns:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    expected = plain(damaged)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv_id"]: tuple(r[n] for n in names) for r in queries.op11_conversation_repair(spark, scratch).collect()}
    assert got == {c: expected.get(c, nothing) for c in {t[0] for t in turns}}
    assert nothing in got.values()
