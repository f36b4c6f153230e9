"""Repair of conversation structure: the cheapest edits that make the turns of a
conversation read ``(system? (user assistant)+)?``.

Each turn has at most one fault, the first that holds: blank (no character but
white space), duplicate (role and text seen earlier in the conversation),
truncated (the last character that isn't white space is none of ``.!?``). Edits
and costs: Keep 0, Rerole to user or assistant 2, Delete 3 (blank and duplicate
turns must go), Insert an empty user or assistant turn 2; a truncated turn that
stays adds 1. Of several cheapest edits the ones whose initials are least in
ASCII order (Delete, Insert, Keep, Rerole) are taken.

The grammar has four states (start, system, user, assistant), so the cost of
the best repair of what is left is a vector of four numbers. A conversation of
n turns is cut into blocks of sqrt(n) turns (at least ``LEAST_BLOCK``). State
cost vectors are kept only at block ends, the checkpoints:

1. each block by itself: its costs from every state to every state;
2. backward over a conversation's blocks: the vector at each block's end;
3. each block by itself, between its checkpoint and its turns: the vectors
   inside are computed again, and a walk forward along tight edits from each
   state gives the state it ends in;
4. forward over the blocks: the state that each block starts in;
5. each block by itself: the walk from that state, its edits written down.

Steps 1, 3 and 5 run in as many tasks as there are blocks to deal out; steps 2
and 4 stream over a conversation's blocks, so a conversation that holds a third
of all turns costs one task the square root of its turns, and nobody holds more
than a block. Turns travel through the steps as one letter each.

Nulls and odd rows: a null role or text is one space; a null conversation is a
conversation; turns without number come first. Turns of the same number are
taken by role, then text. A role counts by its first character; one that is
neither s, u nor a (or empty) can only be reroled or deleted. A conversation
has at most 2^31 turns. Columns beside the four named ones are ignored,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written
from cohortlens.operators.windows import rank_events

LEAST_BLOCK = 64
START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 50
#: What an inserted or reroled turn leads to, from each state.
_NEXT = (USER, USER, ASSISTANT, USER)
#: What a kept turn leads to, by state and by the class of its role (s, u, a, other).
_KEEP = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
_KEEP_COST, _REROLE, _DELETE, _INSERT = 0, 2, 3, 2
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: A turn's letter: A + 3 * class of role + (0 as it is, 1 truncated, 2 must go).
_TURN = {chr(65 + 3 * c + m): (c, m) for c in range(4) for m in range(3)}


def _with_inserts(v: list[int]) -> list[int]:
    """Costs when turns may be inserted first."""
    user, assistant = min(v[USER], v[ASSISTANT] + _INSERT), min(v[ASSISTANT], v[USER] + _INSERT)
    return [min(v[START], user + _INSERT), min(v[SYSTEM], user + _INSERT), user, assistant]


def _before(letter: str, after: list[int]) -> list[int]:
    """Costs before a turn from the costs after it."""
    role, mode = _TURN[letter]
    out = []
    for state in range(4):
        best = _DELETE + after[state]
        if mode < 2:
            kept = _KEEP[state][role]
            if kept is not None:
                best = min(best, _KEEP_COST + mode + after[kept])
            best = min(best, _REROLE + mode + after[_NEXT[state]])
        out.append(best)
    return _with_inserts(out)


#: After the last turn: the grammar ends in start or assistant.
END = _with_inserts([0, _FAR, _FAR, 0])


def _vectors(codes: str, after: list[int]) -> list[list[int]]:
    """Costs before each turn of a block and after the last."""
    out = [after]
    for letter in reversed(codes):
        out.append(_before(letter, out[-1]))
    return out[::-1]


def transfer(codes: str) -> list[int]:
    """Costs from each state before a block to each state after it, 4 x 4."""
    columns = [_vectors(codes, [0 if s == to else _FAR for s in range(4)])[0] for to in range(4)]
    return [columns[to][state] for state in range(4) for to in range(4)]


def apply_transfer(matrix: list[int], after: list[int]) -> list[int]:
    return [min(matrix[4 * state + to] + after[to] for to in range(4)) for state in range(4)]


def walk(codes: str, state: int, after: list[int], last: bool) -> tuple[int, list[tuple[str, int, str | None]]]:
    """From ``state`` forward along the least tight edits: the state after the
    block, and per edit its initial, the turn's place in the block (from 1; 0:
    inserted) and the new role, if any."""
    vectors, edits = _vectors(codes, after), []
    for i, letter in enumerate(codes):
        role, mode = _TURN[letter]
        now, then = vectors[i], vectors[i + 1]
        while True:
            to = _NEXT[state]
            if _DELETE + then[state] == now[state]:
                edits.append(("D", i + 1, None))
            elif _INSERT + now[to] == now[state]:
                edits.append(("I", 0, _ROLE[to]))
                state = to
                continue
            elif mode < 2 and (kept := _KEEP[state][role]) is not None and mode + then[kept] == now[state]:
                edits.append(("K", i + 1, None))
                state = kept
            else:
                edits.append(("R", i + 1, _ROLE[to]))
                state = to
            break
    while last and state in (SYSTEM, USER):
        state = _NEXT[state]
        edits.append(("I", 0, _ROLE[state]))
    return state, edits


def _illegal(codes: str) -> int:
    roles = [_TURN[x][0] for x in codes]
    return sum(pair not in _LEGAL for pair in zip(roles, roles[1:], strict=False))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield pa.RecordBatch.from_pylist(part, schema)
            part = []
    yield pa.RecordBatch.from_pylist(part, schema)


def _mapped(df: DataFrame, function, columns: str) -> DataFrame:
    """``function`` over the rows of each task as dicts, streamed; the result
    has ``conv``, ``block`` and ``columns``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType([df.schema["conv"], df.schema["block"], *StructType.fromDDL(columns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(function(_rows(batches)), to_arrow_schema(schema))

    return df.mapInArrow(run, schema)


def marked_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv (a struct of the conversation's id), turn, role, text, place (from
    1), n (turns of the conversation) and fault (0 none, 1 blank, 2 duplicate,
    3 truncated)."""
    rows = turns.select(
        F.struct(F.col(f"`{conv_col}`").alias("id")).alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
    )
    placed = written(rank_events(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "place", size="n"), "repair-turns")
    # joined back by place: however often a text repeats, keys stay unique
    first = placed.groupBy("conv", "role", "text").agg(F.min("place").alias("place")).select("conv", "place", F.lit(True).alias("is_first"))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), 1)
        .when(F.col("is_first").isNull(), 2)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3)
        .otherwise(0)
    )
    return placed.join(first, ["conv", "place"], "left").select("conv", "turn", "role", "text", "place", "n", fault.alias("fault"))


def blocks(marked: DataFrame) -> DataFrame:
    """One row per block: its turns in order, their letters, how many blocks
    the conversation has, and the block's faults."""
    length = F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.sqrt("n")).cast("int"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    mode = F.when(F.col("fault") == 3, 1).when(F.col("fault") > 0, 2).otherwise(0)
    rows = marked.select(
        "conv",
        F.floor((F.col("place") - 1) / length).cast("int").alias("block"),
        F.ceil(F.col("n") / length).cast("int").alias("n_blocks"),
        "fault",
        F.struct("place", F.char(65 + 3 * role + mode).alias("letter"), "role", "text").alias("turn"),
    )
    counts = [F.count_if(F.col("fault") == k).alias(name) for k, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))]
    grouped = rows.groupBy("conv", "block").agg(F.max("n_blocks").alias("n_blocks"), F.sort_array(F.collect_list("turn")).alias("turns"), *counts)
    return written(grouped.withColumn("codes", F.array_join("turns.letter", "")), "repair-blocks")


def _transfers(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        roles = _TURN[r["codes"][0]][0], _TURN[r["codes"][-1]][0]
        yield {"conv": r["conv"], "block": r["block"], "costs": transfer(r["codes"]), "first": roles[0], "last": roles[1], "illegal": _illegal(r["codes"])}


def _checkpoints(rows: Iterator[dict]) -> Iterator[dict]:
    """Over each conversation's blocks, last one first."""
    conv, after = object(), END
    for r in rows:
        if r["conv"] != conv:
            conv, after = r["conv"], END
        before = apply_transfer(r["costs"], after)
        yield {"conv": conv, "block": r["block"], "after": after, "cost": before[START] if r["block"] == 0 else 0,
               "first": r["first"], "last": r["last"], "illegal": r["illegal"]}
        after = before


def _exits(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        last = r["block"] == r["n_blocks"] - 1
        out = [walk(r["codes"], state, r["after"], last)[0] if r["block"] or not state else START for state in range(4)]
        yield {k: r[k] for k in ("conv", "block", "after", "cost", "first", "last", "illegal")} | {"exits": out}


def _entries(rows: Iterator[dict]) -> Iterator[dict]:
    """Over each conversation's blocks, first one first."""
    conv, state, role = object(), START, None
    for r in rows:
        if r["conv"] != conv:
            conv, state, role = r["conv"], START, None
        crossing = role is not None and (role, r["first"]) not in _LEGAL
        yield {"conv": conv, "block": r["block"], "after": r["after"], "cost": r["cost"], "entry": state, "illegal": r["illegal"] + crossing}
        state, role = r["exits"][state], r["last"]


def _edits(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        edits = walk(r["codes"], r["entry"], r["after"], r["block"] == r["n_blocks"] - 1)[1]
        steps = [{"edit": e, "at": at, "role": role} for e, at, role in edits]
        yield {"conv": r["conv"], "block": r["block"], "cost": r["cost"], "illegal": r["illegal"], "steps": steps}


def repair(cut: DataFrame) -> DataFrame:
    """One row per block of ``blocks``: conv, block, audit (initials of its
    edits), turns (the repaired ones: role, text), cost (of the whole
    conversation, in its first block; else 0), illegal (adjacent roles that the
    grammar doesn't have, the one before the block's first turn included) and
    the block's faults blank, duplicate, truncated."""
    letters = cut.select("conv", "block", "n_blocks", "codes")
    chained = "cost long, first int, last int, illegal long"
    costs = _mapped(letters, _transfers, "costs array<long>, first int, last int, illegal long")
    ends = _mapped(costs.repartition("conv").sortWithinPartitions("conv", F.desc("block")), _checkpoints, f"after array<long>, {chained}")
    exits = _mapped(letters.join(ends, ["conv", "block"]), _exits, f"after array<long>, {chained}, exits array<int>")
    entries = _mapped(exits.repartition("conv").sortWithinPartitions("conv", "block"), _entries, "after array<long>, cost long, entry int, illegal long")
    steps = _mapped(letters.join(entries, ["conv", "block"]), _edits, "cost long, illegal long, steps array<struct<edit string, at int, role string>>")
    repaired = F.expr(
        """transform(filter(steps, s -> s.edit != 'D'), s -> if(s.at > 0,
            struct(coalesce(s.role, turns[s.at - 1].role) as role, turns[s.at - 1].text as text), struct(s.role as role, '' as text)))"""
    )
    return cut.join(steps, ["conv", "block"]).select(
        "conv", "block", F.array_join("steps.edit", "").alias("audit"), repaired.alias("turns"), "cost", "illegal", "blank", "duplicate", "truncated"
    )


def digests(repaired: DataFrame) -> DataFrame:
    """Per conversation: audit, repaired_sha256 (of ``role:text`` lines joined
    by newlines), cost, illegal, blank, duplicate, truncated. A digest needs its
    conversation's text in order: it streams through one task, block by block."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    counts = ["cost", "illegal", "blank", "duplicate", "truncated"]
    # an empty text may be one empty line or none: the number of turns tells
    rows = repaired.select("conv", "block", "audit", lines.alias("lines"), F.size("turns").alias("n"), *counts)

    def told(rows: Iterator[dict]) -> Iterator[dict]:
        conv, sha, audit, total, begun = None, None, [], {}, False
        for r in rows:
            if sha is None or r["conv"] != conv:
                if sha is not None:
                    yield {"conv": conv, "block": 0, "audit": "".join(audit), "repaired_sha256": sha.hexdigest(), **total}
                conv, sha, audit, total, begun = r["conv"], hashlib.sha256(), [], dict.fromkeys(counts, 0), False
            audit.append(r["audit"])
            for name in counts:
                total[name] += r[name]
            if r["n"]:
                sha.update((("\n" if begun else "") + r["lines"]).encode())
                begun = True
        if sha is not None:
            yield {"conv": conv, "block": 0, "audit": "".join(audit), "repaired_sha256": sha.hexdigest(), **total}

    streamed = rows.repartition("conv").sortWithinPartitions("conv", "block")
    return _mapped(streamed, told, "audit string, repaired_sha256 string, " + ", ".join(f"{c} long" for c in counts)).drop("block")


def turn_gaps(marked: DataFrame) -> DataFrame:
    """Per conversation: turn numbers missing between its least and greatest."""
    numbers = marked.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("copies"))
    high, low, held = (f(F.col("turn").cast("decimal(20,0)")) for f in (F.max, F.min, F.count))
    gaps = F.coalesce(high - low + 1 - held, F.lit(0))
    return numbers.groupBy("conv").agg(F.least(gaps, F.lit(2**63 - 1)).cast("long").alias("gaps"))
