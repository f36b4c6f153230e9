"""Chat formatting, in Spark expressions only.

A conversation's turns are collected as structs and sorted; runs of turns with
one role become one block, its texts joined by a separator; blocks are
concatenated:

    <|im_start|>ROLE<|im_body|>TEXT[<|im_sep|>TEXT...]<|im_end|>\\n

Inside roles and texts a control string gets one backslash after its first
character (``</s>`` becomes ``<\\/s>``, and ``<\\/s>`` becomes ``<\\\\/s>``), so
no text can end a turn or open one, and ``unescaped`` gives back the text.
``segments`` is the output with its loss mask: consecutive pieces of the
formatted text with a flag; only texts of assistant turns are under the mask.

Nulls and odd rows: a null text or role is an empty one; rows without a
conversation id form one conversation with a null id; turns with equal numbers
follow by role, then by text (a null number comes first), so repeated rows stay
as repeated turns. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BODY, SEP, END = "<|im_start|>", "<|im_body|>", "<|im_sep|>", "<|im_end|>\n"
#: What a control string has after ``<`` or ``[`` and any backslashes.
_AFTER = r"(?:\|im_(?:start|body|sep|end)\|>|/?s>)"
_AFTER_SQUARE = r"/?INST\]"
_PLAIN = rf"(<(?=\\*{_AFTER})|\[(?=\\*{_AFTER_SQUARE}))"
_ESCAPED = rf"(?:(<)\\(?=\\*{_AFTER})|(\[)\\(?=\\*{_AFTER_SQUARE}))"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, _PLAIN, r"$1\\")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "$1$2")


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, formatted, segments array<struct<text, loss>>) per conversation."""
    clean = turns.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    # sorted by the unescaped strings; what is formatted comes last in the struct
    turn = F.struct("turn", "role", "text", escaped(F.col("role")).alias("safe_role"), escaped(F.col("text")).alias("safe"))
    chats = clean.groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    chats = chats.withColumn("starts", F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 or turns[i].role <> turns[i - 1].role)"))
    blocks = chats.withColumn(
        "blocks",
        F.expr("transform(starts, (s, k) -> slice(turns, s + 1, coalesce(get(starts, k + 1), size(turns)) - s))"),
    )
    pieces = f"""
        flatten(transform(blocks, b -> flatten(array(
            array(struct(concat('{START}', b[0].safe_role, '{BODY}') as text, false as loss)),
            flatten(transform(b, (t, i) -> if(i = 0,
                array(struct(t.safe as text, t.role = 'assistant' as loss)),
                array(struct('{SEP}' as text, false as loss), struct(t.safe as text, t.role = 'assistant' as loss))))),
            array(struct('{END}' as text, false as loss))))))"""
    out = blocks.select("conv", F.expr(pieces).alias("segments"))
    return out.select("conv", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role_and_body = F.split(F.substr(block, F.lit(len(START) + 1)), r"<\|im_body\|>")
        return F.transform(
            F.split(role_and_body[1], r"<\|im_sep\|>"),
            lambda t: F.struct(unescaped(role_and_body[0]).alias("role"), unescaped(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
