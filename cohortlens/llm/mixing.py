"""Mixing sources to target weights: hierarchical budgets.

Leaves are the distinct (domain, language, source) of the documents. A leaf can
give its tokens ``max_epochs`` times. The total budget goes down the tree: at
each level a parent's budget is split among its children by weight, but none
gets more than its subtree can give; what it can't take goes to its siblings by
weight, and only if all of them are full does the shortage show at the level
above, since a parent's capacity is its children's sum. This water-filling has
a closed form over the children sorted by capacity per weight, so a level is
one window over one row per child.

A leaf's budget is whole epochs and a rest. An epoch's order is that of
``md5(seed:epoch:id)``, new for each epoch; the rest takes the order's prefix
whose tokens fit. The first three hexadecimal digits split an epoch into 4096
bins: bins before the one where the budget ends go whole, by sums per bin, and
only that one bin is ordered row by row. No leaf, however large, is sorted in
one task.

Nulls and odd rows: null levels form leaves of their own. Null or empty texts
have no tokens and go with the prefix that reaches them. Documents with null
ids share one place in the order. Equal rows are equal documents; each is
counted. Weights not given are ``1``; a weight of 0 leaves a child out. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.common import packed, written

LEVELS = ("domain", "lang", "source")
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0)))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    given = weights.get(level, {})
    out = F.lit(given.get("*", 1))
    for name, w in given.items():
        if name != "*":
            out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _level(children: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """``budget`` of each child from its ``weight``, ``capacity`` and the
    parent's ``parent_budget``. With children in the order of capacity per
    weight, those are full that come before the first whose share of what is
    left is under its capacity."""
    rising = Window.partitionBy(*parent).orderBy("fill", *LEVELS[: len(parent) + 1])
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    d = children.where("weight > 0").withColumn("fill", F.col("capacity") / F.col("weight"))
    d = d.withColumn("left", F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    d = d.withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    wide = "decimal(38,0)"
    share = F.expr(f"cast(greatest(left, 0) as {wide}) * cast(weight as decimal(18,0))")
    # capacity <= left * weight / weight_left, in whole numbers
    d = d.withColumn("full", F.expr("cast(capacity as decimal(20,0)) * cast(weight_left as decimal(18,0))") <= share)
    d = d.withColumn("first_open", F.min(F.when(~F.col("full"), F.struct("fill", *LEVELS[: len(parent) + 1], "left", "weight_left"))).over(whole))
    open_share = F.expr(f"cast(cast(greatest(first_open.left, 0) as decimal(20,0)) * cast(weight as decimal(18,0)) div first_open.weight_left as long)")
    return d.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(open_share)).drop("fill", "left", "weight_left", "full", "first_open")


def leaf_budgets(leaves: DataFrame, total: int | Column, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source,
    tokens). ``total`` is a number of tokens."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    top = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    top = top.withColumn("weight", _weight("domain", weights)).withColumn("parent_budget", F.lit(total).cast("long"))
    budget = _level(top, ())
    for depth in (2, 3):
        keys, upper = LEVELS[:depth], LEVELS[: depth - 1]
        children = leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(keys[-1], weights)).alias("c")
        over = budget.select(*upper, F.col("budget").alias("parent_budget")).alias("p")
        same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in upper]
        budget = _level(children.join(over, same).select("c.*", "p.parent_budget"), upper)
    return budget.withColumn("tokens", F.expr(f"capacity div {max_epochs}")).select(*LEVELS, "tokens", "budget")


def mix(
    docs: DataFrame,
    weights: dict[str, dict[str, int]],
    domain: Column,
    share: float = 1.0,
    max_epochs: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The chosen documents, once per epoch that takes them: ``row`` (the input
    row), ``doc``, the three levels, ``n_tokens`` and ``epoch``. The total
    budget is ``share`` of the input's tokens."""
    rows = packed(
        docs, doc=F.col(id_col), domain=domain, lang=F.col(lang_col), source=F.col(source_col), n_tokens=word_count(F.col(text_col)).cast("long")
    )
    small = written(rows.select("doc", *LEVELS, "n_tokens"), "mix-tokens")
    leaves = written(small.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = leaf_budgets(leaves, int(total * share), weights, max_epochs)
    budgets = budgets.select(
        *LEVELS,
        F.expr("cast(if(tokens > 0, budget div tokens, 0) as int)").alias("epochs"),
        F.expr("if(tokens > 0, budget % tokens, 0)").alias("rest"),
    )
    budgets = written(budgets.where("epochs > 0 or rest > 0"), "mix-budgets")

    def with_budget(frame: DataFrame, found: DataFrame) -> DataFrame:
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in LEVELS]
        return frame.alias("r").join(found.alias("b"), same).select("r.*", *[f"b.{c}" for c in found.columns if c not in LEVELS])

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc").cast("string"), F.lit(""))).cast("binary"))
    bin_of = F.conv(F.substring("order", 1, 3), 16, 10).cast("int")

    # sums per bin, then the bin where each leaf's rest ends
    bins = with_budget(small, budgets.where("rest > 0")).withColumn("order", order).withColumn("bin", bin_of)
    bins = bins.groupBy(*LEVELS, "rest", "bin").agg(F.sum("n_tokens").alias("tokens"))
    upto = Window.partitionBy(*LEVELS).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("end", F.sum("tokens").over(upto)).where("end > rest")
    edge = bins.groupBy(*LEVELS).agg(F.min(F.struct("bin", (F.col("rest") - (F.col("end") - F.col("tokens"))).alias("fits"))).alias("e"))
    edge = written(with_budget(budgets, edge.select(*LEVELS, F.col("e.bin").alias("edge"), "e.fits")), "mix-edges")

    # in that bin, the last place in the order whose prefix fits; equal places go together
    inside = with_budget(small, edge).withColumn("order", order).where(bin_of == F.col("edge"))
    upto = Window.partitionBy(*LEVELS).orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("sum", F.sum("n_tokens").over(upto)).where("sum <= fits")
    cuts = edge.select(*LEVELS, "epochs", "edge").unionByName(inside.groupBy(*LEVELS, "epochs", "edge").agg(F.max("order").alias("cut")), True)
    cuts = cuts.unionByName(budgets.where("rest = 0").select(*LEVELS, "epochs"), True)
    plan = written(cuts.groupBy(*LEVELS, "epochs").agg(F.max("edge").alias("edge"), F.max("cut").alias("cut")), "mix-plan")

    chosen = with_budget(rows, plan).withColumn("order", order)
    begins = (bin_of < F.col("edge")) | (F.col("order") <= F.col("cut"))
    times = F.col("epochs") + F.when(begins, 1).otherwise(0)
    return chosen.withColumn("times", times).where("times > 0").select(
        "row", "doc", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch")
    )
