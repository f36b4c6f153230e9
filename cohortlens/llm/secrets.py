"""Secret scan with an incremental blob ledger, in Spark expressions only.

Every version of every document is content-addressed: its blob id is the
SHA-256 of its text. The ledger says which (blob, rule, version) have been
scanned; a run scans a blob only for those rules whose current version the
ledger lacks for it, one scan however many paths hold the blob. Findings are
kept per blob and joined back to all paths.

Ledger and findings are one log, a table that runs append to: a row without
span is the ledger's entry for its (blob, rule, version), the rows with spans
are its findings. Entry and findings come from the same window partition, thus
stand in the same file. A run that dies while it publishes leaves whole files
or none, and the next run scans what is still without entry. Runs at the same
time may log a pair twice; readers take distinct rows.

Positions come from splitting: the text between matches and the matches
themselves alternate, so running sums of their lengths give each span, in code
points, end exclusive.

Nulls and odd rows: a null text is an empty one and has no findings. Paths may
be null or repeated; every input row gets its blob's findings. Very long texts
are cut into matches and gaps, so that no expression is quadratic in them. The
input's columns travel in the struct ``row`` and can't clash with the names
used here. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.common import packed, written


def either_case(words: str) -> str:
    """A pattern that takes the ASCII letters of ``words`` in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its group ``group`` has at least
    ``least`` characters. A change of the pattern needs a new version."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", 1, f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    # in these two the least length stands in the pattern: a match takes its
    # whole run, and no longer one can begin inside a run that is too short
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
    # beyond the base kinds
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("host", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE = ("assign", "access", "hex")

LEDGER = "blob string, rule string, version int"
FINDINGS = "blob string, rule string, version int, start int, `end` int"


def entries(log: DataFrame) -> DataFrame:
    """The ledger in a log: what has been scanned."""
    return log.where("start is null").select("blob", "rule", "version").distinct()


def findings(log: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The findings in a log, of the rules' current versions."""
    return log.where("start is not null").where(_current(rules)).distinct()


def _key(rule: Rule) -> str:
    return f"{rule.kind}:{rule.version}"


def _current(rules: tuple[Rule, ...]) -> str:
    return " or ".join(f"(rule = '{r.kind}' and version = {r.version})" for r in rules)


def addressed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, blob, text): every path with the id of its content."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return packed(docs, blob=F.sha2(text, 256), text=text)


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, text, todo): each blob once, with the rules to run on it; blobs
    that the ledger has for all current rules are left out."""
    every = F.array(*[F.lit(_key(r)) for r in rules])
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))  # copies end here, before they meet the ledger
    if ledger is None:
        return blobs.withColumn("todo", every)
    current = ledger.where(_current(rules)).select("blob", F.concat_ws(":", "rule", "version").alias("key"))
    seen = current.groupBy("blob").agg(F.collect_set("key").alias("seen"))
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0).select("blob", "text", "todo")


def _matches(rule: Rule) -> str:
    """SQL for an array of (gap, whole, counted): code points before a match
    since the last one, in it, and in its counted group. The last entry is the
    text after the last match, without match; null if the rule isn't to run."""
    p = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    counted = f"regexp_extract_all(text, '{p}', {rule.group})"
    whole = f"regexp_extract_all(text, '{p}', 0)"
    lengths = f"zip_with({whole}, {counted}, (w, c) -> struct(char_length(w) as whole, char_length(c) as counted))"
    found = f"zip_with(split(text, '{p}'), {lengths}, (g, m) -> struct(char_length(g) as gap, m.whole as whole, m.counted as counted))"
    none = "array(struct(cast(null as int) as gap, cast(null as int) as whole, cast(null as int) as counted))"
    return f"if(array_contains(todo, '{_key(rule)}'), if(text rlike '{p}', {found}, {none}), null)"


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The log (blob, rule, version, start, end) of scanning (blob, text,
    todo): an entry per pair scanned, without span, and its findings."""
    kinds = F.array(
        *[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"), F.expr(_matches(r)).alias("found")) for r in rules]
    )
    found = blobs.select("blob", F.inline(kinds)).where("found is not null")
    parts = found.select("blob", "rule", "version", "least", F.posexplode("found").alias("i", "m"))
    before = Window.partitionBy("blob", "rule").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.whole")).over(before).cast("int")
    return (
        parts.withColumn("end", F.when(F.col("m.whole").isNotNull(), end))
        .where("m.whole is null or m.counted >= least")
        .select("blob", "rule", "version", (F.col("end") - F.col("m.whole")).alias("start"), "end")
    )


def scan_versions(
    docs: DataFrame, text_col: str = "text", ledger: DataFrame | None = None, earlier: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One incremental run over the versions in ``docs``: the paths (row,
    blob), all current findings, and the ledger entries that the run adds.
    ``ledger`` and ``earlier`` are what former runs returned, added up."""
    versions = addressed(docs, text_col)
    log = written(scan(unseen(versions, ledger, rules), rules), "secret-log")
    found = findings(log if earlier is None else log.unionByName(earlier), rules)
    return versions.select("row", "blob"), found, entries(log)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log kept in ``folder``, an empty one at first."""
    spark.createDataFrame([], FINDINGS).write.mode("ignore").parquet(folder)
    return spark.read.schema(FINDINGS).parquet(folder)


def scan_into(folder: str, docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """One incremental run with the log kept in ``folder``: scans the pairs
    that it lacks and appends them. Gives the paths (row, blob) and all
    current findings of the log, former runs' included."""
    spark = docs.sparkSession
    versions = addressed(docs, text_col)
    fresh = unseen(versions, entries(read_log(spark, folder)), rules)
    scan(fresh, rules).write.mode("append").option("compression", "zstd").parquet(folder)
    return versions.select("row", "blob"), findings(read_log(spark, folder), rules)


def by_path(paths: DataFrame, found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, blob, spans): every path with its blob's findings (start, end,
    rule), by start, then by the rules' order; null where there are none."""
    order = F.expr("case rule " + " ".join(f"when '{r.kind}' then {i}" for i, r in enumerate(rules)) + " end")
    per_blob = found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", order.alias("place"), "end", "rule"))).alias("spans"))
    return paths.join(written(per_blob, "blob-findings"), "blob", "left")
