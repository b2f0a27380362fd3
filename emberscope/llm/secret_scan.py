"""Secret scans over an incremental ledger of blobs.

Every version of every text is a blob named by its SHA-256. The ledger lists the pairs of
blob and rule version that were scanned; only other pairs are scanned, and findings are
joined back to all paths (here document ids) that hold or held the blob. Rules are regular
expressions in a declared order; matches of a rule are leftmost and do not overlap.
Positions are code points, end exclusive.

Null text counts as empty. Repeated rows and null ids are paths like others, tables may be
empty, extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of


@dataclass(frozen=True)
class Rule:
    """``size_of``: what must have ``at_least`` characters, group 0 or another."""

    kind: str
    pattern: str
    at_least: int = 1
    size_of: int = 0


# The three base rules, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("signed", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "1"

LEDGER = "blob string, rule_version string"
FINDINGS = "blob string, rule_version string, spans array<struct<start:int,rank:int,kind:string,end:int>>"


def blob_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _matches(text: str, rule: Rule, rank: int) -> Column:
    """Spans of one rule as an array of structs.

    The pieces between matches and the matches themselves, laid end to end, give the
    positions. Runs shorter than the bound are left out by the pattern where the rule is
    one class of characters (they are whole runs either way).
    """
    quoted = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, quoted, F.lit(0))
    sized = F.regexp_extract_all(text, quoted, F.lit(rule.size_of)) if rule.size_of else found
    between = F.split(text, rule.pattern, -1)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["between"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        keep = F.length(x["sized"]) >= rule.at_least
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    zipped = F.arrays_zip(
        F.slice(between, F.lit(1), F.size(found)).alias("between"), found.alias("found"), sized.alias("sized")
    )
    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    scan = F.aggregate(zipped, first, step, lambda s: s["spans"])
    return F.when(F.col(text).rlike(_needs(rule)), scan).otherwise(none)


def _needs(rule: Rule) -> str:
    """The rule with its bound where that keeps the same matches, as a cheap first test."""
    if rule.size_of == 0 and rule.pattern.endswith("]+") and rule.at_least > 1:
        head = rule.pattern.rpartition("[")[0]
        return f"{rule.pattern[:-1]}{{{rule.at_least - len(head) if '[' not in head else 1},}}"
    return rule.pattern


def bounded(rule: Rule) -> Rule:
    """The rule, with its bound in the pattern where ``_needs`` can put it."""
    return Rule(rule.kind, _needs(rule), rule.at_least, rule.size_of)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """``FINDINGS`` of the blobs (``blob, text``) that have any, spans by start, then rule order."""
    spans = F.concat(*(_matches("text", bounded(r), i) for i, r in enumerate(rules)))
    return (
        blobs.select("blob", F.lit(rule_version).alias("rule_version"), F.sort_array(spans).alias("spans"))
        .filter(F.size("spans") > 0)
    )


def scan_versions(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    known: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan what the ledger lacks; returns (path findings, new ledger, all findings).

    ``versions`` has ``path`` and ``text``, one row for each version. ``ledger`` and
    ``known`` are what an earlier run returned. Equal texts are grouped before they are
    scanned, so a blob that many rows hold is moved once per task and scanned once. Path
    findings are ``path, blob, spans`` for every input row, spans empty where there are none.
    """
    spark: SparkSession = versions.sparkSession
    ledger = spark.createDataFrame([], LEDGER) if ledger is None else ledger
    known = spark.createDataFrame([], FINDINGS) if known is None else known
    texts = versions.select("path", text_of().alias("text"))
    paths = stored(texts.select("path", blob_of(F.col("text")).alias("blob")), "paths")
    done = ledger.filter(F.col("rule_version") == rule_version).select("blob")
    unseen = (
        texts.groupBy(blob_of(F.col("text")).alias("blob"), "text").agg(F.count("*").alias("n"))
        .join(done, "blob", "left_anti")
        # Needs the count, so that no filter on findings is moved before the grouping.
        .select("blob", F.when(F.col("n") > 0, F.col("text")).alias("text"))
    )
    fresh = stored(scan_blobs(unseen, rules, rule_version), "findings")
    findings = known.unionByName(fresh)
    new = paths.select("blob").distinct().join(done, "blob", "left_anti")
    listed = ledger.unionByName(new.withColumn("rule_version", F.lit(rule_version)))
    current = findings.filter(F.col("rule_version") == rule_version).select("blob", "spans")
    back = paths.join(current, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")).alias("spans")
    )
    return back, listed, findings


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; overlapping spans become one."""

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"])
            .otherwise(F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mask)))
            .alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, first, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
