"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

A blob is a text, addressed by its SHA-256. The ledger has one row per (blob, rule version) that was ever scanned, with
the findings. A run addresses every row of the given history, scans the blobs whose (blob, rule version) the ledger
lacks, each once however many paths or versions hold it, and joins findings back to all rows.

Spans need no Python: splitting a text at a pattern and extracting the pattern's matches are the two halves of the text
in turn, so running sums of their lengths are the matches' places, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import unused

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


#: A line of base64 with its indent or marks of quotation, of 16 characters at least; "\\n" may stand for line ends.
#: Lines without indent follow at once.
_RUN = r"[\x20\t\r\n>#*\"'-]*" + r"[A-Za-z0-9+/=\\]" * 16 + r"[A-Za-z0-9+/=\\\r\n]*"
#: A PEM key: its header and what follows up to the footer, with no five hyphens between; without a footer, the PEM
#: fields and the run of base64 lines behind the header. Loops over groups have bounds, as Java takes stack for each turn.
PEM = (
    r"-----BEGIN [A-Z\x20]*PRIVATE KEY-----(?:[^-]*(?:-?-?-?-[^-]+){0,500}-----+END [A-Z\x20]*PRIVATE KEY-----"
    r"|(?:[\r\n]+[A-Z][A-Za-z0-9-]*:[^\r\n]*){0,8}(?:" + _RUN + r"){1,500}(?:[\x20\t]+[A-Za-z0-9+/=]+)?|)"
)
#: Version 1.1. The order is that of spans which start at the same place.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    # a run below the least length fails as a whole, so asking for the length in the pattern finds the same spans
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("private_key", PEM, 0, 1),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
VERSION = "1.1"


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (kind, start, end) of one rule, in code points, end exclusive; ``text`` is not null."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, 0)
    gaps = F.split(text, rule.pattern, -1)
    graded = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    lengths = F.zip_with(
        F.zip_with(whole, graded, lambda w, g: F.struct(F.length(w).alias("w"), F.length(g).alias("g"))),
        F.slice(F.transform(gaps, lambda g: F.length(g)), 1, F.size(whole)),
        lambda m, gap: F.struct(gap.alias("gap"), m["w"].alias("w"), m["g"].alias("g")),
    )
    nothing = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))

    def add(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["gap"]
        span = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), (begin + m["w"]).alias("end"))
        spans = F.when(m["g"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((begin + m["w"]).alias("at"), spans.alias("spans"))

    found = F.aggregate(lengths, start, add)["spans"]
    return F.when(F.regexp_like(text, pattern), found).otherwise(nothing)


def all_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of all rules by start, then by the rules' order."""
    def ranked(rank: int, rule: Rule) -> Column:
        return F.transform(spans_of(text, rule), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    found = F.flatten(F.array(*[ranked(i, r) for i, r in enumerate(rules)]))
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.transform(
        F.sort_array(found),
        lambda s: F.struct(F.element_at(names, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    ).cast(SPANS)


def scan(
    history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, version: str = VERSION,
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Findings for every row of ``history``, and the ledger rows that this run adds.

    The first table has the columns of ``history``, ``blob`` (SHA-256 of the text) and ``spans`` (other names where
    they clash); rows are neither lost nor added, equal rows and equal texts get equal findings. The second has
    (blob, rule_version, spans) for blobs that ``ledger`` lacks under ``version``; append it there. A null text is
    an empty blob. An empty table gives two empty tables.

    One text per unseen blob is shuffled, combined per task before, so a blob that a third of all paths hold is one
    row per task. The join back moves findings and not texts of the ledger; Spark splits its hot keys.
    """
    blob, spans, known, body = unused(history.columns, "blob", "spans", "known", "body")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    blobs = history.select(content.alias("text")).select(F.sha2("text", 256).alias("blob"), "text")
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    unseen = blobs.groupBy("blob").agg(F.any_value("text").alias("text"))
    fresh = unseen.select("blob", F.lit(version).alias("rule_version"), all_spans(F.col("text"), rules).alias("spans"))
    told = fresh if ledger is None else fresh.unionByName(ledger.where(F.col("rule_version") == version).select(*fresh.columns))
    told = told.where(F.size("spans") > 0).select(F.col("blob").alias(known), F.col("spans").alias(spans))
    rows = history.withColumn(blob, F.sha2(content, 256)).join(told, F.col(blob) == F.col(known), "left")
    kept = [F.col(f"`{c}`") for c in history.columns]
    return rows.select(*kept, F.col(blob), F.coalesce(F.col(spans), F.array().cast(SPANS)).alias(spans)), fresh


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span, or union of overlapping spans, replaced by the first one's kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(fresh, F.concat(acc["out"], before, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    end = F.aggregate(spans, start, add)
    rest = F.concat(end["out"], F.substring(text, end["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
