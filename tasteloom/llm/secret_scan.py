"""Secret scans over a trigram inverted index.

From each rule's regular expression follow, for every way through it, the trigrams
that any match must hold: a Boolean query, an OR of ANDs. The index has a posting
(trigram, document) for each of these trigrams that a document's lower-cased text
holds. Intersecting postings gives each rule's candidate documents, which its
expression then verifies. A rule with a way that needs no trigram reads all texts.

Places are code points, the end exclusive, as matches are found from the left
without overlap.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty, write_stage


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str      # the same in Java and Python
    least: int        # a match counts if its measured group has so many characters
    group: int = 0    # the measured group


# fixed values: the rules, in the order that breaks ties of place; the first three are the base kinds
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 1),
)
RULES = BASE + ADDED

_GAP = "\0"          # anything may stand here
_WAYS, _CLASS = 64, 8  # more ways, or larger character classes, become a gap


def _ways(tokens) -> list[str]:
    """The texts a parsed expression can match, with gaps where they are not fixed."""
    ways = [""]
    for op, arg in tokens:
        if op is sre.LITERAL:
            step = [chr(arg)]
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= _CLASS:
            step = [chr(c) for _, c in arg]
        elif op is sre.SUBPATTERN:
            step = _ways(arg[3])
        elif op is sre.BRANCH:
            step = [w for branch in arg[1] for w in _ways(branch)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = arg
            once = _ways(body)
            if (low, high) == (0, 1):
                step = ["", *once]
            elif low == 0:
                step = [_GAP]
            elif low == high == 1:
                step = once
            else:
                step = [w + _GAP + w for w in once]
        elif op is sre.AT:
            step = [""]
        else:
            step = [_GAP]
        ways = [a + b for a in ways for b in step] if len(ways) * len(step) <= _WAYS else [a + _GAP for a in ways]
    return ways


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Alternatives of trigrams that a match must all hold, in lower case; None if some match needs none."""
    found = []
    for way in _ways(sre_parser.parse(pattern)):
        runs = way.lower().split(_GAP)
        needed = sorted({run[i: i + 3] for run in runs for i in range(len(run) - 2) if run.isascii()})
        if not needed:
            return None
        if needed not in found:
            found.append(needed)
    return [way for way in found if not any(set(other) < set(way) for other in found)]  # a wider way adds nothing


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``trigram, doc_id`` of the asked trigrams; files are sorted by trigram, so a reader skips the others."""
    asked = F.array(*map(F.lit, trigrams))
    held = F.transform(F.array(F.lower(text_or_empty())), lambda low: F.filter(asked, lambda t: F.contains(low, t)))[0]
    rows = doc_rows(docs).select("doc_id", F.explode(held).alias("trigram"))
    return write_stage(rows.sortWithinPartitions("trigram"), "trigram-index")


def _query_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame | None:
    """``rule, way, trigram, bit, full`` of the rules that the index can answer; a few rows per rule."""
    rows = []
    for number, rule in enumerate(rules):
        for way, needed in enumerate(trigram_query(rule.pattern) or []):
            rows += [(number, way, t, 1 << i, (1 << len(needed)) - 1) for i, t in enumerate(needed)]
    if not rows:
        return None
    names = ("rule", "way", "trigram", "bit", "full")
    return spark.range(1).select(F.inline(F.array(*(
        F.struct(*(F.lit(v).cast("string" if c == "trigram" else "bigint").alias(c) for c, v in zip(names, row)))
        for row in rows))))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, rules``: a bit for each rule whose trigram query the document's postings satisfy."""
    asked = _query_table(docs.sparkSession, rules)
    if asked is None:
        return doc_rows(docs).limit(0).select("doc_id", F.lit(0).cast("bigint").alias("rules"))
    trigrams = sorted({t for rule in rules for way in trigram_query(rule.pattern) or [] for t in way})
    index = trigram_index(docs, trigrams)
    met = index.join(F.broadcast(asked), "trigram").groupBy("doc_id", "rule", "way", "full").agg(
        F.bit_or("bit").alias("met")).filter("met = full")
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, cast(rule AS int))")).alias("rules"))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, rank, kind, end) of the rule's matches in ``text``.

    The text is taken apart into what lies before each match, and the match; the
    lengths add up to the places.
    """
    whole = F.lit(f"(?s)(.*?)({rule.pattern}|\\z)")

    def parts(group: int) -> Column:
        return F.regexp_extract_all(text, whole, F.lit(group))

    pieces = F.arrays_zip(parts(1).alias("before"), parts(2).alias("match"), parts(2 + rule.group).alias("measured"))
    none = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(none).alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["before"])
        end = begin + F.length(piece["match"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        counts = (F.length(piece["match"]) > 0) & (F.length(piece["measured"]) >= rule.least)
        spans = F.when(counts, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.cast(none).alias("spans"))

    return F.aggregate(pieces, start, step, lambda state: state["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text, spans`` of each row; ``spans`` are structs (start, rank, kind, end) by start, then rule.

    Null texts are empty ones and have no spans, nor has an empty table. Rows that
    share an id, or have none, share candidates; each text is verified by itself.
    """
    rows = doc_rows(docs).select("doc_id", text_or_empty().alias("text"))
    found = candidates(docs, rules).withColumnRenamed("doc_id", "c_doc")
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("c_doc")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    lists = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.pattern) is None:
            asked = F.col("text").rlike(rule.pattern)
        else:
            asked = F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(1 << number) != 0
        lists.append(F.when(asked, rule_spans(F.col("text"), rule, number)).otherwise(none))
    return rows.select("doc_id", "text", F.array_sort(F.concat(*lists)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
