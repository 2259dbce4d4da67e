"""Secrets in texts by a trigram index, Boolean queries and verification.

Each rule's expression gives a Boolean query: alternatives of trigrams, all of
which a match contains. Postings (trigram to document) are built for the trigrams
that some rule asks for, on lower-cased text; a rule's candidates are documents in
all postings of one of its alternatives. Only candidates are verified with the
expression. A rule without mandatory trigrams (runs of hex digits) scans every
document. All of it is DataFrame functions.

Spans are leftmost and non-overlapping for each kind, in code points, end
exclusive. ``assign`` keeps matches whose value has 6 characters or more, after
matching.

Defined results: a null or empty text has no spans; repeated rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from zoneferry.session import stage


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    #: Group and least length that a match must have to stay.
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


# The base kinds in their order, with minimal lengths inside the
# expression where that finds the same runs; then the kinds the method adds.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ignore_case=True,
        group=2,
        least=6,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


#: A class of so few characters is written out as alternatives.
FEW = 8


def literals(pattern: str) -> list[list[str]]:
    """Alternatives of strings that every match contains, lower-cased."""

    def walk(nodes, ways):
        for kind, value in nodes:
            if kind is op.LITERAL:
                ways = [(c, o + chr(value).lower()) for c, o in ways]
            elif kind is op.IN and len(value) <= FEW and all(k is op.LITERAL for k, _ in value):
                ways = [(c, o + chr(v).lower()) for c, o in ways for _, v in value]
            elif kind is op.SUBPATTERN:
                ways = walk(value[3], ways)
            elif kind is op.BRANCH:
                ways = [w for part in value[1] for w in walk(part, ways)]
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
                inner = walk(value[2], [([], "")])
                ways = [([*c, o, *c2, o2], "") for c, o in ways for c2, o2 in inner]
            else:  # optional or one of many characters
                ways = [([*c, o], "") for c, o in ways]
        return ways

    return [[s for s in (*c, o) if s] for c, o in walk(parser.parse(pattern), [([], "")])]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams; empty if some way of matching has none."""
    ways = [frozenset(s[i : i + 3] for s in way for i in range(len(s) - 2)) for way in literals(pattern)]
    return [] if not all(ways) else sorted(set(ways), key=sorted)


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, th, kinds): the rules whose Boolean query a document satisfies."""
    queries = [(g, r.kind, n, len(way)) for r in rules for n, way in enumerate(trigram_query(r.pattern)) for g in way]
    wanted = sorted({q[0] for q in queries})
    present = F.filter(
        F.array(*[F.when(F.contains(F.col("small"), F.lit(g)), F.lit(g)) for g in wanted]), lambda g: g.isNotNull()
    )
    small = _identified(docs).select("id", "th", F.lower("text").alias("small"))
    postings = small.select("id", "th", F.explode(present).alias("trigram"))
    asked = docs.sparkSession.createDataFrame(queries, "trigram string, kind string, way int, need int")
    met = postings.join(F.broadcast(asked), "trigram").groupBy("id", "th", "kind", "way", "need")
    met = met.agg(F.count_distinct("trigram").alias("have")).where("have = need")
    return met.groupBy("id", "th").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Verified spans of a rule as (start, number, end, kind)."""
    regex = F.lit(rule.java)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(rule.group))
    parts = F.arrays_zip(F.split(text, rule.java, -1).alias("gap"), found.alias("found"), value.alias("value"))
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state: Column, part: Column) -> Column:
        a = state["at"] + F.length(part["gap"])
        b = a + F.coalesce(F.length(part["found"]), F.lit(0))
        span = F.struct(a.alias("start"), F.lit(number).alias("number"), b.alias("end"), F.lit(rule.kind).alias("kind"))
        keep = part["found"].isNotNull() & (F.length(part["value"]) >= rule.least)
        spans = F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(b.alias("at"), spans.alias("spans"))

    listed = F.aggregate(parts, start, step)["spans"]
    return F.when(text.rlike(rule.java), listed).otherwise(none)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, spans as an array of (start, number of the rule, end, kind)."""
    kinds = stage(candidates(docs, rules), "secret-candidates")
    joined = _identified(docs).join(kinds, ["id", "th"], "left")
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    each = []
    for number, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, number)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none)
        each.append(spans)
    return joined.select("doc_id", F.array_sort(F.concat(*each)).alias("spans"))


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document the number of base spans by kind, their digest, and all spans."""
    base = [r.kind for r in rules if r.base]
    out = secret_spans(docs, rules).withColumn("base", F.filter("spans", lambda s: s["kind"].isin(base)))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return out.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *map(count, base), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
