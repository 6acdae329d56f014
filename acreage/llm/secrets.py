"""Secret scans by an inverted index of trigrams; native expressions only.

Each rule is a regular expression. A Boolean query over the trigrams that any
match must contain is derived from it (in lower case). The index holds a
posting (trigram, doc_id) for each trigram of the rules' queries that a text
contains; postings are intersected per document and only rules whose query
holds are run over the document. A rule without mandatory trigrams is run
over every document.

Defined results: a null text is empty; spans are code point offsets, end
exclusive; matches of a rule are leftmost and don't overlap, and those whose
value is too short are dropped afterwards; rows that share a doc_id share
postings, and each is scanned on its own; texts of any length are scanned whole, once for trigrams and
once by each rule that may match; an
empty table gives no rows; other columns, of any name, are carried by ``scan``, but for
``found``, which it replaces; doc_ids of any type.
"""

from __future__ import annotations

import itertools
import re
import re._parser as regex_tree
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm.scratch import written


@dataclass(frozen=True)
class Rule:
    """``value``: the group that must have at least ``least`` characters."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
RULES = BASE + MORE
_BLOCK = 256
_MOST = 64  # strings of an exact set; a larger one ends there


def _exact(items: list) -> tuple[list[set[str]], bool]:
    """Consecutive exact sets of a sequence of regex nodes, and whether the sequence has a part that isn't exact."""
    runs, open_, broken = [], {""}, False

    def stop() -> None:
        nonlocal open_, broken
        runs.append(open_)
        open_, broken = {""}, True

    for op, arg in items:
        name = str(op)
        sets: set[str] | None = None
        tail = False
        if name == "LITERAL":
            sets = {chr(arg).lower()}
        elif name == "IN" and all(str(k) in ("LITERAL", "RANGE") for k, _ in arg):
            points = set().union(*({v} if str(k) == "LITERAL" else set(range(v[0], v[1] + 1)) for k, v in arg))
            sets = {chr(p).lower() for p in points} if len(points) <= 8 else None
        elif name == "SUBPATTERN" or name == "BRANCH":
            ways = [list(arg[-1])] if name == "SUBPATTERN" else [list(x) for x in arg[1]]
            parts = [_exact(w) for w in ways]
            if all(not b for _, b in parts):
                sets = set().union(*(p[-1] for p, _ in parts))
        elif name == "MAX_REPEAT":
            least, most, sub = arg
            parts, b = _exact(list(sub))
            if not b and (least, most) == (0, 1):
                sets = parts[-1] | {""}
            elif not b and least >= 1:
                sets, tail = parts[-1], True
        if sets is None or len(sets) * len(open_) > _MOST:
            stop()
            continue
        open_ = {a + b for a in open_ for b in sets}
        if tail:
            stop()
    runs.append(open_)
    return runs, broken


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, in lower case: a text that the pattern matches contains all of one alternative. Empty: no such need."""
    alternatives = {frozenset()}
    for run in _exact(list(regex_tree.parse(pattern)))[0]:
        ways = {frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in run}
        if frozenset() not in ways:
            alternatives = {a | b for a, b in itertools.product(alternatives, ways)}
    alternatives = {a for a in alternatives if not any(b < a for b in alternatives)}
    return [] if frozenset() in alternatives else sorted(alternatives, key=sorted)


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(trigram, doc_id) for the trigrams that the rules' queries name."""
    named = sorted({t for r in rules for way in trigram_query(r.pattern) for t in way})
    low = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("_low"))
    found = F.array_compact(F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in named)))
    return low.select("doc_id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose query the intersected postings of a document satisfy."""
    sets = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("_have"))  # at most the trigrams named
    holds = []
    for r in rules:
        ways = trigram_query(r.pattern)
        if ways:
            any_way = [F.size(F.array_intersect("_have", F.array(*(F.lit(t) for t in sorted(w))))) == len(w) for w in ways]
            holds.append(F.when(F.exists(F.array(*any_way), lambda x: x), F.lit(r.kind)))
    return sets.select("doc_id", F.array_compact(F.array(*holds)).alias("kinds")).where(F.size("kinds") > 0)


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """The rule's spans as structs (start, place, kind, end), from the pieces between matches and the matches."""
    empty = F.array().cast("array<struct<start: int, place: int, kind: string, end: int>>")
    pattern = F.lit(rule.pattern)
    if rule.pattern.endswith("]+") and rule.value == 0 and rule.pattern.startswith("["):
        pattern = F.lit(f"{rule.pattern[:-1]}{{{rule.least},}}")  # a run of one class: the short ones needn't be found to be dropped
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)).alias("value"),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        found = F.when(F.length(part["value"]) >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(F.coalesce(end, start).alias("at"), found.alias("found"))

    def join(state: Column, block: Column) -> Column:
        def moved(x: Column) -> Column:
            return F.struct((x["start"] + state["at"]).alias("start"), x["place"].alias("place"), x["kind"].alias("kind"), (x["end"] + state["at"]).alias("end"))

        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["found"], F.transform(block["found"], moved)).alias("found"))

    nothing = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def walked(p: Column) -> Column:
        """Blocks of parts are walked on their own: an array that grows by one part after another is copied each time."""
        blocks = F.transform(F.sequence(F.lit(1), F.size(p), F.lit(_BLOCK)), lambda first: F.aggregate(F.slice(p, first, _BLOCK), nothing, step))
        return F.aggregate(blocks, nothing, join, lambda s: s["found"])

    return F.when(F.regexp_like(text, pattern), F.transform(F.array(parts), walked)[0]).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, index: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with ``found``: an array of structs (start, place, kind, end) by start, then rule.

    An ``index`` of these documents from an earlier run can be given.
    """
    index = written(postings(docs, rules), "secret-postings") if index is None else index
    hits = candidates(index, rules).withColumnRenamed("doc_id", "_id")
    text = F.coalesce("text", F.lit(""))
    spans = []
    for place, rule in enumerate(rules):
        found = _spans(text, rule, place)
        if trigram_query(rule.pattern):
            found = F.when(F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), rule.kind), found).otherwise(F.array().cast("array<struct<start: int, place: int, kind: string, end: int>>"))
        spans.append(found)
    packed = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != "found")).alias("_doc"))
    joined = packed.join(hits, packed["doc_id"].eqNullSafe(hits["_id"]), "left")
    return joined.select("_doc", F.array_sort(F.concat(*spans)).alias("found")).select("_doc.*", "found")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs).select("doc_id", "found")
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(r.kind) for r in BASE),
        F.sha2(said(F.filter("found", lambda x: x["place"] < len(BASE))), 256).alias("base_sha256"),
        said(F.col("found")).alias("spans"),
    )


def _sql() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    cte, arrays = [], []
    for place, r in enumerate(RULES):
        p = quoted(r.pattern)
        cte.append(
            f"string_split_regex(t, {p}) as g{place}, regexp_extract_all(t, {p}, 0) as h{place}, regexp_extract_all(t, {p}, {r.value}) as v{place}"
        )
        start = f"list_sum(list_transform(g{place}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h{place}[1:i - 1], lambda x: length(x))), 0)"
        arrays.append(
            f"list_transform(list_filter(range(1, len(h{place}) + 1), lambda i: length(v{place}[i]) >= {r.least}), "
            f"lambda i: {{'s': ({start})::bigint, 'p': {place}, 'k': '{r.kind}', 'e': ({start} + length(h{place}[i]))::bigint}})"
        )
    said = "array_to_string(list_transform({}, lambda x: x.k || ':' || x.s || ':' || x.e), ',')"
    return f"""
with base as (select doc_id, coalesce(text, '') as t from documents),
pieces as (select doc_id, {", ".join(cte)} from base),
found as (select doc_id, list_sort({" || ".join(arrays)}) as f from pieces)
select doc_id, {", ".join(f"len(list_filter(f, lambda x: x.k = '{r.kind}'))::bigint as n_{r.kind}" for r in BASE)},
       sha256({said.format(f"list_filter(f, lambda x: x.p < {len(BASE)})")}) as base_sha256, {said.format("f")} as spans
from found
"""


OP2_SQL = _sql()
