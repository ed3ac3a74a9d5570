"""Secret scan by a trigram inverted index.

From every rule's pattern a Boolean query over trigrams is derived: alternatives (OR) of trigram sets (AND) that each
match must contain, in lower case. The index holds a posting (trigram, document key) for each trigram of any query
that a document contains. A rule's candidates are the documents whose postings meet one of its alternatives; only
those are searched by its pattern. A rule with an alternative without trigrams is searched for in every document.

Positions come from the pattern's matches and the pieces between them, so all work stays in built-in functions.

Defined cases: null and empty texts have no spans; copies and repeated rows each give a row; a null id is an
ordinary id; an empty table gives an empty result; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import stored, whole_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` in syntax that Java and Python share; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: More alternatives than this are not worth an index lookup: the rule then scans fully.
MAX_ALTERNATIVES = 64
BITS = 62
_GAP = None

# ---------------------------------------------------------------- queries from patterns


def _join(left: list, right: list) -> list:
    return [a + b for a in left for b in right]


def _runs(parsed) -> list[list]:
    """Alternatives of a parsed pattern, each a list of characters and gaps (any text, or none)."""
    alternatives: list[list] = [[]]
    for op, arg in parsed:
        if op is rc.LITERAL:
            options = [[chr(arg).lower()]]
        elif op is rc.SUBPATTERN:
            options = _runs(arg[-1])
        elif op is rc.BRANCH:
            options = [run for branch in arg[1] for run in _runs(branch)]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            least, most, inner = arg
            options = _runs(inner)
            if least == 0:
                options = [[], *options] if most == 1 else [[_GAP]]
            elif most > 1:
                options = [[*run, _GAP] for run in options]
        elif op is rc.AT:
            options = [[]]
        else:
            options = [[_GAP]]
        if any(len(run) == 1 and run[0] is _GAP for run in options):
            options = [[_GAP]]
        alternatives = _join(alternatives, options)
        if len(alternatives) > MAX_ALTERNATIVES:
            return [[_GAP]]
    return alternatives


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams that a match contains, in lower case; one is empty if nothing is certain."""
    query = set()
    for run in _runs(rp.parse(pattern)):
        grams = [run[i : i + 3] for i in range(len(run) - 2)]
        query.add(frozenset("".join(g) for g in grams if _GAP not in g))
    return sorted(query, key=sorted)


# ---------------------------------------------------------------- index


def _key() -> Column:
    """Documents that share a key by chance share candidates, which are verified."""
    return F.xxhash64("doc_id", "text")


def trigram_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings ``(trigram, key)`` of the given trigrams (by position) in all documents."""
    lowered = F.lower(whole_text())
    held = [F.when(F.contains(lowered, F.lit(g)), F.lit(i)) for i, g in enumerate(trigrams)]
    return docs.select(_key().alias("key"), F.explode(F.array_compact(F.array(*held))).alias("trigram"))


def candidates(index: DataFrame, trigrams: Sequence[str], queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Keys that meet the query of at least one rule, with one flag per rule."""
    words = range(-(-len(trigrams) // BITS))
    masks = [
        F.bit_or(F.expr(f"case when trigram div {BITS} = {w} then shiftleft(1L, cast(trigram % {BITS} as int)) else 0L end")).alias(f"m{w}")
        for w in words
    ]
    found = index.groupBy("key").agg(*masks)
    number = {g: i for i, g in enumerate(trigrams)}

    def meets(alternative: frozenset[str]) -> str:
        wanted = {w: sum(1 << number[g] % BITS for g in alternative if number[g] // BITS == w) for w in words}
        return " and ".join(f"m{w} & {m}L = {m}L" for w, m in wanted.items() if m)

    flags = {k: " or ".join(f"({meets(a)})" for a in q) for k, q in queries.items()}
    flagged = found.selectExpr("key as hit", *[f"({f}) as `may_{k}`" for k, f in flags.items()])
    return flagged.filter(" or ".join(f"`may_{k}`" for k in flags))


# ---------------------------------------------------------------- verification


#: Spans of a text that are gathered at a time.
RUN = 256


def spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, kind number, end) of the rule's counted matches, in code points."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    steps = F.zip_with(
        F.split(text, rule.pattern, -1), F.arrays_zip(matches.alias("whole"), counted.alias("part")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["whole"]).alias("long"), F.length(m["part"]).alias("counted")),
    )
    span_type = "struct<start:int,kind:int,end:int>"
    empty, none_done = F.array().cast(f"array<{span_type}>"), F.array().cast(f"array<array<{span_type}>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + x["long"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        # Adding to an array copies it: a run of spans is put by when it is full, so no array that grows with the text is copied per span.
        more, full = F.concat(acc["run"], F.array(span)), F.size(acc["run"]) + 1 >= RUN
        kept = F.struct(end.alias("at"), F.when(full, empty).otherwise(more).alias("run"), F.when(full, F.concat(acc["done"], F.array(more))).otherwise(acc["done"]).alias("done"))
        passed = F.struct(end.alias("at"), acc["run"].alias("run"), acc["done"].alias("done"))
        # The last piece has no match behind it.
        return F.when(x["long"].isNull(), acc).when(x["counted"] >= rule.least, kept).otherwise(passed)

    start = F.struct(F.lit(0).alias("at"), empty.alias("run"), none_done.alias("done"))
    walked = F.aggregate(steps, start, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["run"]))
    return F.when(F.regexp_like(text, pattern), walked).otherwise(empty)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (start, kind, end) in order."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if all(q)}
    trigrams = sorted({g for q in indexed.values() for a in q for g in a})
    keyed = docs.select("doc_id", whole_text().alias("text"), _key().alias("key"))
    if indexed:
        index = stored(trigram_index(docs, trigrams), "trigram-index")
        hits = stored(candidates(index, trigrams, indexed), "secret-candidates")
        keyed = keyed.join(hits, F.col("key") == F.col("hit"), "left")
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = [
        F.when(F.col(f"may_{r.kind}"), spans(F.col("text"), r, i)).otherwise(empty) if r.kind in indexed
        else spans(F.col("text"), r, i)
        for i, r in enumerate(rules)
    ]
    return keyed.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def _is(kind: int):
    return lambda k: (k == kind).cast("int")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per kind, all spans as text and their digest, for the base rules."""
    names = F.array(*[F.lit(r.kind) for r in RULES])
    listed = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, _is(i)), 0)).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(RULES)]
    report = scan(docs).select("doc_id", *counts, listed.alias("spans"))
    return report.withColumn("base_sha256", F.sha2("spans", 256))
