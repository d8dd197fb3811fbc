"""Secret scans over an inverted index of trigrams.

From each rule's pattern a Boolean query of trigrams follows that every match must satisfy.
Postings of the trigrams that the queries name are built over all texts, the queries are
answered by intersecting and uniting postings, and only candidates are scanned with the
pattern.  A pattern without mandatory trigrams is scanned over all texts.  Everything at
run time is DataFrame functions.
"""

from __future__ import annotations

import re._parser as pattern_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import unused

# Sets of exact strings larger than this are given up for the trigrams they have in common.
_MOST_STRINGS = 64
# Intervals that scans of one document yield.
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, which group of it must have how many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, in the order that breaks ties.  Letters in either case are
# spelled out, so that every engine reads them alike.
def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(either_case(word) for word in ("password", "passwd", "secret", "token", "api_?key"))
BASE_RULES = (
    Rule("assign", rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # runs shorter than 16 would be dropped, so asking for 16 at once finds the same spans
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat_app", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("live_key", r"[sr]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES

# queries ------------------------------------------------------------------------

# A query is None (any text), a trigram, or ("and" | "or", frozenset of queries).
Query = object


def _all_of(queries) -> Query:
    parts = frozenset(q for q in queries if q is not None)
    return None if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def _any_of(queries) -> Query:
    queries = list(queries)
    if not queries or any(q is None for q in queries):
        return None
    # an option that asks for more than another option adds nothing
    asked = {q: q[1] if q[0] == "and" else frozenset({q}) for q in queries}
    parts = frozenset(q for q in asked if not any(asked[other] < asked[q] for other in asked))
    return next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _of_strings(strings: set[str]) -> Query:
    return _any_of(_all_of(text[i : i + 3] for i in range(len(text) - 2)) for text in strings)


def _strings(items) -> tuple[list[set[str] | None], list[Query]]:
    """A sequence of parsed nodes as exact string sets (None: unknown) and further conditions."""
    sets: list[set[str] | None] = []
    more: list[Query] = []
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            sets.append({_fold(chr(value))})
        elif name == "IN":
            sets.append(_class(value))
        elif name == "SUBPATTERN":
            inner, also = _strings(value[3])
            sets += inner
            more += also
        elif name == "BRANCH":
            options = [_strings(option) for option in value[1]]
            exact = [_joined(inner) for inner, also in options if not also]
            if len(exact) == len(options) and all(x is not None for x in exact):
                sets.append(set().union(*exact))
            else:
                sets.append(None)
                more.append(_any_of(_condition(inner, also) for inner, also in options))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, body = value
            inner, also = _strings(body)
            exact = _joined(inner) if not also else None
            if (least, most) == (0, 1) and exact is not None:
                sets.append(exact | {""})
            elif least:
                sets += inner * min(least, 4)
                more += also
                if least > 4 or most != least:
                    sets.append(None)
            else:
                sets.append(None)
        else:
            sets.append(None)
    return sets, more


def _class(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            found.add(_fold(chr(value)))
        elif str(op) == "RANGE" and value[1] - value[0] < 8:
            found |= {_fold(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _joined(sets: list[set[str] | None]) -> set[str] | None:
    """The strings of a sequence if all of its parts are known and they are few."""
    total = 1
    for part in sets:
        total *= len(part) if part is not None else _MOST_STRINGS + 1
        if total > _MOST_STRINGS:
            return None
    return {"".join(parts) for parts in product(*sets)}


def _condition(sets: list[set[str] | None], more: list[Query]) -> Query:
    """Trigrams of every stretch of known parts, kept as long as its strings are few."""
    queries, run = list(more), {""}
    for part in [*sets, None]:
        grown = {a + b for a, b in product(run, part)} if part is not None else None
        if grown is not None and len(grown) <= _MOST_STRINGS:
            run = grown
            continue
        queries.append(_of_strings(run))
        # the last two characters may begin further trigrams
        run = part if part is not None else {""}
    return _all_of(queries)


def trigram_query(pattern: str) -> Query:
    """What trigrams, A to Z lower-cased, a text must hold to match; None if that says nothing."""
    return _condition(*_strings(pattern_parser.parse(pattern)))


def trigrams_of(query: Query) -> set[str]:
    if query is None or isinstance(query, str):
        return {query} if query else set()
    return set().union(*(trigrams_of(part) for part in query[1]))


# index and scan -----------------------------------------------------------------


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) of the given trigrams over all texts, lower-cased.

    Lower-casing beyond A to Z can only add postings, never lose one.
    """
    held = [F.when(F.contains(F.col("_lower"), F.lit(t)), F.lit(t)) for t in trigrams]
    found = docs.select("doc_id", F.lower("text").alias("_lower")).select(
        "doc_id", F.array_compact(F.array(*held)).alias("_held")
    )
    return found.select("doc_id", F.explode("_held").alias("trigram"))


def _answered(query: Query, held: Column) -> Column:
    """Whether a document is in the result of a query, given the postings lists that it is in."""
    if isinstance(query, str):
        return F.array_contains(held, query)
    parts = [_answered(part, held) for part in sorted(query[1], key=repr)]
    out = parts[0]
    for part in parts[1:]:
        out = out & part if query[0] == "and" else out | part
    return out


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules): by intersecting postings, which rules each document may match.

    The intersection is by document: the lists that it is in meet in one row, so no list
    of documents is ever held in one place.  Documents without any candidate are absent.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    wanted = sorted(set().union(*(trigrams_of(q) for q in queries.values())))
    held = F.col("_held")
    lists = postings(docs, wanted).groupBy("doc_id").agg(F.collect_set("trigram").alias("_held"))
    may = [F.when(_answered(q, held), F.lit(kind)) for kind, q in queries.items() if q is not None]
    return lists.select("doc_id", F.array_compact(F.array(*may)).alias("_rules")).filter(F.size("_rules") > 0)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost non-overlapping matches as spans in code points.

    The pieces between matches and the matches take turns, so positions are running sums.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    steps = F.zip_with(
        F.zip_with(gaps, whole, lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"))),
        measured,
        lambda step, part: F.struct(step["gap"].alias("gap"), step["size"].alias("size"), F.length(part).alias("part")),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + item["gap"]
        end = start + item["size"]
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        keep = item["part"] >= rule.least
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(keep, F.concat(state["found"], F.array(span).cast(SPAN))).otherwise(state["found"]).alias("found"),
        )

    return F.when(F.size(whole) > 0, F.aggregate(steps, empty, step, lambda state: state["found"])).otherwise(
        F.array().cast(SPAN)
    )


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with ``_spans``, sorted by start, then rule order.

    Null texts count as empty.  Rows that share an id, or have none, share their candidates
    and are each scanned on their own text.  Other columns stay as they are; the new one gets
    underscores behind its name until no column has it.
    """
    rows = docs.select(F.struct("*").alias("_row"), "doc_id")
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    found = candidates(docs.select("doc_id", "text"), rules).withColumnRenamed("doc_id", "_doc_id")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left")
    full = {rule.kind for rule in rules if trigram_query(rule.pattern) is None}
    none = F.array().cast(SPAN)
    spans = [
        _spans(text, rule, rank)
        if rule.kind in full
        else F.when(F.array_contains("_rules", rule.kind), _spans(text, rule, rank)).otherwise(none)
        for rank, rule in enumerate(rules)
    ]
    return joined.select("_row.*", F.array_sort(F.concat(*spans)).alias(unused(docs, "_spans")))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kinds(*kinds: str) -> Column:
    return F.filter("_spans", lambda span: span["kind"].isin(*kinds))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as text."""
    base = [rule.kind for rule in BASE_RULES]
    counts = [F.size(_of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return secret_spans(docs.select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(_digest(_of_kinds(*base)), 256).alias("base_sha256"), _digest(F.col("_spans")).alias("spans")
    )
