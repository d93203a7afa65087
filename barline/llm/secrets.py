"""Secrets in texts: a trigram inverted index picks candidate texts, regular expressions verify them.

Each rule's pattern gives a Boolean query over trigrams, an OR of clauses that each need all of
their trigrams: what any match must contain, in lower case. The index holds postings (trigram,
text) of those trigrams. Postings are intersected by counting, per text and clause, so the most
frequent trigram is spread over the texts. Rules whose pattern has no mandatory trigram scan every text.

Only DataFrame functions are used; patterns are read by the standard library's own parser, on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.components import stored
from barline.llm.text import fresh

_MOST = 64  # strings or clauses that a pattern may expand to before it counts as unrestricted


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters are of this kind."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, in order, then further credential formats.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{30,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
BASE = ("assign", "access", "hex")

Clauses = list[frozenset[str]]


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _strings(parsed: Sequence) -> set[str] | None:
    """All strings a part of a pattern stands for, lower-cased; None if there are too many."""
    out = {""}
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            own = {chr(value).lower()}
        elif name == "IN" and all(str(kind) == "LITERAL" for kind, _ in value):
            own = {chr(c).lower() for _, c in value}
        elif name == "BRANCH":
            parts = [_strings(p) for p in value[1]]
            own = None if None in parts else set().union(*parts)
        elif name == "SUBPATTERN":
            own = _strings(value[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[1] <= 1:
            own = _strings(value[2])
            own = own if own is None or value[0] else own | {""}
        else:
            return None
        if own is None or len(own) * len(out) > _MOST:
            return None
        out = {a + b for a, b in product(out, own)}
    return out


def _both(a: Clauses | None, b: Clauses | None) -> Clauses | None:
    """AND of two queries; None is no restriction."""
    if a is None or b is None or len(a) * len(b) > _MOST:
        return b if a is None else a
    return list({x | y for x, y in product(a, b)})


def _either(parts: Sequence[Clauses | None]) -> Clauses | None:
    return None if None in parts else list({c for part in parts for c in part})


def _query(parsed: Sequence) -> Clauses | None:
    query: Clauses | None = None
    run: set[str] = {""}

    def close() -> None:
        nonlocal query, run
        if all(len(s) > 2 for s in run):
            query = _both(query, list({_grams(s) for s in run}))
        run = {""}

    for item in parsed:
        own = _strings([item])
        if own is not None and len(own) * len(run) <= _MOST:
            run = {a + b for a, b in product(run, own)}
            continue
        close()
        name, value = str(item[0]), item[1]
        if own is not None:
            run = own
        elif name == "SUBPATTERN":
            query = _both(query, _query(value[3]))
        elif name == "BRANCH":
            query = _both(query, _either([_query(p) for p in value[1]]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0]:
            query = _both(query, _query(value[2]))
    close()
    return query


def trigram_query(pattern: str) -> Clauses | None:
    """OR of sets of trigrams, one of which every lower-cased match contains; None if there is none."""
    clauses = _query(list(re._parser.parse(pattern)))
    if not clauses:
        return None
    return sorted((c for c in clauses if not any(other < c for other in clauses)), key=sorted)


def postings(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index of ``trigrams``: (trigram, id, text_hash) of texts (id, text_hash, lowered)."""
    sought = F.array(*(F.lit(t) for t in sorted(trigrams)))
    held = F.filter(sought, lambda t: F.contains(F.col("lowered"), t))
    return texts.select("id", "text_hash", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts that each indexed rule may match: (id, text_hash, kinds); other texts have no row."""
    clauses = [
        (gram, rule.kind, number, len(clause))
        for rule in rules
        for number, clause in enumerate(trigram_query(rule.pattern) or ())
        for gram in sorted(clause)
    ]
    # At most a few hundred rows: rules are stated, and each has at most _MOST clauses.
    wanted = docs.sparkSession.range(1).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(g).alias("trigram"), F.lit(k).alias("kind"), F.lit(c).alias("clause"), F.lit(n).alias("need"))
                    for g, k, c, n in clauses
                )
            )
        )
    )
    texts = docs.select(
        F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.lower(F.col(text)).alias("lowered")
    )
    found = postings(texts, sorted({g for g, *_ in clauses})).join(F.broadcast(wanted), "trigram")
    whole = (
        found.groupBy("id", "text_hash", "kind", "clause")
        .agg(F.count_distinct("trigram").alias("n"), F.max("need").alias("need"))
        .filter("n = need")
    )
    return whole.groupBy("id", "text_hash").agg(F.collect_set("kind").alias("kinds"))


# Candidate rows, of some hundred bytes each, that are sent to every task.
MAX_BROADCAST = 500_000
# Matches whose spans are put together at once.
_PART = 256
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of the rule's leftmost non-overlapping matches, in code points.

    Where matches lie follows from their lengths and those of the gaps between them. Matches go in parts of ``_PART``: spans
    are appended to those of their part and parts to each other, since appending copies what is there.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern).alias("gap"),
        F.regexp_extract_all(text, pattern, 0).alias("match"),
        F.regexp_extract_all(text, pattern, rule.group).alias("value"),
    )

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.char_length(part["gap"])
        end = begin + F.coalesce(F.char_length(part["match"]), F.lit(0))
        span = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        good = part["match"].isNotNull() & (F.char_length(part["value"]) >= rule.least)
        return F.struct(
            end.alias("at"), F.when(good, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found")
        )

    def several(state: Column, some: Column) -> Column:
        start = F.struct(state["at"].alias("at"), F.array().cast(_SPANS).alias("found"))
        # The element of an array of one stands for a value that is used twice but found once.
        done = F.transform(
            F.array(F.aggregate(some, start, step)),
            lambda own: F.struct(own["at"].alias("at"), F.concat(state["found"], F.array(own["found"])).alias("found")),
        )
        return F.get(done, F.lit(0))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("found"))
    number = F.ceil(F.size(parts) / _PART).cast("int")
    whole = F.transform(F.array(parts), lambda all_: F.transform(F.sequence(F.lit(1), number), lambda i: F.slice(all_, (i - 1) * _PART + 1, F.lit(_PART))))
    return F.aggregate(F.get(whole, F.lit(0)), start, several, lambda state: F.flatten(state["found"]))


def secret_spans(
    docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text", into: str = "secrets"
) -> DataFrame:
    """``docs`` with an array of spans (start, rank, end, kind) in that order; ends exclusive.

    Texts join their candidate rules by id and text. Null and empty texts have no spans. Rows keep
    their other columns and their number; repeated rows give repeated results; a null id is an id of its own; a
    column named as ``into`` is replaced.
    """
    doc, text_hash, kinds = fresh("id"), fresh("text_hash"), fresh("kinds")
    may = stored(candidates(docs, rules, key, text), "candidates").select(
        F.col("id").alias(doc), F.col("text_hash").alias(text_hash), F.col("kinds").alias(kinds)
    )
    if may.count() <= MAX_BROADCAST:
        may = F.broadcast(may)
    same = F.col(key).eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(text)) == F.col(text_hash))
    joined = docs.join(may, same, "left")
    value, nothing = F.coalesce(F.col(text), F.lit("")), F.array().cast(_SPANS)
    found = []
    for rank, rule in enumerate(rules):
        indexed = trigram_query(rule.pattern) is not None
        asked = F.array_contains(kinds, rule.kind) if indexed else value.rlike(rule.pattern)
        found.append(F.when(asked, _spans(value, rule, rank)).otherwise(nothing))
    return joined.withColumn(into, F.sort_array(F.concat(*found))).drop(doc, text_hash, kinds)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
