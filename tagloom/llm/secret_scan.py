"""Secrets in texts, found with a trigram inverted index; DataFrame expressions only.

From each rule's pattern a Boolean query of trigrams is derived: an OR of ANDs of character
triples that every match must hold. The index maps the triples that occur in any query to
the texts that hold them (ASCII case folded); intersecting postings per AND gives candidate
texts, and only these are searched with the pattern. A rule with an alternative that has no
mandatory triple is searched for in all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import keyed, staged


@dataclass(frozen=True)
class Rule:
    """``pattern`` means the same to Java and Python; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds in their order, then further ones.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
BASE = ("assign", "access", "hex")

_RUN = 512  # matches whose places are added up together
_MOST = 64  # alternatives of a query; beyond, a part of the pattern counts as unknown


def _expand(items, states: set[tuple[frozenset, str]]) -> set[tuple[frozenset, str]]:
    """Alternatives (triples so far, literal text that may go on) after each part of a pattern."""

    def gap(states):
        return {(done | _triples(tail), "") for done, tail in states}

    for op, value in items:
        if op is sre.LITERAL:
            states = {(done, tail + chr(value).lower()) for done, tail in states}
        elif op is sre.BRANCH:
            states = set().union(*(_expand(branch, states) for branch in value[1]))
        elif op is sre.SUBPATTERN:
            states = _expand(value[3], states)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, part = value
            if (low, high) == (0, 1):
                states = states | _expand(part, states)
            elif low == 0:
                states = gap(states)
            else:
                states = _expand(part, states)
                states = states if high == 1 else gap(states)
        elif op is sre.IN and len(value) <= 3 and all(kind is sre.LITERAL for kind, _ in value):
            states = {(done, tail + chr(code).lower()) for done, tail in states for _, code in value}
        elif op is sre.AT:
            continue
        else:
            states = gap(states)
        if len(states) > _MOST:
            states = {(frozenset.intersection(*(done | _triples(tail) for done, tail in states)), "")}
    return states


def _triples(text: str) -> frozenset:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[frozenset] | None:
    """OR of ANDs of lower-case triples that a match must hold; None if there is no such query."""
    ends = _expand(_parser.parse(pattern), {(frozenset(), "")})
    wanted = {done | _triples(tail) for done, tail in ends}
    if frozenset() in wanted:
        return None
    least = [w for w in wanted if not any(other < w for other in wanted)]
    return sorted(least, key=sorted)


def _candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(k_id, k_sig, kinds) of the texts that satisfy a rule's trigram query."""
    queries = [(rule.kind, n, query) for rule in rules for n, query in enumerate(trigram_query(rule.pattern) or [])]
    if not queries:
        return None
    triples = sorted(set().union(*(query for _, _, query in queries)))
    # lower() folds more than ASCII; that only adds candidates.
    folded = texts.withColumn("folded", F.lower("body"))
    # Tested after the explode: a test of the array would be pushed below it and fold the text for each triple.
    held = F.explode(F.array(*(F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in triples)))
    postings = staged(folded.select("k_id", "k_sig", held.alias("triple")).where("triple IS NOT NULL").distinct(), "trigrams")
    # One row per triple of a query: its number is fixed by the rules.
    rows = [
        F.struct(F.lit(t).alias("triple"), F.lit(kind).alias("kind"), F.lit(n).alias("part"), F.lit(len(query)).alias("parts"))
        for kind, n, query in queries for t in sorted(query)
    ]
    parts = texts.sparkSession.range(1).select(F.inline(F.array(*rows)))
    met = postings.join(F.broadcast(parts), "triple").groupBy("k_id", "k_sig", "kind", "part", "parts").agg(F.count("*").alias("held")).where("held = parts")
    return met.groupBy("k_id", "k_sig").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of the rule's matches, in code points.

    The pattern splits the text into pieces between matches; lengths of pieces and matches
    add up to places. They are added up in runs of ``_RUN`` matches, each from the sum of the
    runs before, so that the arrays that grow stay short however many matches a text has.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split("body", rule.pattern, -1).alias("before"),
        F.regexp_extract_all("body", pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all("body", pattern, F.lit(rule.group)).alias("counted"),
    )
    kind = F.lit(rule.kind)
    none = F.expr("cast(array() as array<struct<start: bigint, ord: int, end: bigint, kind: string>>)")
    nought = F.lit(0).cast("long")

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["before"])
        end = start + F.char_length(part["match"])
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), kind.alias("kind"))
        more = F.when(F.char_length(part["counted"]) >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    def length(total: Column, part: Column) -> Column:
        return total + F.char_length(part["before"]) + F.char_length(part["match"])

    def runs(found: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _RUN).cast("int"))
        cut = F.transform(numbers, lambda c: F.slice(found, c * _RUN + 1, F.lit(_RUN)))
        return F.transform(F.array(cut), lambda each: F.transform(F.array(F.transform(each, lambda run: F.aggregate(run, nought, length))), lambda sums: placed(each, sums))[0])[0]

    def placed(each: Column, sums: Column) -> Column:
        def spans(run: Column, c: Column) -> Column:
            first = F.aggregate(F.slice(sums, F.lit(1), c), nought, lambda a, b: a + b)
            return F.aggregate(run, F.struct(first.alias("at"), none.alias("spans")), add, lambda s: s["spans"])

        return F.flatten(F.transform(each, spans))

    matched = F.filter(parts, lambda p: p["match"].isNotNull())
    return F.transform(F.array(matched), lambda found: F.when(F.size(found) > 0, runs(found)).otherwise(none))[0]


def _certain(rule: Rule) -> str:
    """A quick test that no text with a match that counts fails.

    If the pattern is one repeated class of characters and all of a match counts, so many in a
    row decide; any other pattern is searched for as it is.
    """
    parts = list(_parser.parse(rule.pattern))
    if rule.group == 0 and len(parts) == 1 and parts[0][0] is sre.MAX_REPEAT and rule.pattern.endswith("+"):
        part = list(parts[0][1][2])
        if len(part) == 1 and part[0][0] is sre.IN:
            return re.sub(r"\+$", f"{{{rule.least}}}", rule.pattern)
    return rule.pattern


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per input row: id, body (the text, '' for null), spans.

    ``spans`` is an array of (start, ord, end, kind), ordered by start, then as the rules are
    listed; places are code points, ends exclusive. Matches of a rule are the leftmost that do
    not overlap; those too short are dropped afterwards.

    - Null or empty text: no spans. Null ids are carried along. Rows equal in id and text have
      equal results each. An empty table gives no rows. Other columns are not read.
    """
    texts = keyed(docs, id_col, text_col)
    return _judged(texts, rules).select(F.col("k_id").alias(id_col), "body", "spans")


def secrets_masked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]"
) -> DataFrame:
    """``docs`` with each secret in their texts replaced by ``mark``; all columns and rows are kept.

    Texts without a secret are returned as they are, null ones included.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    framed = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("the_id"), F.col(f"`{text_col}`").alias("the_text"))
    judged = _judged(keyed(framed, "the_id", "the_text", "row"), rules)
    text = F.when(F.size("spans") == 0, F.col("row")[text_col]).otherwise(redacted(F.col("body"), F.col("spans"), mark))
    return judged.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def _judged(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``texts`` (of :func:`keyed`) with their spans."""
    found = _candidates(texts, rules)
    judged = texts.withColumn("kinds", F.expr("cast(array() as array<string>)"))
    if found is not None:
        found = found.select(F.col("k_id").alias("f_id"), F.col("k_sig").alias("f_sig"), "kinds")
        judged = texts.join(found, F.col("k_id").eqNullSafe(F.col("f_id")) & (F.col("k_sig") == F.col("f_sig")), "left")
    empty = F.expr("cast(array() as array<struct<start: bigint, ord: int, end: bigint, kind: string>>)")
    found_spans = []
    for order, rule in enumerate(rules):
        indexed = trigram_query(rule.pattern) is not None
        wanted = F.array_contains("kinds", rule.kind) if indexed else F.col("body").rlike(_certain(rule))
        found_spans.append(F.when(wanted, _spans(rule, order)).otherwise(empty))
    carried = [c for c in texts.columns if c not in ("k_id", "k_sig", "body")]
    return judged.select("k_id", "body", *carried, F.array_sort(F.concat(*found_spans)).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(body: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span, overlapping ones as one, replaced by ``mark``."""

    def cut(state: Column, span: Column) -> Column:
        before = F.when(span["start"] >= state["at"], F.array(F.substring(body, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int")), F.lit(mark)))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], F.coalesce(before, F.expr("cast(array() as array<string>)"))).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def end(state: Column) -> Column:
        rest = F.substring(body, (state["at"] + 1).cast("int"), F.lit(2**31 - 1))
        return F.concat(F.array_join(state["out"], ""), rest)

    return F.when(F.size(spans) == 0, body).otherwise(F.aggregate(spans, start, cut, end))
