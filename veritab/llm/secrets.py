"""Secret scan with a trigram index, in DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import numbered, stored

#: Rows that share posting lists; a list has at most one entry per row.
SEGMENT_BITS = 12


@dataclass(frozen=True)
class Rule:
    """Matches of a pattern of which a group has ``least`` characters at least; shorter ones are dropped after matching."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Kinds in order, their patterns, the group that is measured, and its least length.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)


ANY = frozenset([frozenset()])  # a query that every text meets: one alternative without trigrams


def _of_strings(strings: frozenset[str]) -> frozenset[frozenset[str]]:
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _both(a, b):
    return frozenset(x | y for x in a for y in b)


def _sequence(nodes, most: int = 64):
    """(all strings that the nodes match, or None if there are too many; the trigram query of the nodes)."""
    query, strings, whole = ANY, frozenset([""]), True
    for op, arg in nodes:
        own, own_query = _node(str(op), arg)
        if own is not None and len(strings) * len(own) <= most:
            strings = frozenset(a + b for a in strings for b in own)
            continue
        query = _both(_both(query, _of_strings(strings)), own_query if own is None else ANY)
        strings, whole = (frozenset([""]) if own is None else own), False
    return (strings if whole else None), _both(query, _of_strings(strings))


def _node(op: str, arg):
    if op == "LITERAL":
        return frozenset([chr(arg).lower()]), ANY
    if op == "IN" and len(arg) <= 4 and all(str(k) == "LITERAL" for k, _ in arg):
        return frozenset(chr(c).lower() for _, c in arg), ANY
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        parts = [_sequence(b) for b in arg[1]]
        strings = None if any(s is None for s, _ in parts) else frozenset().union(*(s for s, _ in parts))
        return strings, frozenset().union(*(q for _, q in parts))
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, body = arg
        strings, query = _sequence(body)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANY
        return None, (query if low else ANY)
    return None, ANY


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams: a text that the pattern matches holds all of one of them.

    Literal pieces that stand next to each other are put together; classes of a few characters and optional pieces
    are written out; anything else breaks the piece. An alternative that has no trigram makes the pattern one that
    has to look at every text.
    """
    query = _sequence(re._parser.parse(pattern))[1]
    return frozenset(a for a in query if not any(b < a for b in query))


def candidates(docs: DataFrame, row: str, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kinds): which rules' trigram queries a text meets. Rules without mandatory trigrams are left out."""
    queries = {r.kind: q for r in rules if frozenset() not in (q := trigram_query(r.pattern))}
    wanted = sorted({t for q in queries.values() for a in q for t in a})
    present = F.filter(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in wanted]), lambda t: t.isNotNull())
    postings = (
        docs.select(F.col(row).alias("row"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"))
        .select("row", F.explode(present).alias("trigram"))
        .groupBy(F.shiftright("row", SEGMENT_BITS).alias("segment"), "trigram")
        .agg(F.collect_list("row").alias("rows"))
    )
    index = postings.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "rows"))).alias("postings"))

    def of(trigram: str) -> Column:
        return F.coalesce(F.element_at("postings", F.lit(trigram)), F.array().cast("array<bigint>"))

    def met(query) -> Column:
        alternatives = [reduce(F.array_intersect, [of(t) for t in sorted(a)]) for a in sorted(query, key=sorted)]
        return reduce(F.array_union, alternatives)

    found = [index.select(F.explode(met(q)).alias("row"), F.lit(k).alias("kind")) for k, q in queries.items()]
    if not found:
        return docs.limit(0).select(F.col(row).alias("row"), F.array().cast("array<string>").alias("kinds"))
    return reduce(DataFrame.unionByName, found).groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def _matches(text: str, rule: Rule, number: int, only: Column | None) -> Column:
    """Of each match: the length before it, its own, and that of the measured group."""
    value = F.col(text) if only is None else F.when(only, F.col(text))
    pattern = F.lit(rule.pattern)
    gaps = F.split(value, rule.pattern, -1)
    whole = F.regexp_extract_all(value, pattern, F.lit(0))
    measured = F.regexp_extract_all(value, pattern, F.lit(rule.group))
    return F.transform(
        whole,
        lambda m, i: F.struct(
            F.lit(number).alias("number"),
            i.alias("nth"),
            F.length(F.get(gaps, i)).cast("long").alias("gap"),
            F.length(m).cast("long").alias("length"),
            F.length(F.get(measured, i)).alias("measured"),
        ),
    )


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of secrets, one row per document: the id, ``found`` (array of start, number of the rule, end), in order.

    Starts and ends count code points; an end is exclusive. Matches of a rule are leftmost and do not overlap.

    From each rule's pattern comes a Boolean query of trigrams. Posting lists (which rows hold a trigram; only
    trigrams that a query asks for) are kept for segments of 4096 rows, intersected and united as the queries say,
    and candidates are verified with the pattern. Rules without mandatory trigrams scan every text. Positions come
    from the lengths of matches and of the pieces between them, summed per document.

    Null texts count as empty and have no spans. Rows may repeat, ids may be null. Other columns are ignored.
    """
    narrow = docs.select(F.col(id_column).alias("id_value"), F.col(text_column).cast("string").alias("text_value"))
    rows, row = numbered(narrow, "texts")
    all_rows = [i for i, r in enumerate(rules) if frozenset() in trigram_query(r.pattern)]
    chosen = stored(candidates(rows, row, "text_value", rules), "candidates")

    def spans(frame: DataFrame, numbers: list[int], flagged: bool) -> DataFrame:
        arrays = [_matches("text_value", rules[i], i, F.array_contains("kinds", rules[i].kind) if flagged else None) for i in numbers]
        each = F.coalesce(F.concat(*[F.coalesce(a, F.array()) for a in arrays]) if len(arrays) > 1 else arrays[0], F.array())
        return frame.select(row, F.explode(each).alias("m")).select(row, "m.*")

    parts = []
    if all_rows:
        parts.append(spans(rows, all_rows, False))
    if len(all_rows) < len(rules):
        verified = rows.join(chosen.withColumnRenamed("row", row), row)
        parts.append(spans(verified, [i for i in range(len(rules)) if i not in all_rows], True))
    order = Window.partitionBy(row, "number").orderBy("nth")
    ends = F.sum(F.col("gap") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("number") + 1)
    placed = reduce(DataFrame.unionByName, parts).withColumn("end", ends).where(F.col("measured") >= least)
    found = placed.groupBy(row).agg(
        F.sort_array(F.collect_list(F.struct((F.col("end") - F.col("length")).alias("start"), "number", "end"))).alias("found")
    )
    out = rows.select(row, "id_value").join(found, row, "left")
    none = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")
    return out.select(F.col("id_value").alias(id_column), F.coalesce("found", none).alias("found"))


def secret_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts of spans by kind, all spans as text, and its hash. All spans are base spans: the index adds none."""
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    spans = F.array_join(
        F.transform("found", lambda s: F.concat_ws(":", F.element_at(kinds, s["number"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )

    def count(number: int) -> Column:
        return F.size(F.filter("found", lambda s: s["number"] == number)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(RULES)]
    out = secret_spans(docs, id_column, text_column).withColumn("spans", spans)
    return out.select(id_column, *counts, F.sha2("spans", 256).alias("base_sha256"), "spans")
