"""Secret scans through a trigram inverted index, in DataFrame functions alone.

Each rule's regular expression is turned into a Boolean query of trigrams which every match must
contain. The index holds, for each of these trigrams, the documents whose lower-cased text contains
it. The postings are intersected per document, and only documents that satisfy a rule's query are
searched with its expression. A rule without mandatory trigrams is searched for in every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sipnote.llm.common import maybe_broadcast, whole
from sipnote.session import written


@dataclass(frozen=True)
class Rule:
    """``least`` is the fewest characters that ``group`` of a match must have to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# A query: None (no document can be ruled out), a trigram, or ("and" | "or", queries).
Query = None | str | tuple
MOST_STRINGS = 64


def _all(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return ("and", tuple(parts)) if len(parts) > 1 else parts[0] if parts else None


def _any(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return None if None in parts else ("or", tuple(parts)) if len(parts) > 1 else parts[0]


def _of_strings(strings: set[str]) -> Query:
    """Every match contains one of ``strings``; strings that ask for more than another are left out."""
    asked = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    least = sorted(sorted(a) for a in asked if not any(b < a for b in asked))
    return _any([_all(list(a)) for a in least])


def _exact(items) -> set[str] | None:
    """The strings a sequence matches, lower-cased, or None if they are too many."""
    strings = {""}
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            new = {chr(value).lower()}
        elif name == "IN" and len(value) <= 8 and all(str(o) == "LITERAL" for o, _ in value):
            new = {chr(v).lower() for _, v in value}
        elif name == "SUBPATTERN":
            new = _exact(value[3])
        elif name == "BRANCH":
            each = [_exact(x) for x in value[1]]
            new = None if None in each else set().union(*each)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and int(value[1]) <= 5:
            one = _exact(value[2])
            new = None if one is None else {""} if value[0] == 0 else set()
            for n in range(max(1, int(value[0])), int(value[1]) + 1) if one is not None else ():
                new |= {"".join(x) for x in product(one, repeat=n)} if len(one) ** n <= MOST_STRINGS else {None}
            new = None if new is None or None in new else new
        else:
            new = None
        if new is None or len(strings) * len(new) > MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in new}
    return strings


def _needed(items) -> Query:
    """The query for a sequence: runs of exactly known strings, and what the rest asks for."""
    found: list[Query] = []
    run: list = []

    def close() -> None:
        if run:
            found.append(_of_strings(_exact(run)))
            run.clear()

    for item in items:
        if _exact([*run, item]) is not None:
            run.append(item)
            continue
        close()
        if _exact([item]) is not None:
            run.append(item)
            continue
        op, value = str(item[0]), item[1]
        if op == "SUBPATTERN":
            found.append(_needed(value[3]))
        elif op == "BRANCH":
            found.append(_any([_needed(x) for x in value[1]]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] >= 1:
            found.append(_needed(value[2]))
    close()
    return _all(found)


def trigram_query(pattern: str) -> Query:
    """Trigrams, as a Boolean query, without which lower-cased text holds no match of ``pattern``."""
    return _needed(re._parser.parse(pattern))


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _condition(query: Query, held: Column) -> Column:
    if query is None:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(held, query)
    parts = [_condition(q, held) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def build_index(docs: DataFrame, wanted: set[str]) -> DataFrame:
    """Postings (trigram, doc_id) of the wanted trigrams over lower-cased whole texts, written."""
    grams = F.array(*[F.lit(t) for t in sorted(wanted)])
    # The lower-cased text is bound once as the variable of a transform, else it is made per trigram.
    held = F.transform(F.array(F.lower("text")), lambda t: F.filter(grams, lambda g: F.contains(t, g)))[0]
    return written(docs.select(F.explode(held).alias("trigram"), "doc_id"), "trigram-postings")


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per document that meets the query of at least one rule: (doc_id, kinds)."""
    kinds = [
        F.when(_condition(q, F.col("held")), F.lit(r.kind))
        for r in rules
        if (q := trigram_query(r.pattern)) is not None
    ]
    return (
        postings.groupBy("doc_id")
        .agg(F.collect_set("trigram").alias("held"))
        .select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds"))
        .where(F.size("kinds") > 0)
    )


def running_sums(lengths: Column) -> Column:
    """Running sums of an array of numbers, by doubling: entry i takes in what entry i - 2**k holds.

    A fold that appends to an array copies it each time; this takes log2 n rounds over it.
    """
    rounds = F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)))).cast("int")
    shifts = F.transform(F.sequence(F.lit(0), rounds), lambda k: F.pow(F.lit(2), k).cast("int"))

    def doubled(sums: Column, shift: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - shift), F.lit(0)))

    return F.aggregate(shifts, lengths, doubled)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, kind, end) in characters, leftmost and without overlap, from the lengths
    of the matches and of the text between them."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    steps = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(counted, F.length).alias("counted"),
    )

    def spans(x: Column) -> Column:
        ends = running_sums(F.transform(x, lambda s: s["gap"] + F.coalesce(s["size"], F.lit(0))))

        def span(s: Column, end: Column) -> Column:
            start = (end - s["size"]).alias("start")
            counts = F.coalesce(s["counted"], F.lit(-1)) >= max(rule.least, 1)
            return F.when(counts, F.struct(start, F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end")))

        return F.array_compact(F.zip_with(x, ends, span))

    # The steps are bound once as the variable of a transform, as they are read more than once.
    return F.transform(F.array(steps), spans)[0]


def _quick(rule: Rule, text: Column) -> Column:
    """A cheap test before the spans of a rule that is searched for everywhere."""
    bounded = re.sub(r"\+$", f"{{{rule.least}}}", rule.pattern) if not rule.group and rule.least else rule.pattern
    return text.rlike(bounded)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found``, the spans of all rules.

    A span is (start, order, kind, end): characters, end exclusive, sorted by start, then by the
    place of its rule. Matches of one rule don't overlap; those of different rules may. Null and
    empty texts have none. Repeated and null ids are searched row by row. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = set().union(*map(trigrams, queries.values()))
    if wanted:
        likely = maybe_broadcast(written(candidates(build_index(rows, wanted), rules), "secret-candidates"), 160)
        likely = likely.withColumnRenamed("doc_id", "_id")
        rows = rows.join(likely, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    text, each = F.col("text"), []
    for order, rule in enumerate(rules):
        likely_here = F.array_contains("kinds", rule.kind) if queries[rule.kind] is not None else _quick(rule, text)
        each.append(F.when(likely_here, _spans(text, rule, order)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*each)).alias("found"))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of :func:`find_secrets`: the contract's columns."""
    spans = F.col("found")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["order"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
