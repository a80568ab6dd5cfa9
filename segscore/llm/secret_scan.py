"""Secret scan with a trigram inverted index [native].

Each rule's regex gives a Boolean trigram query, read off its parse tree: an OR
over the strings that a match must contain one of, each the AND of its trigrams
(of the lower-cased text if letters may have either case). The index is inverted over
the rules' trigrams: postings ``(trigram, document)``; intersecting them is a
count of a literal's trigrams by (document, literal). Candidates are verified
with the regex. A rule without mandatory trigrams (``hex``) scans every text.

Match positions come from SQL functions alone: the texts between matches
(``split``) and the matches (``regexp_extract_all``) add up to code-point
offsets.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from re import _parser as sre  # parse trees of patterns

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; one counts if the
    text of ``group`` has ``least`` or more characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def any_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# fixed values: the three rules in their order
RULES = (
    Rule("assign", "(" + any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    # maximal runs of 24 and more are the [0-9a-f]+ matches that are long enough
    Rule("hex", "[0-9a-f]{24,}", least=24),
)


def trigrams(literal: str) -> list[str]:
    return sorted({literal[i:i + 3] for i in range(len(literal) - 2)})


#: Texts that one part of a pattern may stand for before it is taken as unknown.
ALTERNATIVES = 64


def strings_of(node: tuple, fold: bool) -> set[str] | None:
    """Every text that a node of a parsed pattern matches, if they are few."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg)} if not fold else {chr(arg).lower()} if arg < 128 else None
    if op is sre.IN:
        found: set[str] = set()
        for kind, x in arg:
            if kind is sre.LITERAL:
                found.add(chr(x))
            elif kind is sre.RANGE and x[1] - x[0] < ALTERNATIVES:
                found.update(map(chr, range(x[0], x[1] + 1)))
            else:
                return None
        if fold:
            if not all(c.isascii() for c in found):
                return None
            found = {c.lower() for c in found}
        return found if len(found) <= ALTERNATIVES else None
    if op is sre.SUBPATTERN:
        return sequence(list(arg[3]), fold)
    if op is sre.BRANCH:
        parts = [sequence(list(p), fold) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = arg
        one = sequence(list(body), fold)
        if one is None or most > 4:
            return None
        out: set[str] = set()
        for n in range(least, most + 1):
            out |= joined([one] * n) or set()
            if len(out) > ALTERNATIVES:
                return None
        return out
    if op is sre.AT:
        return {""}
    return None


def joined(parts: list[set[str]]) -> set[str] | None:
    out = {""}
    for p in parts:
        if len(out) * len(p) > ALTERNATIVES:
            return None
        out = {x + y for x in out for y in p}
    return out


def sequence(nodes: list[tuple], fold: bool) -> set[str] | None:
    parts = [strings_of(n, fold) for n in nodes]
    return None if None in parts else joined(parts)


def stretches(nodes: list[tuple], fold: bool) -> list[set[str]]:
    """The stretches of a sequence whose texts are known, each a set of
    alternatives one of which every match holds. What repeats at least once
    counts as one occurrence, what may be missing as nothing known."""
    out: list[set[str]] = []
    run: list[set[str]] = []

    def flush() -> None:
        nonlocal run
        if run:
            out.append(joined(run) or {""})
        run = []

    for op, arg in nodes:
        known = strings_of((op, arg), fold)
        if known is not None and joined([*run, known]) is not None:
            run.append(known)
            continue
        flush()
        if known is not None:
            run = [known]
        elif op is sre.SUBPATTERN:
            out += stretches(list(arg[3]), fold)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            out += stretches(list(arg[2]), fold)
        elif op is sre.BRANCH:  # one stretch of each alternative, if all have one
            best = [max(stretches(list(p), fold), key=worth, default={""}) for p in arg[1]]
            if len(set().union(*best)) <= ALTERNATIVES:
                out.append(set().union(*best))
    flush()
    return out


def worth(alternatives: set[str]) -> int:
    """Trigrams that the poorest alternative has: 0 says that nothing is mandatory."""
    return min((len(trigrams(x)) for x in alternatives), default=0)


@dataclass
class Query:
    """Boolean trigram queries of the rules: ``branches`` (rule, either_case, trigrams)."""

    branches: list[tuple[str, bool, list[str]]] = field(default_factory=list)
    full: list[str] = field(default_factory=list)  # rules that scan every text


def mandatory(pattern: str) -> tuple[bool, list[list[str]]]:
    """(whether case is folded, an OR of ANDs of trigrams) that every match of
    ``pattern`` satisfies, from its parse tree: alternatives are an OR, a
    sequence is an AND, and what may be missing asks for nothing. Of a
    pattern's stretches the one with most trigrams is asked for, in lower case
    if that leaves fewer alternatives. An empty list says that nothing is mandatory."""
    nodes = list(sre.parse(pattern))
    found = []
    for fold in (True,) if re.search(r"\(\?[a-zA-Z]*i", pattern) else (False, True):
        best = max(stretches(nodes, fold), key=worth, default={""})
        found.append((worth(best), fold, sorted(best)))
    n, fold, best = max(found, key=lambda x: (x[0] > 0, -len(x[2]), x[0], not x[1]))
    grams = [trigrams(x) for x in best] if n else []
    least = [g for g in grams if not any(set(o) < set(g) for o in grams)]  # what asks for more than another alternative adds nothing
    return fold, sorted(map(list, set(map(tuple, least))))


def boolean_query(rules: tuple[Rule, ...]) -> Query:
    q = Query()
    for r in rules:
        fold, branches = mandatory(r.pattern)
        if not branches:  # some match need not contain a trigram
            q.full.append(r.kind)
        else:
            q.branches += [(r.kind, fold, g) for g in branches]
    return q


def postings(df: DataFrame, id_col: str, text_col: str, query: Query) -> DataFrame:
    """``(gram, doc)``: the inverted index over the rules' trigrams. A posting's
    gram is numbered; each text's trigrams are read off in one pass."""
    grams = sorted({(either, g) for _, either, gs in query.branches for g in gs})
    low = F.lower(F.col("_t"))
    has = [F.when((low if either else F.col("_t")).contains(g), F.lit(i)) for i, (either, g) in enumerate(grams)]
    found = F.array_compact(F.array(*has)) if has else F.array().cast("array<int>")
    return (df.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
            .select("doc", F.explode(found).alias("gram")).distinct())


def candidates(df: DataFrame, id_col: str, text_col: str, query: Query) -> DataFrame:
    """``(doc, kinds)``: per document id the rules whose Boolean query its
    postings satisfy. Rows of one id share postings, which only adds candidates."""
    grams = sorted({(either, g) for _, either, gs in query.branches for g in gs})
    number = {g: i for i, g in enumerate(grams)}
    wants = [(b, kind, number[either, g], len(gs)) for b, (kind, either, gs) in enumerate(query.branches) for g in gs]
    plan = df.sparkSession.createDataFrame(wants, "branch int, kind string, gram int, need int")  # the rules: a fixed few
    met = (postings(df, id_col, text_col, query).join(F.broadcast(plan), "gram")
           .groupBy("doc", "branch", "kind", "need").agg(F.count(F.lit(1)).alias("n")).filter("n = need"))
    return met.groupBy("doc").agg(F.collect_set("kind").alias("kinds"))  # at most one entry a rule


def matches(rule: Rule, order: int, text: Column) -> Column:
    """Spans (start, rank of the rule, end) of the rule's matches in ``text``."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("hit"), kept.alias("part"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        more = F.when(F.char_length(x["part"]) >= rule.least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda acc: acc["spans"])


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``df`` with ``spans``: an array of (start, kind,
    end) in code points, end exclusive, by start, then rule. Columns named
    ``spans`` are replaced.

    Null texts have no spans. Ids may be null or repeat: candidates are sought
    by id and verified by row. An empty table gives an empty result."""
    df = df.drop(*[c for c in ("spans",) if c not in (id_col, text_col)])
    query = boolean_query(rules)
    flags = candidates(df.select(id_col, text_col), id_col, text_col, query).withColumnRenamed("doc", "_c_doc").withColumnRenamed("kinds", "_c_kinds")
    joined = df.join(flags, F.col(id_col).eqNullSafe(F.col("_c_doc")), "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = []
    for i, rule in enumerate(rules):
        hit = F.lit(True) if rule.kind in query.full else F.coalesce(F.array_contains("_c_kinds", rule.kind), F.lit(False))
        found.append(F.when(hit & text.rlike(rule.pattern), matches(rule, i, text)).otherwise(none))
    joined = joined.withColumn("_c_spans", F.array_sort(F.concat(*found)))
    names = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform("_c_spans", lambda s: F.struct(
        s["start"].alias("start"), F.element_at(names, s["kind"] + 1).alias("kind"), s["end"].alias("end")))
    return joined.select(*df.columns, spans.alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: str):
    return lambda span: span["kind"] == kind
