"""Secrets found through a trigram index: Boolean queries from the rules, postings, verification.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import re._parser as regex_tree
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

Query = frozenset  # of clauses, one of which must hold; a clause is a set of trigrams, all needed
ALWAYS: Query = frozenset([frozenset()])
MARK, OTHER = "\x01", "\x02"
MOST_STRINGS = 64  # alternatives spelled out before a run of literals is turned into a query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of one of the expression's groups."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# fixed values: the three base kinds, in the order in which they are listed
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so a short one can fail at once
)
# kinds that the index makes cheap to add
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("webhook", r"https://hooks\.[a-z0-9.-]+/services/[A-Za-z0-9/]{20,}"),
)
RULES = BASE_RULES + MORE_RULES


def _either(queries: Iterable[Query]) -> Query:
    clauses = frozenset().union(*queries)
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _both(a: Query, b: Query) -> Query:
    return _either([frozenset(x | y for x, y in product(a, b))])


def _of_strings(strings: Iterable[str]) -> Query:
    """Each string needs all its trigrams, in lower case; a short one needs none."""
    return _either(
        [frozenset([frozenset(s[i : i + 3].lower() for i in range(len(s) - 2))]) for s in strings]
    )


def _walk(tree) -> tuple[set[str] | None, Query]:
    """The strings that a subexpression can only be (or ``None``), and the query it implies."""
    query, run = ALWAYS, {""}
    exact = True
    for op, value in tree:
        name = str(op)
        strings, own = None, ALWAYS
        if name == "LITERAL":
            strings = {chr(value)}
        elif name == "IN" and len(value) <= 4 and all(str(k) == "LITERAL" for k, _ in value):
            strings = {chr(v) for _, v in value}
        elif name == "SUBPATTERN":
            strings, own = _walk(value[3])
        elif name == "BRANCH":
            branches = [_walk(b) for b in value[1]]
            if all(s is not None for s, _ in branches):
                strings = set().union(*(s for s, _ in branches))
            own = _either([q if s is None else _of_strings(s) for s, q in branches])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            inner_strings, inner_query = _walk(inner)
            if (least, most) == (0, 1) and inner_strings is not None:
                strings = inner_strings | {""}
            elif least == most == 1:
                strings, own = inner_strings, inner_query
            elif least >= 1:
                own = inner_query if inner_strings is None else _of_strings(inner_strings)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            strings = {""}
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        # what can't be spelled out ends the run of literals
        exact = False
        query = _both(query, _of_strings(run))
        query = _both(query, own if strings is None else _of_strings(strings))
        run = {""}
    if exact:
        return run, _of_strings(run)
    return None, _both(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The trigrams a text needs to match ``pattern``, as alternatives of sets, in lower case.

    ``ALWAYS`` when some match needs none: then the rule has to scan every text.
    """
    return _walk(regex_tree.parse(pattern))[1]


def _guarded(text: Column) -> Column:
    """The text with the mark replaced by another character that no rule can match."""
    return F.when(text.contains(MARK), F.translate(text, MARK, OTHER)).otherwise(text)


def _pieces(text: Column, rule: Rule) -> Column:
    """The text cut at the matches; every other piece, beginning with the second, is a match."""
    cut = F.split(F.regexp_replace(text, rule.pattern, f"{MARK}$0{MARK}"), MARK)
    return F.transform(
        cut,
        lambda piece, i: F.struct(
            F.length(piece).cast("long").alias("length"),
            F.when(
                (i % 2 == 1) & (F.length(F.regexp_extract(piece, rule.pattern, rule.group)) >= rule.least),
                True,
            ).otherwise(False).alias("hit"),
        ),
    )


def _matched(text: Column, rules: Sequence[Rule], needed: Sequence[Column]) -> Column:
    """Per rule that is needed and matches: its kind and pieces."""
    found = []
    for rule, need in zip(rules, needed):
        pieces = F.when(need & text.rlike(rule.pattern), _pieces(text, rule))
        found.append(
            F.when(
                pieces.isNotNull(), F.struct(F.lit(rule.kind).alias("kind"), pieces.alias("pieces"))
            )
        )
    return F.array_compact(F.array(*found))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id_key"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        _guarded(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    )


@dataclass(frozen=True)
class TrigramIndex:
    """``documents``: one row per document with what full scans found. ``postings``: one row per
    trigram and document, for the trigrams that some rule asks for."""

    documents: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, rules: Sequence[Rule], id_col: str, text_col: str) -> TrigramIndex:
    """One scan: postings of the rules' trigrams, and the matches of rules that have none.

    Only trigrams that occur in a query get a posting list, so the index is a small fraction of
    the text whatever its size.
    """
    grams = sorted({g for r in rules for clause in trigram_query(r.pattern) for g in clause})
    scanned = [r for r in rules if trigram_query(r.pattern) == ALWAYS]
    keyed = _keyed(docs, id_col, text_col).withColumn("low", F.lower("text"))
    rows = stored(
        keyed.select(
            "doc_id", "id_key", "text_key",
            F.array_compact(
                F.array(*[F.when(F.col("low").contains(g), F.lit(g)) for g in grams])
                if grams
                else F.array().cast("array<string>")
            ).alias("grams"),
            (
                _matched(F.col("text"), scanned, [F.lit(True)] * len(scanned))
                if scanned
                else F.array().cast("array<struct<kind:string,pieces:array<struct<length:bigint,hit:boolean>>>>")
            ).alias("found"),
        ),
        "trigrams",
    )
    return TrigramIndex(rows, rows.select(F.explode("grams").alias("gram"), "id_key", "text_key"))


def candidates(index: TrigramIndex, rules: Sequence[Rule]) -> DataFrame:
    """(id_key, text_key, rules): the indexed rules whose query a document's postings satisfy."""
    lists = index.postings.groupBy("id_key", "text_key").agg(F.collect_set("gram").alias("grams"))
    able = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        if query == ALWAYS:
            continue
        holds = F.lit(False)
        for clause in sorted(query, key=sorted):
            every = F.lit(True)
            for gram in sorted(clause):
                every = every & F.array_contains("grams", gram)
            holds = holds | every
        able.append(F.when(holds, F.lit(rule.kind)))
    if not able:
        return lists.select("id_key", "text_key", F.array().cast("array<string>").alias("rules")).limit(0)
    return lists.select(
        "id_key", "text_key", F.array_compact(F.array(*able)).alias("rules")
    ).where(F.size("rules") > 0)


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``spans``, an array of (start, rank, end, kind) in order.

    Positions are code points, ends exclusive; matches of one kind are leftmost and do not
    overlap. Texts that the index rules out are never matched against a rule that has mandatory
    trigrams; rules without any are matched against all texts during the index scan.

    A null text counts as empty and has no spans. Repeated rows each keep their row; a null id is
    an id like others. An empty table gives no rows. Only the two named columns are read.
    """
    index = build_index(docs, rules, id_col, text_col)
    wanted = candidates(index, rules)
    indexed = [r for r in rules if trigram_query(r.pattern) != ALWAYS]
    checked = (
        _keyed(docs, id_col, text_col)
        .join(wanted, ["id_key", "text_key"])
        .select(
            "id_key", "text_key",
            (
                _matched(
                    F.col("text"), indexed, [F.array_contains("rules", r.kind) for r in indexed]
                )
                if indexed
                else F.array().cast("array<struct<kind:string,pieces:array<struct<length:bigint,hit:boolean>>>>")
            ).alias("found"),
        )
    )
    pieces = (
        index.documents.select("id_key", "text_key", "found")
        .union(checked)
        .select("id_key", "text_key", F.explode("found").alias("f"))
        .select("id_key", "text_key", "f.kind", F.posexplode("f.pieces").alias("at", "piece"))
        .select("id_key", "text_key", "kind", "at", "piece.length", "piece.hit")
        .dropDuplicates(["id_key", "text_key", "kind", "at"])
    )
    order = Window.partitionBy("id_key", "text_key", "kind").orderBy("at")
    rank = F.coalesce(*[F.when(F.col("kind") == r.kind, F.lit(i)) for i, r in enumerate(rules)])
    spans = (
        pieces.withColumn("end", F.sum("length").over(order))
        .where("hit")
        .groupBy("id_key", "text_key")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (F.col("end") - F.col("length")).alias("start"),
                        rank.alias("rank"),
                        F.col("end"),
                        F.col("kind"),
                    )
                )
            ).alias("spans")
        )
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return (
        index.documents.select("doc_id", "id_key", "text_key")
        .join(spans, ["id_key", "text_key"], "left")
        .select("doc_id", F.coalesce("spans", none).alias("spans"))
    )


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts, checksum and list of the spans that :func:`find_secrets` returns."""
    base = [r.kind for r in BASE_RULES]

    def text(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
