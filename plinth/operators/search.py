"""Ranked full-text search with a substring fallback, and table-cell search.

A query is words joined by AND (the default), OR and NOT, with "phrases", prefix*, NEAR(groups, 10) and parentheses. Anything else, such
as a hyphenated code, is no valid query and goes to the fallback, as does a query that finds nothing: a substring
search that ignores the case of A-Z only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.text import ACCENTED, PLAIN, contains_nocase, tokens

_LEXEME = re.compile(r'\s+|"((?:[^"]|"")*)"(\s*\*)?|([()])|NEAR\s*\(((?:\s|"(?:[^"]|"")*"|[^\W_]|\*)+)(?:,\s*(\d+)\s*)?\)|([^\W_]+)(\*)?', re.U)
#: Words between the phrases of a NEAR group where none are stated (fixed value).
NEAR_WORDS = 10
K1, B = 1.2, 0.75


class QuerySyntaxError(ValueError):
    """The text is no full-text query."""


@dataclass(frozen=True)
class Term:
    """A word, a phrase or the start of a word."""

    words: tuple[str, ...]
    prefix: bool = False


@dataclass(frozen=True)
class Near:
    """Phrases that all begin at most ``distance`` words after the end of the first of them."""

    terms: tuple[Term, ...]
    distance: int


def _fold(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[^\W_]+", text.lower().translate(str.maketrans(ACCENTED, PLAIN))))


def parse(query: str):
    """A tree of Term, Near and ("and" | "or" | "not", left, right); raises QuerySyntaxError."""
    at, found = 0, []
    while at < len(query):
        m = _LEXEME.match(query, at)
        if not m:
            raise QuerySyntaxError(query)
        at = m.end()
        if m[1] is not None:
            words = _fold(m[1])
            if words:
                found.append(Term(words, bool(m[2])))
        elif m[3]:
            found.append(m[3])
        elif m[4]:
            inner = parse(m[4])
            group = tuple(leaves(inner))
            if not _all_and(inner) or any(not isinstance(t, Term) for t in group):
                raise QuerySyntaxError(query)
            found.append(Near(group, int(m[5] or NEAR_WORDS)) if len(group) > 1 else group[0])
        elif m[6]:
            found.append(m[6] if m[6] in ("AND", "OR", "NOT") and not m[7] else Term(_fold(m[6]), bool(m[7])))
    place = 0

    def peek():
        return found[place] if place < len(found) else None

    def primary():
        nonlocal place
        x = peek()
        if x == "(":
            place += 1
            tree = either()
            if peek() != ")":
                raise QuerySyntaxError(query)
            place += 1
            return tree
        if not isinstance(x, (Term, Near)):
            raise QuerySyntaxError(query)
        place += 1
        return x

    def without():
        nonlocal place
        tree = primary()
        while peek() == "NOT":
            place += 1
            tree = ("not", tree, primary())
        return tree

    def both():
        nonlocal place
        tree = without()
        while isinstance(peek(), (Term, Near)) or peek() in ("AND", "("):
            if peek() == "AND":
                place += 1
            tree = ("and", tree, without())
        return tree

    def either():
        nonlocal place
        tree = both()
        while peek() == "OR":
            place += 1
            tree = ("or", tree, both())
        return tree

    tree = either()
    if place != len(found):
        raise QuerySyntaxError(query)
    return tree


def _all_and(tree) -> bool:
    return not isinstance(tree, tuple) or (tree[0] == "and" and _all_and(tree[1]) and _all_and(tree[2]))


def leaves(tree) -> list[Term | Near]:
    return [tree] if not isinstance(tree, tuple) else list(dict.fromkeys(leaves(tree[1]) + leaves(tree[2])))


def _count(term: Term) -> Column:
    """Occurrences of a term in the ``tokens`` column."""
    if len(term.words) == 1 and not term.prefix:
        return F.size(F.filter("tokens", lambda x: x == term.words[0]))
    # words hold letters and digits only, so they are literal in the pattern
    # only the first is consumed, so that hits may overlap
    rest = "".join(f" {w}" for w in term.words[1:]) + ("" if term.prefix else " ")
    pattern = "(?<= )" + term.words[0] + (f"(?={rest})" if rest else "")
    return F.regexp_count(F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" ")), F.lit(pattern))


def _counted(content: DataFrame, tree) -> tuple[DataFrame, Column]:
    """``content`` with ``length`` and a count ``f0``, ``f1``.. per term of the tree, and the tree as a condition."""
    terms = leaves(tree)
    counted = content.select("record_kind", "record_id", "content", tokens(F.col("content")).alias("tokens"))
    counted = counted.select("record_kind", "record_id", "content", F.size("tokens").alias("length"), *[_count(t).alias(f"f{i}") for i, t in enumerate(terms)])

    def holds(node) -> Column:
        if isinstance(node, Term):
            return F.col(f"f{terms.index(node)}") > 0
        a, b = holds(node[1]), holds(node[2])
        return a & b if node[0] == "and" else a | b if node[0] == "or" else a & ~b

    return counted, holds(tree)


def _facts(counted: DataFrame) -> DataFrame:
    fs = [c for c in counted.columns if c[0] == "f"]
    return counted.agg(F.count("*").alias("n_all"), F.avg("length").alias("mean"), *[F.count_if(F.col(f) > 0).alias(f"n{f[1:]}") for f in fs])


def _rank(n: int) -> Column:
    """The rank over columns of :func:`_counted` and :func:`_facts`."""
    total = F.lit(0.0)
    for i in range(n):
        f, df = F.col(f"f{i}"), F.col(f"n{i}")
        idf = F.ln((F.col("n_all") - df + 0.5) / (df + 0.5))
        total = total + F.when(idf > 0, idf).otherwise(1e-6) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return -total


def ranked(content: DataFrame, query: str, limit: int | None) -> DataFrame:
    """The best ``limit`` rows of ``content(record_kind, record_id, content)`` with ``rank`` (smaller is better); all hits,
    in no order, without a limit.

    rank = - sum of idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * length / mean length)) over the query's terms, idf =
    ln((N - n + 0.5) / (n + 0.5)), 1e-6 where that is not positive. Two scans: one for N, n and the mean length (one
    row comes back into the plan by broadcast), one to rank; only top rows are sorted.
    """
    tree = parse(query)
    if any(isinstance(x, Near) for x in leaves(tree)):
        found = content.join(_by_position(content, tree), ["record_kind", "record_id"]).select("record_kind", "record_id", "content", "rank")
    else:
        counted, condition = _counted(content, tree)
        hits = counted.filter(condition).join(F.broadcast(_facts(counted)), F.lit(True))
        found = hits.select("record_kind", "record_id", "content", _rank(len(leaves(tree))).alias("rank"))
    return found if limit is None else found.orderBy("rank", "record_kind", "record_id").limit(limit)


def _by_position(content: DataFrame, tree) -> DataFrame:
    """``(record_kind, record_id, rank)`` of the hits of a query that needs the places of its words."""
    from plinth.operators import postings  # which needs the parser above

    n, total = content.agg(F.count("*"), F.sum(F.size(tokens(F.col("content"))))).first()
    return postings.hits(postings.positions(content).filter(postings.wanted(tree)), tree, n, total)


def substring(content: DataFrame, query: str, limit: int) -> DataFrame:
    hits = content.filter(contains_nocase(F.col("content"), F.lit(query)))
    return hits.select("record_kind", "record_id", "content", F.lit(None).cast("double").alias("rank")).orderBy("record_kind", "record_id").limit(limit)


def search_text(content: DataFrame, query: str, limit: int = 20, index=None, kind: str | None = None) -> DataFrame:
    """``(record_kind, record_id, content, rank, path)``: ranked hits, or substring hits where there are none.

    With a stored ``index`` (:class:`plinth.operators.postings.Index`) only the postings of the query's words are read; hits of
    the ``kind`` that ``content`` holds are kept, and the rank counts all records of the index. Without an index texts are taken apart once: term counts (not texts) are kept while the top ``limit`` ids are found. Either way only those
    rows are fetched, and the substring search is planned only after an empty answer.
    """
    if isinstance(limit, bool) or not isinstance(limit, int) or limit < 1:
        raise ValueError("limit must be a positive integer")
    if not query.strip():
        return substring(content.limit(0), query, limit).withColumn("path", F.lit("blank"))
    plain = substring(content, query, limit).withColumn("path", F.lit("substring"))
    try:
        tree = parse(query)
    except QuerySyntaxError:
        return plain
    order = ["rank", "record_kind", "record_id"]
    if index is not None:
        from plinth.operators import postings  # which needs the parser above

        found = postings.search(index, query)
        found = found if kind is None else found.filter(F.col("record_kind") == kind)
        top = found.orderBy(*order).limit(limit).collect()
    elif any(isinstance(x, Near) for x in leaves(tree)):
        top = _by_position(content, tree).orderBy(*order).limit(limit).collect()
    else:
        counted, condition = _counted(content, tree)
        light = counted.drop("content").persist()
        try:
            facts = {k: F.lit(v).alias(k) for k, v in _facts(light).first().asDict().items()}
            hits = light.filter(condition).select("*", *facts.values())
            top = hits.select("record_kind", "record_id", _rank(len(leaves(tree))).alias("rank")).orderBy(*order).limit(limit).collect()
        finally:
            light.unpersist()
    if not top:
        return plain
    best = content.sparkSession.createDataFrame(top, "record_kind string, record_id string, rank double")
    found = content.join(F.broadcast(best), ["record_kind", "record_id"]).orderBy(*order)
    return found.select("record_kind", "record_id", "content", "rank", F.lit("ranked").alias("path"))


def build_index(content: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``postings(term, record_kind, record_id, tf)`` and ``lengths(record_kind, record_id, length)`` to be stored."""
    words = content.select("record_kind", "record_id", tokens(F.col("content")).alias("tokens"))
    postings = words.select("record_kind", "record_id", F.explode("tokens").alias("term")).groupBy("term", "record_kind", "record_id").agg(F.count("*").alias("tf"))
    return postings, words.select("record_kind", "record_id", F.size("tokens").alias("length"))


def index_differences(content: DataFrame, postings: DataFrame) -> DataFrame:
    """Postings that are stored but wrong, or missing: empty for a sound index."""
    now, _ = build_index(content)
    keys = ["term", "record_kind", "record_id", "tf"]
    # both ways in one count by sign, so that the postings are shuffled once
    signed = postings.select(*keys, F.lit(1).alias("n")).unionByName(now.select(*keys, F.lit(-1).alias("n")))
    odd = signed.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")
    return odd.select(*keys, F.explode(F.array_repeat(F.when(F.col("n") > 0, "stale").otherwise("missing"), F.abs("n").cast("int"))).alias("problem"))


def search_cells(cells: DataFrame, query: str, order: list[str], limit: int = 20, text_col: str = "text") -> DataFrame:
    """Case-sensitive substring search in reading order."""
    if not query.strip():
        return cells.limit(0)
    return cells.filter(F.col(text_col).contains(query)).orderBy(*order).limit(limit)
