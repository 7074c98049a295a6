"""Search over records: query text to a predicate, relevance, facets and top results."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import search_parser as sp
from millrace.functions.analyzers import text_general
from millrace.session import cut_lineage


@dataclass(frozen=True)
class Field:
    """kind: text (analyzed words), exact (strings as they are), date, number. Columns may be scalars or arrays."""

    column: Column
    kind: str = "text"
    multi: bool = False


class Schema:
    """Names that queries use, and the fields meant where a query names none."""

    def __init__(self, fields: dict[str, Field], default: list[str], synonyms: dict[str, list[str]] | None = None) -> None:
        self.fields, self.default, self.synonyms = fields, default, synonyms or {}

    def get(self, name: str | None) -> list[Field]:
        if name is None:
            return [self.fields[f] for f in self.default]
        for candidate in (name, f"{name}_ss", f"{name}_dts"):
            if candidate in self.fields:
                return [self.fields[candidate]]
        raise sp.QueryError(f"no field {name}")


def _any(field: Field, test) -> Column:
    return F.exists(field.column, test) if field.multi else test(field.column)


def _words(text: str) -> list[str]:
    import re

    return re.findall(r"[\w']+", text.lower())


def _phrase(value: Column, words: list[str], slop: int) -> Column:
    tokens = text_general(value)
    quick = F.lit(True)
    for w in set(words):
        quick = quick & F.contains(F.lower(value), F.lit(w))
    if not slop:
        return quick & F.contains(F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" ")), F.lit(" " + " ".join(words) + " "))
    places = lambda w: F.filter(F.transform(tokens, lambda t, i: F.when(t == w, i)), lambda i: i.isNotNull())
    away = lambda w, goal: F.coalesce(F.array_min(F.transform(places(w), lambda q: F.abs(q - goal))), F.lit(1 << 20))
    moves = lambda p: sum((away(w, p + n) for n, w in enumerate(words[1:], 1)), F.lit(0))
    return quick & F.exists(places(words[0]), lambda p: moves(p) <= slop)


def _holds(word: str):
    return lambda v: F.contains(F.lower(v), F.lit(word)) & F.array_contains(text_general(v), word)


def _bound(kind: str, text: str) -> Column:
    return F.lit(text).try_cast("double") if kind == "number" else F.lit(text)


def _leaf(node, field: Field, synonyms: dict[str, list[str]]) -> Column:
    if isinstance(node, sp.Range):
        if field.kind == "date":
            low = sp.date_span(node.low) if node.low else None
            high = sp.date_span(node.high) if node.high else None
            if (node.low and not low) or (node.high and not high):
                raise sp.QueryError("not a date")
            lo = F.lit(low[0 if node.low_in else 1]).cast("timestamp_ntz") if low else None
            hi = F.lit(high[1 if node.high_in else 0]).cast("timestamp_ntz") if high else None
            inside = lambda v: (F.lit(True) if lo is None else v >= lo) & (v.isNotNull() if hi is None else v < hi)
            return _any(field, inside)

        def within(v: Column) -> Column:
            out = v.isNotNull()
            if node.low is not None:
                out = out & (v >= _bound(field.kind, node.low) if node.low_in else v > _bound(field.kind, node.low))
            if node.high is not None:
                out = out & (v <= _bound(field.kind, node.high) if node.high_in else v < _bound(field.kind, node.high))
            return out

        return _any(field, within)
    if field.kind == "date":
        if not (span := sp.date_span(node.text)):
            return F.lit(False)
        return _any(field, lambda v: (v >= F.lit(span[0]).cast("timestamp_ntz")) & (v < F.lit(span[1]).cast("timestamp_ntz")))
    if field.kind == "number":
        return _any(field, lambda v: v == F.lit(node.text).try_cast("double"))
    if isinstance(node, sp.Phrase):
        if field.kind == "exact":
            return _any(field, lambda v: v == node.text)
        words = _words(node.text)
        return _any(field, lambda v: _phrase(v, words, node.slop)) if words else F.lit(False)
    if field.kind == "exact":
        if node.wildcard:
            return _any(field, lambda v: v.rlike(f"^(?:{sp.wildcard_regex(node.text)})$"))
        return _any(field, lambda v: v == node.text)
    if node.wildcard:
        regex = f"^(?:{sp.wildcard_regex(node.text.lower())})$"
        return _any(field, lambda v: F.exists(text_general(v), lambda t: t.rlike(regex)))
    if node.fuzzy is not None:
        return _any(field, lambda v: F.exists(text_general(v), lambda t: F.levenshtein(t, F.lit(node.text.lower()), node.fuzzy) >= 0))
    words = _words(node.text)
    if not words:
        return F.lit(False)
    if len(words) > 1:
        return _any(field, lambda v: _phrase(v, words, 0))
    out = None
    for w in [words[0], *synonyms.get(words[0], [])]:
        # The plain substring test spares most rows the analysis.
        hit = _any(field, _holds(w))
        out = hit if out is None else out | hit
    return out


def predicate(query: sp.Query | str, schema: Schema, top: bool = True) -> Column:
    """Whether a record matches; never null. A query of nothing but exclusions matches, at the top, what they leave."""
    query = sp.parse(query) if isinstance(query, str) else query
    must, should, excluded = [], [], []
    for occur, node in query.clauses:
        if isinstance(node, sp.Query):
            hit = predicate(node, schema, top=False)
        elif isinstance(node, sp.All):
            hit = F.lit(True)
        else:
            hit = None
            for field in schema.get(node.field):
                one = F.coalesce(_leaf(node, field, schema.synonyms), F.lit(False))
                hit = one if hit is None else hit | one
        (must if occur == sp.MUST else excluded if occur == sp.MUST_NOT else should).append(hit)
    if not (must or should):
        if not (excluded and top):
            return F.lit(False)
        out = F.lit(True)
    elif must:
        out = must[0]
        for hit in must[1:]:
            out = out & hit
    else:
        out = should[0]
        for hit in should[1:]:
            out = out | hit
    for hit in excluded:
        out = out & ~hit
    return out


def search(records: DataFrame, query: str, schema: Schema) -> DataFrame:
    """The records that match. Null fields match nothing."""
    return records.filter(predicate(query, schema))


def without_matches(records: DataFrame, query: str, schema: Schema) -> DataFrame:
    """Delete by query: the records that don't match."""
    return records.filter(~predicate(query, schema))


def facets(records: DataFrame, value: Column, limit: int = 100, min_count: int = 1) -> DataFrame:
    """value, n: the most frequent values of a field, the more frequent first, then by value."""
    counts = records.select(value.alias("value")).filter("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count).orderBy(F.desc("n"), "value").limit(limit)


def bm25(records: DataFrame, id_col: str, text: Column, terms: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """id, score of every record that holds one of the terms (Robertson & Zaragoza 2009).

    The texts are read once, for lengths and term counts; totals and scores come from these. Nothing is shuffled but a
    single row of totals.
    """
    terms = sorted({t.lower() for t in terms})
    tokens = text_general(F.coalesce(text, F.lit("")))
    times = lambda words, word: F.size(F.filter(words, lambda t: t == word))
    # Inside the transform the words are found once for all terms; written down, the counts serve both passes.
    counts = F.transform(F.array(tokens), lambda words: F.struct(F.size(words).alias("len"), *[times(words, w).alias(f"tf{i}") for i, w in enumerate(terms)]))
    counted = cut_lineage(records.select(F.col(id_col), counts[0].alias("c")).select(id_col, "c.*"), "terms")
    totals = counted.agg(F.count("*").alias("n"), F.avg("len").alias("avg"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))]).first()
    score, any_hit = F.lit(0.0), F.lit(False)
    for i in range(len(terms)):
        df = totals[f"df{i}"]
        idf = math.log(1 + (totals["n"] - df + 0.5) / (df + 0.5))
        tf = F.col(f"tf{i}")
        score = score + F.lit(idf) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / F.lit(totals["avg"] or 1.0)))
        any_hit = any_hit | (tf > 0)
    return counted.filter(any_hit).select(id_col, score.alias("score"))


def top(scored: DataFrame, k: int, id_col: str, score_col: str = "score", pinned: list | None = None, excluded: list | None = None) -> DataFrame:
    """The k best by score, then id; pinned ids come first, excluded ones not at all."""
    if excluded:
        scored = scored.filter(~F.col(id_col).isin(excluded))
    first = [F.col(id_col).isin(pinned).desc()] if pinned else []
    return scored.orderBy(*first, F.desc(score_col), id_col).limit(k)
