"""Query strings inside other queries: the clauses of a string as an ordinary boolean query.

The string is split by the same column expressions that split a table of strings (``plans.batch``), here over
one row, so both ways read a string alike.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from ..functions.fields import expand_names
from . import queries as q
from .scope import Scope

#: Clauses are analysed already; their words are taken as they are.
_AS_IS = "whitespace"


def expanded(query: q.Query, scope: Scope) -> q.Query:
    """The query with every query string in it replaced by its clauses, and field patterns by fields."""
    if isinstance(query, q.QueryString):
        return _clauses(query, scope)
    if isinstance(query, q.MultiMatch):
        return _with_fields(query, scope)
    if isinstance(query, q.Bool):
        return replace(query, clauses=[q.Clause(c.occur, [expanded(p, scope) for p in c.queries]) for c in query.clauses])
    if isinstance(query, q.DisMax):
        return replace(query, queries=[expanded(p, scope) for p in query.queries])
    if isinstance(query, q.FunctionScore):
        items = [i if i.filter is None else replace(i, filter=expanded(i.filter, scope)) for i in query.functions]
        return replace(query, query=expanded(query.query, scope), functions=items)
    if isinstance(query, q.Nested):
        if scope.field(query.path) is None:
            return query
        return replace(query, query=expanded(query.query, scope.children(query.path)))
    if isinstance(query, q.ConstantScore):
        return replace(query, query=expanded(query.query, scope))
    return query


def _fields(names: list[str], weights: list[float] | None, scope: Scope) -> list[tuple[str, float]]:
    """Fields with their weights; a pattern stands for the text fields it fits, each taken once."""
    found: dict[str, float] = {}
    path = scope.path + "." if scope.path else ""
    for name, weight in zip(names, weights or [1.0] * len(names)):
        local = scope.local_name(name)
        fitting = expand_names(list(scope.text_fields), [local]) if "*" in local else [local]
        for one in fitting:
            found.setdefault(path + one, weight)
    return list(found.items())


def _with_fields(query: q.MultiMatch, scope: Scope) -> q.MultiMatch:
    if not any("*" in name for name in query.fields) or (query.weights and len(query.weights) != len(query.fields)):
        return query
    fields = _fields(query.fields, query.weights, scope)
    return replace(query, fields=[f for f, _ in fields] or query.fields, weights=[w for _, w in fields] or query.weights)


def _clauses(query: q.QueryString, scope: Scope) -> q.Query:
    from ..plans.batch import QueryStrings, clause_rows

    fields = _fields(query.fields, query.boosts, scope)
    spec = QueryStrings(
        [f for f, _ in fields] or query.fields, [w for _, w in fields] or query.boosts, query.syntax, query.default_operator, query.analyzer, query.flags
    )
    strings = SparkSession.active().createDataFrame([(0, query.query)], "query_id int, query string")
    # As many rows as the one string has clauses and fields.
    rows = sorted(clause_rows(strings, spec).collect(), key=lambda r: r["clause_id"])
    by_clause: dict[tuple[int, str], list[q.Query]] = {}
    for r in rows:
        by_clause.setdefault((r["clause_id"], r["occur"]), []).append(_clause(r, spec))
    parts: dict[str, list[q.Query]] = {"must": [], "should": [], "must_not": []}
    for (_, occur), queries in by_clause.items():
        if isinstance(queries[0], q.MatchAll):
            # "*" names no field, so it counts once.
            parts[occur].append(max(queries, key=lambda one: one.boost))
        elif len(queries) == 1:
            parts[occur].append(queries[0])
        else:
            # Full syntax: a clause counts in its best field; simple syntax: in all.
            parts[occur].append(q.DisMax(queries) if query.syntax == "full" else q.Bool.of(should=queries))
    if not rows:
        return q.Bool.of(must_not=[q.MatchAll()])
    return q.Bool.of(**parts, minimum_should_match=query.minimum_should_match, boost=query.boost)


def _clause(row, spec) -> q.Query:
    words, boost = " ".join(row["terms"]), row["boost"]
    if row["kind"] == "all":
        return q.MatchAll(boost=boost)
    if row["kind"] == "phrase":
        return q.MatchPhrase(row["field"], words, slop=row["k"], analyzer=_AS_IS, boost=boost)
    if row["kind"] == "prefix":
        return q.MatchPhrase(row["field"], words, prefix=True, analyzer=_AS_IS, boost=boost)
    if row["kind"] == "fuzzy":
        return q.Match(row["field"], words, fuzziness=row["k"], analyzer=_AS_IS, boost=boost)
    return q.Match(row["field"], words, operator=spec.default_operator, analyzer=_AS_IS, boost=boost)
