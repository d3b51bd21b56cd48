"""Descriptions of what to search for.  Plain data; ``compile_query`` gives them meaning."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from .highlight import Highlight


@dataclass(kw_only=True)
class Query:
    boost: float = 1.0


@dataclass
class MatchAll(Query):
    """Every document, with a constant score."""


@dataclass
class Term(Query):
    """The exact, un-analysed term."""

    field: str
    term: Any


@dataclass
class Terms(Query):
    """Any of the exact terms; constant score."""

    field: str
    terms: list


@dataclass
class Match(Query):
    """Analysed query text; its tokens are joined by ``operator``.

    ``fuzziness`` is 0..3 or ``"auto"``.
    """

    field: str
    query: str
    operator: str = "or"
    analyzer: str | None = None
    minimum_should_match: str | int | None = None
    fuzziness: int | str | None = None
    transpositions: bool = False


@dataclass
class MatchPhrase(Query):
    """The tokens in order, at most ``slop`` moves apart; ``prefix`` opens the last one."""

    field: str
    phrase: str
    slop: int = 0
    prefix: bool = False
    analyzer: str | None = None


@dataclass
class MultiMatch(Query):
    """One text over several fields.

    ``type`` is ``best_fields``, ``most_fields``, ``cross_fields``, ``phrase``
    or ``phrase_prefix``.
    """

    query: str
    fields: list[str]
    weights: list[float] | None = None
    operator: str = "or"
    type: str = "best_fields"


@dataclass
class Clause:
    """Queries that share one role: ``must``, ``should``, ``must_not`` or ``filter``."""

    occur: str
    queries: list[Query]


@dataclass
class Bool(Query):
    clauses: list[Clause]
    minimum_should_match: str | int | None = None

    @classmethod
    def of(cls, must=(), should=(), must_not=(), filter=(), minimum_should_match=None, boost=1.0) -> "Bool":
        named = {"must": must, "should": should, "must_not": must_not, "filter": filter}
        clauses = [Clause(k, list(v)) for k, v in named.items() if v]
        return cls(clauses, minimum_should_match, boost=boost)


@dataclass
class ConstantScore(Query):
    query: Query


@dataclass
class DisMax(Query):
    """Best score of several queries, plus ``tie_breaker`` times the others."""

    queries: list[Query]
    tie_breaker: float = 0.0


@dataclass
class Wildcard(Query):
    """``*`` and ``?`` on exact terms; constant score."""

    field: str
    pattern: str


@dataclass
class Range(Query):
    """Bounds on a field; strict bounds win over inclusive ones.

    ``format`` (several split by ``||``) and ``time_zone`` apply to date bounds
    given as strings.  ``relation`` (``intersects``, ``contains``, ``within``)
    applies to fields of type ``struct<gte, lte>``.
    """

    field: str
    gt: Any = None
    gte: Any = None
    lt: Any = None
    lte: Any = None
    format: str | None = None
    time_zone: str | None = None
    relation: str | None = None


@dataclass
class FieldValueFactor:
    field: str
    factor: float = 1.0
    modifier: str = "none"
    missing: float = 1.0


@dataclass
class FunctionItem:
    """One weighted function, applied where ``filter`` matches."""

    function: FieldValueFactor | None = None
    filter: Query | None = None
    weight: float = 1.0


@dataclass
class FunctionScore(Query):
    query: Query
    field_value_factor: FieldValueFactor | None = None
    functions: list[FunctionItem] = field(default_factory=list)
    boost_mode: str = "multiply"
    score_mode: str = "multiply"


@dataclass
class InnerHits:
    """Return the best matching children of each hit."""

    size: int | None = None
    fields: list[str] | None = None
    fetch_source: bool = False
    explain: bool = False
    highlight: Highlight | None = None


@dataclass
class Nested(Query):
    """Documents with at least one child under ``path`` that matches ``query``."""

    path: str
    query: Query
    score_mode: str = "avg"
    inner_hits: InnerHits | None = None


@dataclass
class QueryString(Query):
    """A flat query string as one query among others.

    ``syntax`` is ``full`` (``AND OR NOT``, ``field:term``, ``^boost``) or ``simple`` (``+ | -``); a clause that names no field is
    searched in ``fields``, whose names may be patterns.  ``flags`` (simple syntax) says which operators are active.
    """

    query: str
    fields: list[str]
    boosts: list[float] | None = None
    syntax: str = "full"
    default_operator: str = "or"
    analyzer: str = "standard"
    flags: list[str] | None = None
    minimum_should_match: str | int | None = None
