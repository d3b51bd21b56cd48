"""The best documents of a sum of terms, without scoring every hit.

Two rounds.  The first reads each term's strongest postings only; the n-th best sum of those is a
threshold no result can be below.  A term without which the threshold cannot be reached is required: the second round
reads its postings above the impact that is still needed, and the other terms' postings only for
the documents left.  Postings are sorted by impact, so both conditions skip row groups and pages.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import analysis, scoring
from ..operators import queries as q
from ..operators.compile import Prepared, compile_query
from ..operators.joins import settle
from ..operators.posted import PROFILE, PostingsView
from ..operators.scope import CorpusStatistics, Scope
from .index import LEVELS, TextIndex
from .search import LEAST_POSTINGS

#: The first round reads at least so many postings a term for each document wanted.
FIRST_ROUND = 16
#: Sums of doubles in another order may differ by far less than this share.
_MARGIN = 1e-9


@dataclass
class Term:
    """What is known of one term: its weight, and the bounds of its part of a score."""

    field: str
    term: str
    weight: float
    df: int
    best: float
    levels: list[int] = field(default_factory=list)
    low: float = 1.0
    high: float = 1.0

    @property
    def most(self) -> float:
        """No document gets more from this term."""
        return self.weight * self.best * self.high

    def level_of(self, wanted: int) -> float:
        """An impact that about ``wanted`` postings have at least, 0 if there are not so many."""
        held = [i for i, n in enumerate(self.levels) if n >= wanted]
        return (scoring.K1 + 1) * (max(held) + 1) / LEVELS if held else 0.0


def summed_terms(query: q.Query, scope: Scope, boost: float = 1.0) -> dict[tuple[str, str], float] | None:
    """(field, term) -> boost if the query's score is a sum over terms and any one of them matches."""
    boost *= query.boost
    if isinstance(query, q.Bool) and query.clauses and all(c.occur == "should" for c in query.clauses):
        if (analysis.minimum_should_match(query.minimum_should_match, sum(len(c.queries) for c in query.clauses)) or 0) > 1:
            return None
        parts = [summed_terms(p, scope, boost) for c in query.clauses for p in c.queries]
    elif isinstance(query, (q.Match, q.Term)):
        f = scope.field(query.field)
        if f is None or f.posted is None:
            return None
        terms = [str(query.term)] if isinstance(query, q.Term) else analysis.analyze(query.query, query.analyzer or f.analyzer)
        if isinstance(query, q.Match):
            needed = analysis.minimum_should_match(query.minimum_should_match, len(terms)) or 0
            if query.fuzziness not in (None, 0, "0") or needed > 1 or (query.operator.lower() == "and" and len(terms) > 1):
                return None
        parts = [{(f.name, t): boost} for t in terms]
    else:
        return None
    if not parts or None in parts or boost <= 0:
        return None
    total: dict[tuple[str, str], float] = {}
    for part in parts:
        for key, value in part.items():
            total[key] = total.get(key, 0.0) + value
    return total


def known_terms(index: TextIndex, boosts: dict[tuple[str, str], float]) -> list[Term]:
    """Counts and bounds of the query's terms; one row per term reaches the driver."""
    sizes = {r["field"]: (r["n_docs"], r["sum_dl"] / r["n_docs"]) for r in index.field_stats.where("n_docs > 0").collect()}
    found = []
    for r in index.of_terms(index.term_stats, list(boosts)).collect():
        n, mean = sizes[r["field"]]
        weight = boosts[r["field"], r["term"]] * math.log(1 + (n - r["df"] + 0.5) / (r["df"] + 0.5))
        # Impacts refer to the mean length when they were written; another mean scales them at most so much.
        ratio = mean / index.lengths[r["field"]]
        found.append(Term(r["field"], r["term"], weight, r["df"], r["best"], r["levels"], min(1.0, ratio), max(1.0, ratio)))
    return found


def threshold(index: TextIndex, terms: list[Term], n: int) -> float:
    """Score that at least ``n`` documents reach: the n-th best sum over the terms' strongest postings."""
    strong, part = None, None
    for t in terms:
        is_it = (F.col("field") == t.field) & (F.col("term") == t.term)
        level = t.level_of(FIRST_ROUND * n)
        kept = is_it & (F.col("impact") >= level) if level else is_it
        strong = kept if strong is None else strong | kept
        value = F.col("impact") * (t.weight * t.low)
        part = F.when(is_it, value) if part is None else part.when(is_it, value)
    rows = index.postings_of([(t.field, t.term) for t in terms]).filter(strong)
    sums = rows.groupBy("_id").agg(F.sum(part).alias("s")).orderBy(F.desc("s")).limit(n)
    count, least = sums.agg(F.count(F.lit(1)), F.min("s")).first()
    return least if count == n else 0.0


def required_terms(terms: list[Term], least: float) -> dict[tuple[str, str], float]:
    """Terms a document must have to reach ``least``, with the impact it needs at least."""
    total = sum(t.most for t in terms)
    found = {}
    for t in terms:
        missing = least * (1 - _MARGIN) - (total - t.most) * (1 + _MARGIN)
        if missing > 0 and t.weight > 0:
            found[t.field, t.term] = missing / (t.weight * t.high) * (1 - _MARGIN)
    return found


def best_candidates(
    docs: DataFrame, query: q.Query, text_fields: dict[str, str], index: TextIndex | None, n: int, least_postings: int = LEAST_POSTINGS
) -> Prepared | None:
    """Documents among which the ``n`` best are, ready to be scored; None if the query gives no way to cut.

    Looking up the terms and the threshold runs small jobs at once.
    """
    if index is None or index.buckets is None or index.id_col not in docs.columns or n <= 0:
        return None
    view = PostingsView(index)
    scope = Scope(docs.schema, text_fields, docs, view=view)
    boosts = summed_terms(query, scope)
    if not boosts or len(boosts) < 2:
        return None
    terms = known_terms(index, boosts)
    if sum(t.df for t in terms) < least_postings:
        return None
    required = required_terms(terms, threshold(index, terms, n))
    if not required:
        return None
    stats = CorpusStatistics(index)
    compile_query(query, scope, stats)
    entries = second_round(view, required)
    rows = view.attach(stats.attach(docs), True, entries)
    compiled = compile_query(query, Scope(rows.schema, text_fields, docs, view=view), stats)
    literal = view.literal_terms()
    held = [F.col(PROFILE)[f"tf{literal[key]}"].isNotNull() for key in sorted(required)]
    return Prepared(rows.filter(scoring.all_of(held)), compiled)


def second_round(view: PostingsView, required: dict[tuple[str, str], float]) -> DataFrame:
    """Postings of documents that can still enter: required terms by impact, the others by document."""
    literal = view.literal_terms()
    strong = None
    for (name, term), least in sorted(required.items()):
        kept = (F.col("field") == name) & (F.col("term") == term) & (F.col("impact") >= least)
        strong = kept if strong is None else strong | kept
    needed = view.literal_entries({key: literal[key] for key in required}, strong)
    optional = {key: slot for key, slot in literal.items() if key not in required}
    if not optional:
        return needed
    together = needed.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(required)).select("_id")
    left = settle(together)
    return needed.unionByName(view.literal_entries(optional).join(left.hinted(), "_id", "left_semi"))
