"""One search request over a collection: hits, total, facets and highlights."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import project_fields
from ..operators import queries as q
from ..operators.aggregations import Aggregation, aggregate
from ..operators.compile import matching, scored
from ..operators.facets_together import aggregate_together, can_be_together
from ..operators.highlight import Highlight, highlights
from ..operators.paging import Sort, after, count_hits, first_rows, page, resolve_sort, total_hits
from ..operators.query_strings import expanded
from ..operators.scope import Scope


#: Pages that end beyond this have a threshold that cuts too little.
BEST_PAGE = 1000
#: Below so many postings the two rounds of ``plans.top`` cost more than they spare.
LEAST_POSTINGS = 2_000_000


@dataclass
class Collection:
    """A table of documents.

    ``text_fields`` maps the fields to analyse to their analyser.  ``index``
    (see ``plans.index``) provides stored statistics; without it they are
    counted from the documents within the same query.
    """

    docs: DataFrame
    id_col: str = "_id"
    text_fields: dict[str, str] = field(default_factory=dict)
    index: object | None = None

    @property
    def source_columns(self) -> list[str]:
        hidden = {f"{name}_tokens" for name in self.text_fields}
        return [c for c in self.docs.columns if c not in hidden]


@dataclass
class SearchRequest:
    query: q.Query
    start: int = 0
    rows: int = 10
    fields: list[str] | None = None
    fetch_source: bool = False
    sort: list[Sort] = field(default_factory=list)
    search_after: list | None = None
    post_filter: q.Query | None = None
    aggregations: list[Aggregation] = field(default_factory=list)
    #: Count all facets that can be in one pass, which runs when the request is built.
    facets_together: bool = False
    highlight: Highlight | None = None
    track_total_hits_up_to: int | None = None
    export: bool = False
    limit: int | None = None
    #: Postings from which on the first page is cut by a threshold; it changes the cost, not the result.
    least_postings: int = LEAST_POSTINGS


@dataclass
class SearchResult:
    """Lazy DataFrames; nothing runs before one of them is used."""

    hits: DataFrame
    total: DataFrame
    aggregations: dict[str, DataFrame]
    matched: DataFrame


def search(collection: Collection, request: SearchRequest, persist: bool = False) -> SearchResult:
    """Build hits, total and facets over the documents that match.

    The post filter narrows hits and total but not the facets.  ``persist``
    keeps the matching documents in memory or on disk if several results of the
    request will be read; the caller unpersists ``result.matched``.
    """
    # Query strings become ordinary clauses once, for matching, scoring and highlighting alike.
    request = replace(request, query=expanded(request.query, Scope(collection.docs.schema, collection.text_fields, collection.docs)))
    matched = scored(collection.docs, request.query, collection.text_fields, collection.index)
    if persist:
        matched = matched.persist()

    narrowed = matched
    if request.post_filter is not None:
        narrowed = matching(matched, request.post_filter, collection.text_fields)

    chosen = _best(collection, request)
    hits = _present(_choose(narrowed, collection, request) if chosen is None else chosen, collection, request)
    together = [r for r in request.aggregations if request.facets_together and can_be_together(r)]
    apart = [r for r in request.aggregations if r not in together]
    facets = aggregate_together(matched, together, collection.text_fields)
    facets |= aggregate(matched, apart, collection.docs, collection.id_col, collection.text_fields, collection.index)
    return SearchResult(hits, total_hits(narrowed, request.track_total_hits_up_to), facets, matched)


def count(collection: Collection, query: q.Query) -> DataFrame:
    """Count-only request: one row ``count``; paging and facets play no part."""
    return count_hits(matching(collection.docs, query, collection.text_fields, collection.index))


def _best(collection: Collection, request: SearchRequest) -> DataFrame | None:
    """The first page by relevance from those documents only that can be on it; None for other requests."""
    from .top import best_candidates

    last = request.start + request.rows
    if request.sort or request.search_after is not None or request.post_filter is not None or request.export or request.rows <= 0:
        return None
    if last > BEST_PAGE:
        return None
    found = best_candidates(collection.docs, request.query, collection.text_fields, collection.index, last, request.least_postings)
    if found is None:
        return None
    rows = found.rows.withColumn("_score", found.compiled.score.cast("double")).select(
        *[F.col(f"`{c}`") for c in collection.docs.columns], "_score"
    )
    return page(rows, resolve_sort(rows, [], collection.id_col), request.start, request.rows, request.limit)


def _choose(narrowed: DataFrame, collection: Collection, request: SearchRequest) -> DataFrame:
    """The documents to deliver: a page, a keyset page or everything."""
    sort = resolve_sort(narrowed, request.sort, collection.id_col)
    rows = narrowed
    if request.search_after is not None:
        rows = after(rows, sort, request.search_after)
    if not request.export:
        return page(rows, sort, request.start, request.rows, request.limit)
    if request.limit is not None:
        return first_rows(rows, sort, request.limit)
    if request.sort:
        from ..operators.paging import order_by

        return rows.orderBy(*order_by(rows, sort))
    # A full export in storage order needs no sort and so no shuffle.
    return rows


def _present(hits: DataFrame, collection: Collection, request: SearchRequest) -> DataFrame:
    keep = [collection.id_col, "_score"] + (["inner_hits"] if "inner_hits" in hits.columns else [])
    if request.highlight is not None:
        scope = Scope(hits.schema, collection.text_fields, hits)
        hits = hits.withColumn("highlight", highlights(request.query, scope, request.highlight))
        keep.append("highlight")
    return project_fields(
        hits, request.fields, keep, whole_source=request.fetch_source, source_columns=collection.source_columns
    )
