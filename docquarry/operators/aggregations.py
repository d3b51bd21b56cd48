"""Facets over the matching documents.

A request is a tree of aggregations; the result is one DataFrame per node, keyed
by the names on the way to it, with the parent buckets as leading columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import analysis
from ..functions.fields import expand_names
from .scope import KEYWORD_SUFFIX, Field, Scope
from .topn import top_n_per_group

# Sizes used when a request gives none.
DEFAULT_TERMS = 10
DEFAULT_TOP_HITS = 3
DEFAULT_SIGNIFICANT_TERMS = 10
SIGNIFICANT_MIN_COUNT = 3

BUCKET = "term"
COUNT = "doc_count"


@dataclass
class Order:
    """Bucket order: ``by`` is ``count``, ``term`` or the name of a sub-aggregation.

    ``metric`` (``avg``, ``min``, ``max``) picks one value of a sub-aggregation
    that has several.  Without a direction the order is descending.
    """

    by: str = "count"
    descending: bool = True
    metric: str | None = None


@dataclass
class Aggregation:
    name: str


@dataclass
class TermsFacet(Aggregation):
    field: str
    size: int | None = None
    order: list[Order] = field(default_factory=list)
    include: Any = None
    exclude: Any = None
    sub: list[Aggregation | None] = field(default_factory=list)


@dataclass
class MaxOf(Aggregation):
    """Largest value of a field, or of a Spark SQL expression (may use ``_score``)."""

    field: str | None = None
    script: str | None = None


@dataclass
class StatsOf(Aggregation):
    """The avg, min and max of a field; only to order buckets by one of them."""

    field: str


@dataclass
class TopHits(Aggregation):
    include: list[str] | None = None
    exclude: list[str] | None = None
    size: int | None = None


@dataclass
class SignificantTerms(Aggregation):
    field: str
    size: int | None = None
    min_doc_count: int = SIGNIFICANT_MIN_COUNT
    sub: list[Aggregation | None] = field(default_factory=list)


@dataclass
class _Context:
    """Matching documents of one level, one row per document and parent bucket."""

    rows: DataFrame
    keys: list[str]
    buckets: DataFrame | None
    scope: Scope
    background: DataFrame
    id_col: str
    source: list[str]
    index: Any = None


def aggregate(
    matched: DataFrame,
    requests: list[Aggregation],
    background: DataFrame,
    id_col: str,
    text_fields: dict[str, str] | None = None,
    index=None,
) -> dict[str, DataFrame]:
    """One DataFrame per aggregation, sub-aggregations under ``parent.child`` names."""
    scope = Scope(matched.schema, text_fields or {}, matched)
    source = [c for c in matched.columns if not c.startswith("_") or c == id_col]
    context = _Context(matched, [], None, scope, background, id_col, source, index)
    results: dict[str, DataFrame] = {}
    for request in requests:
        if request is not None:
            _build(request, context, "", results)
    return results


def _build(request: Aggregation, ctx: _Context, prefix: str, results: dict[str, DataFrame]) -> None:
    name = prefix + request.name
    if isinstance(request, TermsFacet):
        _terms(request, ctx, name, results)
    elif isinstance(request, SignificantTerms):
        _significant(request, ctx, name, results)
    elif isinstance(request, MaxOf):
        results[name] = _grouped(ctx, _max_value(request, ctx.scope).alias("max"))
    elif isinstance(request, StatsOf):
        value = _required(ctx.scope, request.field).column
        results[name] = _grouped(ctx, *[fn(value).alias(m) for m, fn in _METRICS.items()])
    elif isinstance(request, TopHits):
        results[name] = _top_hits(request, ctx)
    else:
        raise TypeError(f"unknown aggregation {type(request).__name__}")


_METRICS = {"avg": F.avg, "min": F.min, "max": F.max}


def _grouped(ctx: _Context, *aggregates: Column) -> DataFrame:
    return ctx.rows.groupBy(*ctx.keys).agg(*aggregates) if ctx.keys else ctx.rows.agg(*aggregates)


def _required(scope: Scope, name: str) -> Field:
    f = scope.field(name)
    if f is None:
        return Field(name, F.lit(None).cast("string"), T.StringType())
    return f


def _bucket_values(f: Field) -> Column:
    """Distinct bucket keys of one document, in the field's own type."""
    if f.is_text:
        return F.array_distinct(f.tokens)
    if f.is_array:
        return F.array_distinct(F.array_compact(f.column))
    return F.array(f.column)


def _exploded(ctx: _Context, f: Field, into: str) -> DataFrame:
    """One row per document and distinct term; a scalar field needs no generator."""
    if f.is_array or f.is_text:
        return ctx.rows.withColumn(into, F.explode(_bucket_values(f)))
    return ctx.rows.withColumn(into, f.column).filter(F.col(into).isNotNull())


def _selection(request: TermsFacet, term: Column, dtype: T.DataType) -> Column | None:
    """Include and exclude conditions, both sides applied."""
    tests = []
    for spec, keep in ((request.include, True), (request.exclude, False)):
        if spec is None:
            continue
        if isinstance(spec, str):
            test = term.cast("string").rlike(analysis.anchored(spec))
        else:
            values = list(spec)
            if not values:
                continue
            test = term.isin(*[F.lit(v).try_cast(dtype) for v in values])
        tests.append(test if keep else ~F.coalesce(test, F.lit(False)))
    result = None
    for t in tests:
        result = t if result is None else result & t
    return result


def _key_name(ctx: _Context, name: str) -> str:
    """Buckets of the innermost level are called ``term``, outer ones after their facet."""
    return f"_bucket_{len(ctx.keys)}"


def _terms(request: TermsFacet, ctx: _Context, name: str, results: dict[str, DataFrame]) -> None:
    f = _required(ctx.scope, request.field)
    dtype = T.StringType() if f.is_text else f.element_type
    key = _key_name(ctx, request.name)
    rows = _exploded(ctx, f, key)
    chosen = _selection(request, F.col(key), dtype)
    if chosen is not None:
        rows = rows.filter(chosen)
    size = DEFAULT_TERMS if request.size is None else request.size

    measures, order = [F.count(F.lit(1)).alias(COUNT)], []
    subs = {s.name: s for s in request.sub if s is not None}
    row_scope = Scope(rows.schema, ctx.scope.text_fields, rows)
    for i, o in enumerate(request.order or [Order()]):
        column, measure = _order_column(o, subs, row_scope, key, i)
        if measure is not None:
            measures.append(measure)
        order.append(column.desc_nulls_last() if o.descending else column.asc_nulls_last())
    order.append(F.col(key).asc())

    counted = rows.groupBy(*ctx.keys, key).agg(*measures)
    if ctx.keys:
        kept = top_n_per_group(counted, ctx.keys, order, size, "_rank").drop("_rank")
    else:
        kept = counted.orderBy(*order).limit(size)
    shown = kept.select(*ctx.keys, key, COUNT)
    results[name] = _public(shown, ctx, request)

    if subs:
        # The kept buckets are at most ``size`` per parent; as a semi join they cut
        # the rows before any child is grouped.
        keys = [*ctx.keys, key]
        inside = rows.join(kept.select(*keys), keys, "left_semi")
        child = _Context(
            inside, keys, shown, Scope(inside.schema, ctx.scope.text_fields, inside),
            ctx.background, ctx.id_col, ctx.source, ctx.index,
        )
        for sub in subs.values():
            _build(sub, child, name + ".", results)
            results[f"{name}.{sub.name}"] = _rename_keys(results[f"{name}.{sub.name}"], keys)


def _public(df: DataFrame, ctx: _Context, request: Aggregation) -> DataFrame:
    return df.withColumnRenamed(_key_name(ctx, request.name), BUCKET)


def _rename_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Parent bucket columns become ``parent_1``, ``parent_2``, … from the outside in."""
    for i, key in enumerate(keys, start=1):
        df = df.withColumnRenamed(key, f"parent_{i}")
    return df


def _order_column(o: Order, subs: dict[str, Aggregation], scope: Scope, key: str, i: int):
    """Column to order buckets by, and the aggregate that provides it."""
    if o.by == "count":
        return F.col(COUNT), None
    if o.by == "term":
        return F.col(key), None
    if o.by not in subs:
        raise ValueError(f"buckets are ordered by {o.by!r}, which is no sub-aggregation")
    sub, name = subs[o.by], f"_order_{i}"
    if isinstance(sub, StatsOf):
        if o.metric not in _METRICS:
            raise ValueError(f"ordering by {o.by!r} needs a metric, one of {sorted(_METRICS)}")
        return F.col(name), _METRICS[o.metric](_required(scope, sub.field).column).alias(name)
    if isinstance(sub, MaxOf):
        if o.metric not in (None, "max"):
            raise ValueError(f"{o.by!r} has no metric {o.metric!r}")
        return F.col(name), _max_value(sub, scope).alias(name)
    raise ValueError(f"cannot order buckets by {o.by!r}")


def _max_value(request: MaxOf, scope: Scope) -> Column:
    if request.script is not None:
        return F.max(F.expr(request.script))
    if request.field is None:
        raise ValueError("a maximum needs a field or a script")
    if request.field == "_score":
        return F.max(F.col("_score"))
    f = _required(scope, request.field)
    return F.max(F.array_max(f.column)) if f.is_array else F.max(f.column)


def _top_hits(request: TopHits, ctx: _Context) -> DataFrame:
    """Best documents of each bucket: ``rank``, ``total`` hits, ``_score`` and fields."""
    size = DEFAULT_TOP_HITS if request.size is None else request.size
    names = ctx.source if request.include is None else expand_names(ctx.source, request.include)
    if request.exclude:
        dropped = set(expand_names(ctx.source, request.exclude))
        names = [n for n in names if n not in dropped]
    extra = [c for c in ("_score",) if c in ctx.rows.columns]
    columns = [*ctx.keys, *dict.fromkeys([ctx.id_col, *extra, *names])]
    order = ([F.col("_score").desc_nulls_last()] if extra else []) + [F.col(ctx.id_col).asc()]
    rows = ctx.rows.select(*[F.col(f"`{c}`") for c in columns])
    if not ctx.keys:
        total = ctx.rows.agg(F.count(F.lit(1)).alias("total")).scalar()
        best = rows.orderBy(*order).limit(size)
        ranked = top_n_per_group(best.withColumn("_all", F.lit(0)), ["_all"], order, size).drop("_all")
        return ranked.withColumn("total", total)
    ranked = top_n_per_group(rows, ctx.keys, order, size)
    # The bucket counts are already known; a window count would gather each bucket.
    return ranked.join(ctx.buckets.withColumnRenamed(COUNT, "total"), ctx.keys)


def _significant(request: SignificantTerms, ctx: _Context, name: str, results: dict[str, DataFrame]) -> None:
    """Terms more frequent among the matches than in the whole collection (JLH score)."""
    f = _required(ctx.scope, request.field)
    key = _key_name(ctx, request.name)
    size = DEFAULT_SIGNIFICANT_TERMS if request.size is None else request.size
    rows = _exploded(ctx, f, key)
    foreground = rows.groupBy(*ctx.keys, key).agg(F.count(F.lit(1)).alias(COUNT))
    foreground = foreground.filter(F.col(COUNT) >= request.min_doc_count)

    stored = f.is_text and ctx.index is not None and ctx.index.covers(f.name)
    if stored:
        totals = ctx.index.term_stats.filter(F.col("field") == f.name).select(
            F.col("term").alias(key), F.col("df").alias("bg_count")
        )
    else:
        behind = Scope(ctx.background.schema, ctx.scope.text_fields, ctx.background)
        everything = _Context(ctx.background, [], None, behind, ctx.background, ctx.id_col, ctx.source)
        totals = _exploded(everything, _required(behind, request.field), key).groupBy(key).agg(
            F.count(F.lit(1)).alias("bg_count")
        )
    n_background = ctx.background.agg(F.count(F.lit(1)).alias("n")).scalar()
    if ctx.keys:
        sized = foreground.join(ctx.buckets.withColumnRenamed(COUNT, "fg_total"), ctx.keys)
    else:
        sized = foreground.withColumn("fg_total", ctx.rows.agg(F.count(F.lit(1)).alias("n")).scalar())
    share, base = F.col("fg_share"), F.col("bg_share")
    scored = (
        sized.join(totals, key)
        .withColumn("fg_share", F.col(COUNT) / F.col("fg_total"))
        .withColumn("bg_share", F.col("bg_count") / n_background)
        .filter(share > base)
        .withColumn("score", (share - base) * (share / base))
        .select(*ctx.keys, key, COUNT, "bg_count", "score")
    )
    order = [F.col("score").desc(), F.col(key).asc()]
    if ctx.keys:
        kept = top_n_per_group(scored, ctx.keys, order, size, "_rank").drop("_rank")
    else:
        kept = scored.orderBy(*order).limit(size)
    results[name] = _public(kept, ctx, request)
    subs = [s for s in request.sub if s is not None]
    if subs:
        keys = [*ctx.keys, key]
        inside = rows.join(kept.select(*keys), keys, "left_semi")
        child = _Context(
            inside, keys, kept.select(*keys, COUNT), Scope(inside.schema, ctx.scope.text_fields, inside),
            ctx.background, ctx.id_col, ctx.source, ctx.index,
        )
        for sub in subs:
            _build(sub, child, name + ".", results)
            results[f"{name}.{sub.name}"] = _rename_keys(results[f"{name}.{sub.name}"], keys)


def field_terms(
    matched: DataFrame,
    field_name: str,
    size: int,
    order: list[Order] | None = None,
    text_fields: dict[str, str] | None = None,
) -> DataFrame:
    """Terms of a field with their count and the best score of a document holding them.

    ``Order.by`` is ``term``, ``count`` or ``doc_score``.
    """
    scope = Scope(matched.schema, text_fields or {}, matched)
    f = _required(scope, field_name)
    ctx = _Context(matched, [], None, scope, matched, "", [])
    names = {"term": "term", "count": "count", "doc_score": "max_doc_score"}
    keys = []
    for o in order or [Order("count")]:
        if o.by not in names:
            raise ValueError(f"unknown term order {o.by!r}; expected one of {sorted(names)}")
        column = F.col(names[o.by])
        keys.append(column.desc_nulls_last() if o.descending else column.asc_nulls_last())
    return (
        _exploded(ctx, f, "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("count"), F.max("_score").alias("max_doc_score"))
        .orderBy(*keys, F.col("term").asc())
        .limit(size)
    )


__all__ = [
    "Aggregation", "MaxOf", "Order", "SignificantTerms", "StatsOf", "TermsFacet", "TopHits",
    "aggregate", "field_terms", "KEYWORD_SUFFIX",
]
