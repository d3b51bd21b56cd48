"""Several facets, at any depth, from one pass over the matching documents.

Every facet of every tree is one grouping set.  A document gives one entry per set and bucket, with the bucket's keys of
all levels; one aggregation counts all entries and reduces all measures.  Only its result, the buckets, is kept
in a checkpoint, and the facets are read from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder
from .aggregations import (
    BUCKET,
    COUNT,
    DEFAULT_TERMS,
    Aggregation,
    MaxOf,
    Order,
    StatsOf,
    TermsFacet,
    _bucket_values,
    _required,
    _selection,
)
from .scope import Scope
from .topn import top_n_per_group

_MEASURES = {"avg": F.avg, "min": F.min, "max": F.max}


@dataclass
class _Set:
    """One grouping set: the facets on the way to it, and what is measured in its buckets."""

    number: int
    path: list[TermsFacet]
    measures: dict[str, tuple[Column, str]] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return ".".join(f.name for f in self.path)


def can_be_together(request: Aggregation | None) -> bool:
    """Whether a tree consists of what grouping sets can count: buckets, maxima and statistics."""
    if isinstance(request, TermsFacet):
        return all(s is None or can_be_together(s) for s in request.sub)
    return isinstance(request, (MaxOf, StatsOf))


def _value(request: MaxOf | StatsOf, scope: Scope) -> Column:
    if isinstance(request, MaxOf):
        if request.script is not None:
            return F.expr(request.script)
        if request.field is None:
            raise ValueError("a maximum needs a field or a script")
        if request.field == "_score":
            return F.col("_score")
    f = _required(scope, request.field)
    return F.array_max(f.column) if f.is_array and isinstance(request, MaxOf) else f.column


def _sets(requests: list[Aggregation], scope: Scope) -> list[_Set]:
    found = [_Set(0, [])]

    def visit(request: Aggregation, parent: _Set) -> None:
        if isinstance(request, TermsFacet):
            own = _Set(len(found), [*parent.path, request])
            found.append(own)
            for sub in request.sub:
                if sub is not None:
                    visit(sub, own)
            return
        kinds = ["max"] if isinstance(request, MaxOf) else list(_MEASURES)
        for kind in kinds:
            parent.measures[f"{request.name}.{kind}"] = (_value(request, scope), kind)

    for request in requests:
        visit(request, found[0])
    return found


def _types(path: list[TermsFacet], scope: Scope) -> list[T.DataType]:
    fields = [_required(scope, facet.field) for facet in path]
    return [T.StringType() if f.is_text else f.element_type for f in fields]


def _keys(facet: TermsFacet, scope: Scope) -> Column:
    """The document's chosen buckets of one facet, as strings."""
    f = _required(scope, facet.field)
    dtype = T.StringType() if f.is_text else f.element_type
    values = F.array_compact(_bucket_values(f))
    if facet.include is not None or facet.exclude is not None:
        values = F.filter(values, lambda x: _told(_selection(facet, x, dtype)))
    return F.coalesce(F.transform(values, lambda x: x.cast("string")), F.array().cast("array<string>"))


def _with_level(combined: Column, keys: Column) -> Column:
    """Every path so far with every key of the next level."""
    return F.flatten(F.transform(combined, lambda done: F.transform(keys, lambda k: F.concat(done, F.array(k)))))


def _told(test: Column | None) -> Column:
    return F.lit(True) if test is None else F.coalesce(test, F.lit(False))


def count_buckets(matched: DataFrame, requests: list[Aggregation], text_fields: dict[str, str] | None = None) -> DataFrame:
    """All buckets of all facets: ``set``, ``keys`` (outermost first), ``doc_count`` and the measures ``m0``, ``m1``, …

    One scan and one shuffle of partial counts, whatever the number of facets.
    """
    scope = Scope(matched.schema, text_fields or {}, matched)
    sets = _sets(requests, scope)
    facets = list({id(f): f for s in sets for f in s.path}.values())
    measured = [(s, *m) for s in sets for m in s.measures.values()]
    # Keys and measured values once per document; every set refers to them.
    rows = matched.select(
        *[_keys(f, scope).alias(f"_keys_{i}") for i, f in enumerate(facets)],
        *[value.alias(f"_value_{i}") for i, (_, value, _) in enumerate(measured)],
    )
    places = {id(f): F.col(f"_keys_{i}") for i, f in enumerate(facets)}

    def entries(s: _Set) -> Column:
        combined = F.array(F.array().cast("array<string>"))
        for facet in s.path:
            combined = _with_level(combined, places[id(facet)])
        return F.transform(combined, lambda keys: F.struct(F.lit(s.number).alias("set"), keys.alias("keys")))

    used = [s for s in sets if s.path or s.measures]
    exploded = rows.withColumn("_entry", F.explode(F.concat(*[entries(s) for s in used])))
    measures = [
        _MEASURES[kind](F.when(F.col("_entry.set") == s.number, F.col(f"_value_{i}"))).alias(f"m{i}")
        for i, (s, _, kind) in enumerate(measured)
    ]
    return exploded.groupBy(F.col("_entry.set").alias("set"), F.col("_entry.keys").alias("keys")).agg(
        F.count(F.lit(1)).alias(COUNT), *measures
    )


def aggregate_together(
    matched: DataFrame, requests: list[Aggregation], text_fields: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """As ``aggregations.aggregate``, for trees of buckets, maxima and statistics, in one pass that runs at once."""
    requests = [r for r in requests if r is not None]
    if not requests:
        return {}
    scope = Scope(matched.schema, text_fields or {}, matched)
    sets = _sets(requests, scope)
    shared_folder(matched.sparkSession)
    counted = count_buckets(matched, requests, text_fields).checkpoint(eager=True)
    number = {key: f"m{i}" for i, key in enumerate((s.number, name) for s in sets for name in s.measures)}
    results: dict[str, DataFrame] = {}
    kept: dict[str, DataFrame] = {}
    for s in sets:
        levels = [f"_bucket_{i}" for i in range(len(s.path))]
        types = _types(s.path, scope)
        own = counted.filter(F.col("set") == s.number).select(
            *[F.get("keys", F.lit(i)).cast(t).alias(k) for i, (k, t) in enumerate(zip(levels, types))], COUNT, *[number[s.number, n] for n in s.measures]
        )
        if s.path:
            parents = levels[:-1]
            if parents:
                own = own.join(kept[".".join(f.name for f in s.path[:-1])].select(*parents), parents, "left_semi")
            own = kept[s.name] = _best(own, s, levels, number)
            named = {k: f"parent_{i + 1}" for i, k in enumerate(parents)} | {levels[-1]: BUCKET}
            results[s.name] = own.select(*[F.col(k).alias(n) for k, n in named.items()], COUNT)
        elif s.measures:
            # Documents or not, measures of the whole are one row.
            own = own.agg(*[F.max(number[0, n]).alias(number[0, n]) for n in s.measures])
        for request in {n.rsplit(".", 1)[0] for n in s.measures}:
            columns = [F.col(number[s.number, n]).alias(n.rsplit(".", 1)[1]) for n in s.measures if n.rsplit(".", 1)[0] == request]
            outer = [F.col(k).alias(f"parent_{i + 1}") for i, k in enumerate(levels)]
            results[f"{s.name}.{request}" if s.path else request] = own.select(*outer, *columns)
    return results


def _best(own: DataFrame, s: _Set, levels: list[str], number: dict) -> DataFrame:
    """The buckets a facet shows of each parent bucket."""
    facet = s.path[-1]
    size = DEFAULT_TERMS if facet.size is None else facet.size
    subs = {x.name: x for x in facet.sub if x is not None}
    order = []
    for o in facet.order or [Order()]:
        if o.by in ("count", "term"):
            column = F.col(COUNT) if o.by == "count" else F.col(levels[-1])
        elif isinstance(subs.get(o.by), StatsOf) and o.metric in _MEASURES:
            column = F.col(number[s.number, f"{o.by}.{o.metric}"])
        elif isinstance(subs.get(o.by), MaxOf) and o.metric in (None, "max"):
            column = F.col(number[s.number, f"{o.by}.max"])
        else:
            raise ValueError(f"buckets cannot be ordered by {o.by!r} and {o.metric!r}")
        order.append(column.desc_nulls_last() if o.descending else column.asc_nulls_last())
    order.append(F.col(levels[-1]).asc())
    if len(levels) > 1:
        return top_n_per_group(own, levels[:-1], order, size, "_rank").drop("_rank")
    return own.orderBy(*order).limit(size)
