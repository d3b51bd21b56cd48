"""Turns a query description into two columns: does it match, and how well."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import analysis, scoring
from ..functions.binding import bound
from . import queries as q
from .phrases import exact_frequency, phrase_frequency, phrase_matches, sloppy_frequency
from .posted import PostingsView
from .query_strings import expanded
from .scope import CorpusStatistics, Field, Scope, tokens_name

OCCURS = ("must", "should", "must_not", "filter")
NO_MATCH_SCORE = 0.0


@dataclass
class Compiled:
    """``score`` is meaningful only where ``match`` holds; a NULL ``match`` is no match.

    Conditions stay bare comparisons, which a Parquet scan can use; ``sure_match``
    is for places where NULL would matter, such as a negation.
    """

    match: Column
    score: Column
    inner_hits: dict[str, Column] = field(default_factory=dict)

    @property
    def sure_match(self) -> Column:
        return F.coalesce(self.match, F.lit(False))

    @property
    def gated_score(self) -> Column:
        return F.when(self.match, self.score).otherwise(F.lit(NO_MATCH_SCORE))


@dataclass
class Prepared:
    """Matching documents, ready to be scored."""

    rows: DataFrame
    compiled: Compiled


def find(
    docs: DataFrame,
    query: q.Query,
    text_fields: dict[str, str] | None = None,
    index=None,
) -> Prepared:
    """Filter by the match condition, then refer the score to the documents left.

    The condition is written over the stored fields only, so that it reaches the
    scan.  Texts are split into a tokens column once per matching document;
    columns the caller does not use are pruned by Spark.
    """
    text_fields = text_fields or {}
    scope = Scope(docs.schema, text_fields, docs)
    query = expanded(query, scope)
    stats = CorpusStatistics(index)
    if index is not None and index.buckets is not None and index.id_col in docs.columns:
        found = _find_posted(docs, query, text_fields, stats)
        if found is not None:
            return found
    match = compile_query(query, scope, stats).match
    rows = stats.attach(docs).filter(match)
    for name in text_fields:
        f = scope.field(name)
        if f is not None and "." not in name and f.stored_tokens is None:
            rows = rows.withColumn(tokens_name(name), f.tokens)
    return Prepared(rows, compile_query(query, Scope(rows.schema, text_fields, docs), stats))


def _find_posted(docs: DataFrame, query: q.Query, text_fields: dict[str, str], stats: CorpusStatistics) -> Prepared | None:
    """The same by the postings of the query's terms; None if the query asks for no indexed text.

    Documents are met by their id, which has to be theirs alone.
    """
    view = PostingsView(stats.index)
    compile_query(query, Scope(docs.schema, text_fields, docs, view=view), stats)
    if not view.needed:
        stats.forget()
        return None
    scope = Scope(docs.schema, text_fields, docs, view=view)
    rows = view.attach(stats.attach(docs), _needs_text(query, scope))
    compiled = compile_query(query, Scope(rows.schema, text_fields, docs, view=view), stats)
    return Prepared(rows.filter(compiled.match), compiled)


def _needs_text(query: q.Query, scope: Scope) -> bool:
    """Whether every match has a posting of the query's own terms."""
    def posted(name: str) -> bool:
        f = scope.field(name)
        return f is not None and f.posted is not None

    if isinstance(query, (q.Term, q.Terms, q.Match, q.MatchPhrase, q.Wildcard)):
        return posted(query.field)
    if isinstance(query, q.MultiMatch):
        return all(posted(name) or scope.field(name) is None for name in query.fields)
    if isinstance(query, (q.ConstantScore, q.FunctionScore)):
        return _needs_text(query.query, scope)
    if isinstance(query, q.DisMax):
        return all(_needs_text(p, scope) for p in query.queries)
    if isinstance(query, q.Bool):
        parts = {o: [p for c in query.clauses if c.occur == o for p in c.queries] for o in OCCURS}
        if any(_needs_text(p, scope) for p in parts["must"] + parts["filter"]):
            return True
        lonely = parts["should"] and not parts["must"] and not parts["filter"]
        needed = analysis.minimum_should_match(query.minimum_should_match, len(parts["should"])) or 0
        return bool(lonely or needed > 0) and all(_needs_text(p, scope) for p in parts["should"])
    if isinstance(query, q.Nested):
        return _held_by_children(query, scope) is not None
    return False


def _held_by_children(query: q.Nested, scope: Scope) -> Column | None:
    """What the postings of its children's texts say a document must have to match; None if nothing.

    Postings of a nested field name the parent, so the children of other documents are never looked at.
    """
    view = scope.view
    if view is None or scope.path or scope.field(query.path) is None:
        return None
    children = scope.children(query.path)

    def held(part: q.Query) -> Column | None:
        if isinstance(part, (q.ConstantScore, q.FunctionScore)):
            return held(part.query)
        if isinstance(part, (q.Term, q.Match, q.MatchPhrase)):
            f = children.field(part.field)
            if f is None or not f.is_text or not view.covers(f"{query.path}.{f.name}"):
                return None
            if isinstance(part, q.Term):
                terms, every = [str(part.term)], True
            elif isinstance(part, q.Match):
                if part.fuzziness not in (None, 0, "0"):
                    return None
                terms = analysis.analyze(part.query, part.analyzer or f.analyzer)
                every = _operator(part.operator) == "and"
            else:
                terms = analysis.analyze(part.phrase, part.analyzer or f.analyzer)
                terms, every = (terms[:-1] if part.prefix else terms), True
            tests = [view.frequency(f"{query.path}.{f.name}", ("term", t)) > 0 for t in dict.fromkeys(terms)]
            return None if not tests else scoring.all_of(tests) if every else scoring.any_of(tests)
        if isinstance(part, q.Bool):
            parts = {o: [held(p) for c in part.clauses if c.occur == o for p in c.queries] for o in ("must", "filter", "should")}
            known = [c for c in parts["must"] + parts["filter"] if c is not None]
            if known:
                return scoring.all_of(known)
            lonely = parts["should"] and not parts["must"] and not parts["filter"]
            return scoring.any_of(parts["should"]) if lonely and all(c is not None for c in parts["should"]) else None
        return None

    return held(query.query)


def scored(
    docs: DataFrame,
    query: q.Query,
    text_fields: dict[str, str] | None = None,
    index=None,
) -> DataFrame:
    """Matching documents with ``_score`` and, where asked for, ``inner_hits``."""
    found = find(docs, query, text_fields, index)
    result = found.rows.withColumn("_score", found.compiled.score.cast("double"))
    if found.compiled.inner_hits:
        hits = F.struct(*[c.alias(p) for p, c in found.compiled.inner_hits.items()])
        result = result.withColumn("inner_hits", hits)
    extra = [c for c in result.columns if c not in docs.columns and c not in ("_score", "inner_hits")]
    return result.drop(*extra)


def matching(docs: DataFrame, query: q.Query, text_fields: dict[str, str] | None = None, index=None) -> DataFrame:
    """Only filter; without an index it works on batch and streaming DataFrames alike."""
    if index is not None:
        return find(docs, query, text_fields, index).rows.select(*[F.col(f"`{c}`") for c in docs.columns])
    scope = Scope(docs.schema, text_fields or {}, docs)
    return docs.filter(compile_query(expanded(query, scope), scope, CorpusStatistics()).match)


def match_column(docs: DataFrame, query: q.Query, text_fields: dict[str, str] | None = None) -> Column:
    """The match condition alone, to use in any select or filter over ``docs``."""
    scope = Scope(docs.schema, text_fields or {}, docs)
    return compile_query(expanded(query, scope), scope, CorpusStatistics()).sure_match


def compile_query(query: q.Query, scope: Scope, stats: CorpusStatistics) -> Compiled:
    if query is None:
        raise ValueError("the query is missing")
    try:
        rule = _RULES[type(query)]
    except KeyError:
        raise TypeError(f"cannot compile a query of type {type(query).__name__}") from None
    return rule(query, scope, stats)


def _nothing() -> Compiled:
    return Compiled(F.lit(False), F.lit(NO_MATCH_SCORE))


def _constant(match: Column, boost: float) -> Compiled:
    return Compiled(match, F.lit(float(boost)))


# -- exact values ----------------------------------------------------------------

def _literal(value, dtype: T.DataType) -> Column:
    """A literal of the field's type; NULL (no match) if it cannot be one."""
    return F.lit(value) if isinstance(value, str) and isinstance(dtype, T.StringType) else F.lit(value).try_cast(dtype)


def _match_all(query: q.MatchAll, scope: Scope, stats: CorpusStatistics) -> Compiled:
    return _constant(F.lit(True), query.boost)


def _term(query: q.Term, scope: Scope, stats: CorpusStatistics) -> Compiled:
    f = scope.field(query.field)
    if f is None:
        return _nothing()
    if f.is_text:
        return _tokens_query(f, [str(query.term)], 1, query.boost, scope, stats)

    def holds(g: Field) -> Column:
        value = _literal(query.term, g.element_type)
        return F.array_contains(g.column, value) if g.is_array else g.column == value

    if not isinstance(f.element_type, (T.StringType, T.BooleanType)):
        return _constant(holds(f), query.boost)
    n = stats.doc_count(scope, f)
    df = stats.doc_freq(scope, f, ("value", query.term), holds)
    return Compiled(holds(f), scoring.boosted(scoring.idf(n, df), query.boost))


def _terms(query: q.Terms, scope: Scope, stats: CorpusStatistics) -> Compiled:
    f = scope.field(query.field)
    if f is None or not query.terms:
        return _nothing()
    if f.posted is not None:
        return _constant(scoring.any_of([f.has_token(str(t)) for t in dict.fromkeys(query.terms)]), query.boost)
    if f.is_text:
        wanted = F.array(*[F.lit(str(t)) for t in query.terms])
        return _constant(F.arrays_overlap(f.tokens, wanted), query.boost)
    values = [_literal(t, f.element_type) for t in query.terms]
    match = F.arrays_overlap(f.column, F.array(*values)) if f.is_array else f.column.isin(*values)
    return _constant(match, query.boost)


def _each_value(f: Field, test: Callable[[Column], Column]) -> Column:
    return F.exists(f.column, test) if f.is_array else test(f.column)


def _wildcard(query: q.Wildcard, scope: Scope, stats: CorpusStatistics) -> Compiled:
    f = scope.field(query.field)
    if f is None:
        return _nothing()
    pattern = query.pattern
    stem = pattern[:-1]
    if f.posted is not None:
        plain_stem = pattern.endswith("*") and "*" not in stem and "?" not in stem
        key = ("prefix", stem) if plain_stem else ("like", pattern)
        return _constant(f.posted.frequency(f.name, key) > 0, query.boost)
    if pattern.endswith("*") and "*" not in stem and "?" not in stem:
        def test(x: Column) -> Column:
            return F.startswith(x.cast("string"), F.lit(stem))
    else:
        regex = analysis.wildcard_regex(pattern)

        def test(x: Column) -> Column:
            return x.cast("string").rlike(regex)
    match = F.exists(f.tokens, test) if f.is_text else _each_value(f, test)
    return _constant(match, query.boost)


# -- ranges --------------------------------------------------------------------

_EPOCH_FORMATS = {"epoch_millis": "timestamp_millis", "epoch_second": "timestamp_seconds"}


def _date_bound(value, query: q.Range) -> Column:
    """A date bound as UTC wall-clock time (``timestamp_ntz``)."""
    text = F.lit(str(value))
    parsed = []
    for fmt in (query.format or "").split("||") if query.format else [None]:
        if fmt in _EPOCH_FORMATS:
            # Epoch bounds are absolute, so no zone applies to them.
            epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
            unit = 1_000 if fmt == "epoch_millis" else 1_000_000
            micros = text.try_cast("bigint") * F.lit(unit)
            parsed.append(epoch + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)")))
            continue
        stamp = text.try_cast("timestamp_ntz") if fmt is None else F.try_to_timestamp(text, F.lit(fmt)).cast(
            "timestamp_ntz"
        )
        if query.time_zone:
            stamp = F.convert_timezone(F.lit(query.time_zone), F.lit("UTC"), stamp)
        parsed.append(stamp)
    return F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]


def _bound(value, dtype: T.DataType, query: q.Range) -> Column | None:
    if value is None:
        return None
    temporal = (T.TimestampNTZType, T.TimestampType, T.DateType)
    if isinstance(dtype, temporal) and (query.format or query.time_zone) and not isinstance(value, Column):
        stamp = _date_bound(value, query)
        if isinstance(dtype, T.TimestampType):
            return F.concat(stamp.cast("string"), F.lit("+00:00")).cast("timestamp")
        return stamp
    if isinstance(dtype, temporal) and isinstance(value, str):
        return F.lit(value).try_cast("timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else dtype)
    if isinstance(value, str) and isinstance(dtype, T.NumericType):
        return F.lit(value).try_cast("double")
    return F.lit(value)


def _range(query: q.Range, scope: Scope, stats: CorpusStatistics) -> Compiled:
    f = scope.field(query.field)
    if f is None:
        return _nothing()
    etype = f.element_type
    if isinstance(etype, T.StructType) and {"gte", "lte"} <= set(etype.fieldNames()):
        return _constant(_interval_match(query, f, etype["gte"].dataType), query.boost)

    gt, gte, lt, lte = (_bound(v, etype, query) for v in (query.gt, query.gte, query.lt, query.lte))

    def inside(x: Column) -> Column:
        tests = []
        if lt is not None:
            tests.append(x < lt)
        elif lte is not None:
            tests.append(x <= lte)
        if gt is not None:
            tests.append(x > gt)
        elif gte is not None:
            tests.append(x >= gte)
        return scoring.all_of(tests) if tests else x.isNotNull()

    if query.relation not in (None, "intersects", "contains", "within"):
        raise ValueError(f"unknown range relation {query.relation!r}")
    return _constant(_each_value(f, inside), query.boost)


def _interval_match(query: q.Range, f: Field, bound_type: T.DataType) -> Column:
    """Relation between the stored interval and the query interval.

    An open end of either interval reaches to infinity.
    """
    gt, gte, lt, lte = (_bound(v, bound_type, query) for v in (query.gt, query.gte, query.lt, query.lte))
    relation = query.relation or "intersects"

    def test(x: Column) -> Column:
        low, high = x["gte"], x["lte"]
        present = low.isNotNull() | high.isNotNull()
        tests = [present]
        if relation == "intersects":
            if lt is not None or lte is not None:
                tests.append(low.isNull() | (low < lt if lt is not None else low <= lte))
            if gt is not None or gte is not None:
                tests.append(high.isNull() | (high > gt if gt is not None else high >= gte))
        elif relation == "within":
            # A NULL comparison (open stored end, closed query end) is no match.
            if lt is not None or lte is not None:
                tests.append(high < lt if lt is not None else high <= lte)
            if gt is not None or gte is not None:
                tests.append(low > gt if gt is not None else low >= gte)
        elif relation == "contains":
            upper, lower = (lt if lt is not None else lte), (gt if gt is not None else gte)
            tests.append(high.isNull() | (high >= upper) if upper is not None else high.isNull())
            tests.append(low.isNull() | (low <= lower) if lower is not None else low.isNull())
        else:
            raise ValueError(f"unknown range relation {relation!r}")
        return scoring.all_of(tests)

    return _each_value(f, test)


# -- full text -------------------------------------------------------------------

def _operator(name: str) -> str:
    if name.lower() not in ("or", "and"):
        raise ValueError(f"unknown operator {name!r}; expected 'or' or 'and'")
    return name.lower()


def _token_score(f: Field, term: str, scope: Scope, stats: CorpusStatistics) -> Column:
    weight = scoring.idf(stats.doc_count(scope, f), stats.term_freq(scope, f, term))
    return scoring.bm25(weight, f.frequency(term), f.length, stats.average_length(scope, f))


def _contains_at_least(f: Field, terms: list[str], needed: int) -> Column:
    """At least ``needed`` of the query tokens occur; the text is split only once."""
    distinct = list(dict.fromkeys(terms))
    if f.posted is not None:
        held = [f.has_token(t) for t in (distinct if needed <= 1 or needed >= len(terms) else terms)]
        if needed <= 1:
            return scoring.any_of(held)
        return scoring.all_of(held) if needed >= len(terms) else scoring.total([h.cast("int") for h in held]) >= needed
    quick = [f.maybe_contains(t) for t in distinct]
    wanted = F.array(*[F.lit(t) for t in distinct])
    if len(distinct) == 1:
        return f.has_token(distinct[0])
    if needed >= len(terms):
        exact = F.size(F.array_intersect(wanted, f.tokens)) == len(distinct)
        filters = quick
    elif needed <= 1:
        exact = F.arrays_overlap(f.tokens, wanted)
        filters = [scoring.any_of(quick)] if quick[0] is not None else []
    elif len(distinct) == len(terms):
        exact = F.size(F.array_intersect(wanted, f.tokens)) >= needed
        filters = [scoring.any_of(quick)] if quick[0] is not None else []
    else:
        counts = [F.array_contains(f.tokens, F.lit(t)).cast("int") for t in terms]
        exact, filters = scoring.total(counts) >= needed, []
    return scoring.all_of([x for x in filters if x is not None] + [exact])


def _tokens_query(f, terms, needed, boost, scope, stats) -> Compiled:
    score = scoring.total([_token_score(f, t, scope, stats) for t in terms])
    return Compiled(_contains_at_least(f, terms, needed), scoring.boosted(score, boost))


def _needed(query, n: int) -> int:
    if _operator(query.operator) == "and":
        return n
    return max(1, analysis.minimum_should_match(getattr(query, "minimum_should_match", None), n) or 1)


def _match(query: q.Match, scope: Scope, stats: CorpusStatistics) -> Compiled:
    _operator(query.operator)
    f = scope.field(query.field)
    if f is None:
        return _nothing()
    if not f.is_text:
        if not isinstance(f.element_type, T.StringType) or query.analyzer is None:
            return _term(q.Term(query.field, query.query, boost=query.boost), scope, stats)
        f = Field(f.name, f.column, f.dtype, query.analyzer)
    terms = analysis.analyze(query.query, query.analyzer or f.analyzer)
    if not terms:
        return _nothing()
    needed = _needed(query, len(terms))
    if query.fuzziness in (None, 0, "0"):
        return _tokens_query(f, terms, needed, query.boost, scope, stats)
    parts = [_fuzzy_token(f, t, query, scope, stats) for t in terms]
    match = scoring.total([p.sure_match.cast("int") for p in parts]) >= needed
    return Compiled(match, scoring.boosted(scoring.total([p.gated_score for p in parts]), query.boost))


def _fuzzy_token(f: Field, term: str, query: q.Match, scope: Scope, stats: CorpusStatistics) -> Compiled:
    """All tokens near ``term`` count as one term: their frequencies add up."""
    if isinstance(query.fuzziness, str) and query.fuzziness.lower() == "auto":
        k = analysis.auto_fuzziness(term)
    else:
        k = int(query.fuzziness)
    if not 0 <= k <= 3:
        raise ValueError(f"fuzziness {query.fuzziness!r} is not 0..3 or 'auto'")

    if f.posted is not None:
        key = ("near", term, k, query.transpositions)
        freq = f.posted.frequency(f.name, key)
        weight = scoring.idf(stats.doc_count(scope, f), f.posted.doc_freq(f.name, key))
        return Compiled(freq > 0, scoring.bm25(weight, freq, f.length, stats.average_length(scope, f)))

    def near(word: Column) -> Column:
        return analysis.edit_distance_within(word, term, k, query.transpositions)

    def holds(g: Field) -> Column:
        return F.exists(g.tokens, near)

    df = stats.doc_freq(scope, f, ("fuzzy", term, k, query.transpositions), holds)
    weight = scoring.idf(stats.doc_count(scope, f), df)
    freq = F.size(F.filter(f.tokens, near))
    score = scoring.bm25(weight, freq, F.size(f.tokens), stats.average_length(scope, f))
    return Compiled(F.coalesce(holds(f), F.lit(False)), score)


def _match_phrase(query: q.MatchPhrase, scope: Scope, stats: CorpusStatistics) -> Compiled:
    f = scope.field(query.field)
    if f is None:
        return _nothing()
    if not f.is_text:
        return _term(q.Term(query.field, query.phrase, boost=query.boost), scope, stats)
    terms = analysis.analyze(query.phrase, query.analyzer or f.analyzer)
    if not terms:
        return _nothing()
    if query.slop < 0:
        raise ValueError("slop must not be negative")
    if len(terms) == 1 and not query.prefix:
        return _tokens_query(f, terms, 1, query.boost, scope, stats)
    weights = [_phrase_term_idf(f, t, query.prefix and i == len(terms) - 1, scope, stats) for i, t in enumerate(terms)]
    if f.posted is not None:
        match, freq = _posted_phrase(f, terms, query)
        score = scoring.bm25(scoring.total(weights), freq, f.length, stats.average_length(scope, f))
        return Compiled(match, scoring.boosted(score, query.boost))
    freq = phrase_frequency(f.tokens, terms, query.slop, query.prefix)
    score = scoring.bm25(scoring.total(weights), freq, F.size(f.tokens), stats.average_length(scope, f))
    tests = [f.maybe_contains(t) for t in dict.fromkeys(terms)]
    tests = [t for t in tests if t is not None] + [phrase_matches(f.tokens, terms, query.slop, query.prefix)]
    return Compiled(scoring.all_of(tests), scoring.boosted(score, query.boost))


def _posted_phrase(f: Field, terms: list[str], query: q.MatchPhrase) -> tuple[Column, Column]:
    """Does the phrase occur, and how often, from the positions of its terms."""
    keys = [("term", t) for t in terms]
    if query.prefix:
        keys[-1] = ("prefix", terms[-1])
    held = [f.posted.frequency(f.name, key) > 0 for key in dict.fromkeys(keys)]
    if len(terms) == 1:
        return held[0], f.posted.frequency(f.name, keys[0]).cast("double")

    def offsets(key: tuple, j: int) -> Column:
        return F.transform(f.posted.positions(f.name, key), lambda p: p - F.lit(j))

    places = F.array(
        *[F.struct(F.lit(t).alias("term"), offsets(key, j).alias("offsets")) for j, (t, key) in enumerate(zip(terms, keys))]
    )
    if query.slop:
        freq = bound(places, lambda p: sloppy_frequency(p, F.lit(query.slop)))
    else:
        freq = exact_frequency(places).cast("double")
    return scoring.all_of(held) & (freq > 0), freq


def _phrase_term_idf(f: Field, term: str, prefix: bool, scope: Scope, stats: CorpusStatistics) -> Column:
    if not prefix:
        return scoring.idf(stats.doc_count(scope, f), stats.term_freq(scope, f, term))
    if f.posted is not None:
        return scoring.idf(stats.doc_count(scope, f), f.posted.doc_freq(f.name, ("prefix", term)))
    df = stats.doc_freq(
        scope, f, ("prefix", term), lambda g: F.exists(g.tokens, lambda x: F.startswith(x, F.lit(term)))
    )
    return scoring.idf(stats.doc_count(scope, f), df)


MULTI_MATCH_TYPES = ("best_fields", "most_fields", "cross_fields", "phrase", "phrase_prefix")


def _multi_match(query: q.MultiMatch, scope: Scope, stats: CorpusStatistics) -> Compiled:
    _operator(query.operator)
    if query.type not in MULTI_MATCH_TYPES:
        raise ValueError(f"unknown type {query.type!r}; expected one of {MULTI_MATCH_TYPES}")
    if not query.fields:
        raise ValueError("a multi-field query needs at least one field")
    weights = query.weights or [1.0] * len(query.fields)
    if len(weights) != len(query.fields):
        raise ValueError(f"{len(query.fields)} fields but {len(weights)} field weights")
    if query.type == "cross_fields":
        return _cross_fields(query, weights, scope, stats)
    parts = []
    for name, weight in zip(query.fields, weights):
        if query.type in ("phrase", "phrase_prefix"):
            one = q.MatchPhrase(name, query.query, prefix=query.type == "phrase_prefix", boost=weight)
        else:
            one = q.Match(name, query.query, query.operator, boost=weight)
        parts.append(compile_query(one, scope, stats))
    scores = [p.gated_score for p in parts]
    score = scoring.total(scores) if query.type == "most_fields" else scoring.largest(scores)
    return Compiled(scoring.any_of([p.match for p in parts]), scoring.boosted(score, query.boost))


def _cross_fields(query, weights, scope, stats) -> Compiled:
    """Fields seen as one: a term counts once, in the field where it scores best."""
    fields = [(scope.field(n), w) for n, w in zip(query.fields, weights)]
    fields = [(f, w) for f, w in fields if f is not None and f.is_text]
    if not fields:
        return _nothing()
    terms = analysis.analyze(query.query, fields[0][0].analyzer)
    if not terms:
        return _nothing()
    n_docs = scoring.largest([stats.doc_count(scope, f) for f, _ in fields])
    matches, scores = [], []
    for term in terms:
        df = scoring.largest([stats.term_freq(scope, f, term) for f, _ in fields])
        weight = scoring.idf(n_docs, df)
        per_field = [
            F.coalesce(
                scoring.boosted(
                    scoring.bm25(weight, f.frequency(term), f.length, stats.average_length(scope, f)),
                    w,
                ),
                F.lit(0.0),
            )
            for f, w in fields
        ]
        scores.append(scoring.largest(per_field))
        matches.append(scoring.any_of([F.coalesce(f.has_token(term), F.lit(False)) for f, _ in fields]))
    match = scoring.all_of(matches) if _operator(query.operator) == "and" else scoring.any_of(matches)
    return Compiled(match, scoring.boosted(scoring.total(scores), query.boost))


# -- compound ------------------------------------------------------------------

def _bool(query: q.Bool, scope: Scope, stats: CorpusStatistics) -> Compiled:
    if not query.clauses:
        raise ValueError("a boolean query needs at least one clause")
    by_occur: dict[str, list[Compiled]] = {occur: [] for occur in OCCURS}
    inner: dict[str, Column] = {}
    for clause in query.clauses:
        if clause.occur not in OCCURS:
            raise ValueError(f"a clause must say how it occurs, one of {OCCURS}; got {clause.occur!r}")
        if not clause.queries:
            raise ValueError("a clause needs at least one query")
        for part in clause.queries:
            compiled = compile_query(part, scope, stats)
            by_occur[clause.occur].append(compiled)
            inner.update(compiled.inner_hits)
    must, should = by_occur["must"], by_occur["should"]
    needed = analysis.minimum_should_match(query.minimum_should_match, len(should))
    if needed is None:
        needed = 1 if should and not must and not by_occur["filter"] else 0
    elif should and not must and not by_occur["filter"]:
        needed = max(1, needed)
    tests = [c.match for c in by_occur["filter"] + must] + [~c.sure_match for c in by_occur["must_not"]]
    if needed == 1:
        tests.append(scoring.any_of([c.match for c in should]))
    elif needed and needed == len(should):
        tests += [c.match for c in should]
    elif needed:
        tests.append(scoring.total([c.sure_match.cast("int") for c in should]) >= needed)
    score = scoring.total([c.score for c in must] + [c.gated_score for c in should])
    return Compiled(scoring.all_of(tests), scoring.boosted(score, query.boost), inner)


def _constant_score(query: q.ConstantScore, scope: Scope, stats: CorpusStatistics) -> Compiled:
    inner = compile_query(query.query, scope, stats)
    return Compiled(inner.match, F.lit(float(query.boost)), inner.inner_hits)


def _dis_max(query: q.DisMax, scope: Scope, stats: CorpusStatistics) -> Compiled:
    if not query.queries:
        raise ValueError("a dis_max query needs at least one query")
    parts = [compile_query(p, scope, stats) for p in query.queries]
    scores = [p.gated_score for p in parts]
    best = scoring.largest(scores)
    score = best
    if query.tie_breaker:
        score = best + F.lit(float(query.tie_breaker)) * (scoring.total(scores) - best)
    inner = {path: c for p in parts for path, c in p.inner_hits.items()}
    return Compiled(scoring.any_of([p.match for p in parts]), scoring.boosted(score, query.boost), inner)


def _factor(factor: q.FieldValueFactor, scope: Scope) -> Column:
    f = scope.field(factor.field)
    missing = F.lit(float(factor.missing))
    if f is None:
        value = missing
    else:
        column = F.array_min(f.column) if f.is_array else f.column
        value = F.coalesce(column.cast("double"), missing)
    return scoring.modifier(factor.modifier, scoring.boosted(value, factor.factor))


def _function_score(query: q.FunctionScore, scope: Scope, stats: CorpusStatistics) -> Compiled:
    inner = compile_query(query.query, scope, stats)
    base = scoring.boosted(inner.score, query.boost)
    if query.functions:
        value = _function_list(query, scope, stats)
        score = F.when(value.isNull(), base).otherwise(scoring.combine(query.boost_mode, base, value))
    elif query.field_value_factor is not None:
        score = scoring.combine(query.boost_mode, base, _factor(query.field_value_factor, scope))
    else:
        raise ValueError("a function score needs a field value factor or a list of functions")
    return Compiled(inner.match, score, inner.inner_hits)


def _function_list(query: q.FunctionScore, scope: Scope, stats: CorpusStatistics) -> Column:
    """Combined value of the functions that apply; NULL if none does."""
    if query.score_mode not in ("multiply", "sum", "avg", "max", "min"):
        raise ValueError(f"functions cannot be combined by {query.score_mode!r}")
    values, applies, weights = [], [], []
    for item in query.functions:
        value = F.lit(1.0) if item.function is None else _factor(item.function, scope)
        hit = F.lit(True) if item.filter is None else compile_query(item.filter, scope, stats).sure_match
        values.append(scoring.boosted(value, item.weight))
        applies.append(hit)
        weights.append(float(item.weight))
    any_applies = scoring.any_of(applies)

    def gated(default: float) -> list[Column]:
        return [F.when(a, v).otherwise(F.lit(default)) for a, v in zip(applies, values)]

    if query.score_mode == "sum":
        result = scoring.total(gated(0.0))
    elif query.score_mode == "avg":
        # Weighted mean: each value already carries its weight.
        used = scoring.total([F.when(a, F.lit(w)).otherwise(F.lit(0.0)) for a, w in zip(applies, weights)])
        result = F.try_divide(scoring.total(gated(0.0)), used)
    elif query.score_mode == "multiply":
        result = gated(1.0)[0]
        for factor in gated(1.0)[1:]:
            result = result * factor
    else:
        present = [F.when(a, v) for a, v in zip(applies, values)]
        pick = F.greatest if query.score_mode == "max" else F.least
        result = pick(*present) if len(present) > 1 else present[0]
    return F.when(any_applies, result)


# -- nested --------------------------------------------------------------------

DEFAULT_INNER_HITS = 3
NESTED_SCORE_MODES = ("sum", "avg", "min", "max", "none")


def _nested(query: q.Nested, scope: Scope, stats: CorpusStatistics) -> Compiled:
    if query.score_mode not in NESTED_SCORE_MODES:
        raise ValueError(f"unknown score mode {query.score_mode!r}; expected one of {NESTED_SCORE_MODES}")
    f = scope.field(query.path)
    if f is None:
        return _nothing()

    def child(x: Column, part: q.Query = query.query) -> Compiled:
        return compile_query(part, scope.children(query.path, x), stats)

    match = F.exists(f.column, lambda x: child(x).match)
    held = _held_by_children(query, scope)
    if held is not None:
        match = held & match
    inner = {}
    if query.inner_hits is not None:
        inner[scope.local_name(query.path)] = _inner_hits(query, f, child, scope)
    if query.score_mode == "none":
        return Compiled(match, F.lit(0.0), inner)
    def scored_child(x: Column) -> Column:
        compiled = child(x)
        return F.when(compiled.match, F.coalesce(compiled.score.cast("double"), F.lit(0.0)))

    scores = F.array_compact(F.transform(f.column, scored_child))
    if query.score_mode == "max":
        score = F.array_max(scores)
    elif query.score_mode == "min":
        score = F.array_min(scores)
    else:
        score = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x)
        if query.score_mode == "avg":
            score = F.try_divide(score, F.size(scores))
    return Compiled(match, scoring.boosted(score, query.boost), inner)


def _inner_hits(query: q.Nested, f: Field, child, scope: Scope) -> Column:
    """Matching children, best first: ``array<struct<offset, score, fields…>>``."""
    from .highlight import highlight_column, highlight_terms

    spec = query.inner_hits
    size = DEFAULT_INNER_HITS if spec.size is None else spec.size
    hidden = [tokens_name(n) for n in scope.children(query.path).text_fields]
    names = [n for n in f.dtype.elementType.fieldNames() if n not in hidden]
    hidden = [n for n in hidden if n in f.dtype.elementType.fieldNames()]
    prefix = scope.local_name(query.path) + "."
    if spec.fields:
        from ..functions.fields import expand_names

        wanted = [n[len(prefix):] if n.startswith(prefix) else n for n in spec.fields]
        shown = expand_names(names, wanted)
    else:
        shown = [] if spec.fetch_source else names

    def describe(x: Column, i: Column) -> Column:
        compiled = child(x)
        columns = [
            (-F.coalesce(compiled.score.cast("double"), F.lit(0.0))).alias("_rank"),
            i.alias("_offset"),
            compiled.score.cast("double").alias("_score"),
        ]
        columns += [x[n].alias(n) for n in shown]
        if spec.fetch_source:
            columns.append((x.dropFields(*hidden) if hidden else x).alias("_source"))
        if spec.explain:
            columns.append(_explanation(query.query, child, x).alias("_explain"))
        if spec.highlight is not None:
            child_scope = scope.children(query.path, x)
            for hl in spec.highlight.fields:
                target = child_scope.field(hl.field)
                if target is not None:
                    terms = highlight_terms(hl.query or query.query, child_scope, target.name, hl)
                    columns.append(highlight_column(target.column, terms, hl).alias(f"{target.name}_highlight"))
        # Children that do not match are not described, let alone scored.
        return F.when(compiled.match, F.struct(*columns))

    described = F.array_compact(F.transform(f.column, describe))
    ranked = F.slice(F.sort_array(described), 1, size) if size > 0 else F.slice(described, 1, 0)
    return F.transform(ranked, lambda s: s.dropFields("_rank"))


def _explanation(query: q.Query, child, x: Column) -> Column:
    """Score of each clause of the child query (or of the whole, if it has none)."""
    parts = [p for c in query.clauses for p in c.queries] if isinstance(query, q.Bool) else [query]
    return F.struct(*[child(x, p).gated_score.cast("double").alias(f"clause_{i}") for i, p in enumerate(parts)])


_RULES = {
    q.MatchAll: _match_all,
    q.Term: _term,
    q.Terms: _terms,
    q.Match: _match,
    q.MatchPhrase: _match_phrase,
    q.MultiMatch: _multi_match,
    q.Bool: _bool,
    q.ConstantScore: _constant_score,
    q.DisMax: _dis_max,
    q.FunctionScore: _function_score,
    q.Nested: _nested,
    q.Wildcard: _wildcard,
    q.Range: _range,
}
