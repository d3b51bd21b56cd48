"""Where a query looks up its fields, and the corpus statistics its scores need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import analysis
from ..functions.fields import field_type
from .posted import PostingsView

STATS = "_stats"
KEYWORD_SUFFIX = ".keyword"


def stored_name(path: str, field: str) -> str:
    """Name under which an index knows a field of the documents or of their children."""
    return f"{path}.{field}" if path else field


def tokens_name(field: str) -> str:
    """Name of the stored tokens column of a text field."""
    return f"{field}_tokens"


@dataclass(frozen=True)
class Field:
    """One resolved field: its value column, type and, for text, how it is analysed."""

    name: str
    column: Column
    dtype: T.DataType
    analyzer: str | None = None
    stored_tokens: Column | None = None
    posted: PostingsView | None = None

    @property
    def is_array(self) -> bool:
        return isinstance(self.dtype, T.ArrayType)

    @property
    def element_type(self) -> T.DataType:
        return self.dtype.elementType if self.is_array else self.dtype

    @property
    def is_text(self) -> bool:
        return self.analyzer is not None

    @property
    def tokens(self) -> Column:
        if self.stored_tokens is not None:
            return self.stored_tokens
        if self.is_array:
            return analysis.multi_value_tokens(self.column, self.analyzer or "standard")
        return analysis.tokens(self.column, self.analyzer or "standard")

    def maybe_contains(self, term: str) -> Column | None:
        """A cheap necessary condition for holding ``term``, or None.

        It spares documents without the term the split into tokens.
        """
        if self.posted is not None or self.stored_tokens is not None or self.is_array or not self.is_text:
            return None
        text = F.lower(self.column) if self.analyzer == "standard" else self.column
        return F.contains(text, F.lit(term))

    def has_token(self, term: str) -> Column:
        if self.posted is not None:
            return self.frequency(term) > 0
        exact = F.array_contains(self.tokens, F.lit(term))
        quick = self.maybe_contains(term)
        return exact if quick is None else quick & exact

    def frequency(self, term: str) -> Column:
        """Occurrences of a token."""
        if self.posted is not None:
            return self.posted.frequency(self.name, ("term", term))
        return F.size(self.tokens) - F.size(F.array_remove(self.tokens, term))

    @property
    def length(self) -> Column:
        """Number of tokens."""
        return F.size(self.tokens) if self.posted is None else self.posted.length(self.name)


class Scope:
    """Field lookup for one level of documents: the root or the children of a path.

    ``bind`` turns a top-level field name into a column of the current row; for
    children inside an array it reaches into the lambda variable instead.
    """

    def __init__(
        self,
        schema: T.StructType,
        text_fields: dict[str, str],
        rows: DataFrame | Callable[[], DataFrame],
        bind: Callable[[str], Column] | None = None,
        path: str = "",
        view: PostingsView | None = None,
    ):
        self.schema = schema
        self.text_fields = text_fields
        self._rows = rows
        self.path = path
        #: Answers for text fields of the root, where an index has them.
        self.view = view
        self._bind = bind or (lambda name: F.col(f"`{name}`"))

    @property
    def rows(self) -> DataFrame:
        """All documents of this level, for counting."""
        return self._rows() if callable(self._rows) else self._rows

    def local_name(self, name: str) -> str:
        prefix = self.path + "."
        return name[len(prefix):] if self.path and name.startswith(prefix) else name

    def field(self, name: str) -> Field | None:
        """The field, or None if documents of this schema never have it."""
        name = self.local_name(name)
        analyzer = self.text_fields.get(name)
        if field_type(self.schema, name) is None and name.endswith(KEYWORD_SUFFIX):
            name, analyzer = name[: -len(KEYWORD_SUFFIX)], None
        dtype = field_type(self.schema, name)
        if dtype is None:
            return None
        top, *rest = name.split(".")
        column = self._bind(top)
        for part in rest:
            column = column[part]
        stored = None
        if analyzer is not None and field_type(self.schema, tokens_name(name)) is not None:
            stored = self._bind(tokens_name(name))
        posted = self.view if analyzer is not None and self.view is not None and self.view.covers(name) else None
        return Field(name, column, dtype, analyzer, stored, posted)

    def children(self, path: str, element: Column | None = None) -> "Scope":
        """Scope of the children under ``path``; ``element`` is the lambda variable."""
        path = self.local_name(path)
        dtype = field_type(self.schema, path)
        if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
            raise ValueError(f"nested path {path!r} is not an array of structs")
        prefix = path + "."
        text = {k[len(prefix):]: v for k, v in self.text_fields.items() if k.startswith(prefix)}

        def rows() -> DataFrame:
            return self.rows.select(F.explode(F.col(path)).alias("_child")).select("_child.*")

        bind = None if element is None else (lambda name: element[name])
        full_path = f"{self.path}.{path}" if self.path else path
        return Scope(dtype.elementType, text, rows, bind, full_path)

    def flat(self) -> "Scope":
        """The same level seen from ``rows``, one row per document of this level."""
        return Scope(self.schema, self.text_fields, self._rows, None, self.path)


class CorpusStatistics:
    """Collects the counts a query's scores need and reads them in one pass.

    A query is compiled twice: the first run records which counts are needed,
    the second refers to them as fields of the one-row ``_stats`` struct, which
    ``attach`` adds as a scalar subquery.  Nothing is collected on the driver.
    """

    def __init__(self, index=None):
        self.index = index
        self._requests: dict[tuple, tuple[str, Scope, Callable[[Scope], Column]]] = {}
        self.recording = True

    def forget(self) -> None:
        """Start again, as if nothing had been asked for."""
        self._requests.clear()
        self.recording = True

    # -- what can be asked for -------------------------------------------------
    def doc_count(self, scope: Scope, field: Field) -> Column:
        """Documents that have the field."""
        def build(flat: Scope) -> Column:
            f = flat.field(field.name)
            present = F.size(f.tokens) > 0 if f.is_text else f.column.isNotNull()
            return F.count(F.when(present, F.lit(1)))
        return self._need(scope, ("n_docs", field.name), build)

    def average_length(self, scope: Scope, field: Field) -> Column:
        """Mean number of tokens of the documents that have the field."""
        def build(flat: Scope) -> Column:
            size = F.size(flat.field(field.name).tokens)
            return F.avg(F.when(size > 0, size))
        return self._need(scope, ("avgdl", field.name), build)

    def doc_freq(self, scope: Scope, field: Field, key, holds: Callable[[Field], Column]) -> Column:
        """Documents whose field satisfies ``holds``; ``key`` names the condition."""
        def build(flat: Scope) -> Column:
            return F.count(F.when(holds(flat.field(field.name)), F.lit(1)))
        return self._need(scope, ("df", field.name, key), build)

    def term_freq(self, scope: Scope, field: Field, term: str) -> Column:
        """Document frequency of one token."""
        return self.doc_freq(scope, field, ("term", term), lambda f: F.array_contains(f.tokens, F.lit(term)))

    def _need(self, scope: Scope, what: tuple, build: Callable[[Scope], Column]) -> Column:
        key = (scope.path, *what)
        if key not in self._requests:
            if not self.recording:
                raise RuntimeError(f"statistic {key} was not recorded")
            self._requests[key] = (f"s{len(self._requests)}", scope, build)
        name = self._requests[key][0]
        return F.lit(1.0) if self.recording else F.col(STATS)[self._source(key)][name]

    def _source(self, key: tuple) -> str:
        """Where a count comes from: a stored table, or the documents of one level."""
        if self.index is not None and self._in_index(key):
            return "terms" if key[1] == "df" else "fields"
        return f"level_{key[0]}"

    # -- where the numbers come from ---------------------------------------------
    @property
    def needed(self) -> bool:
        return bool(self._requests)

    def attach(self, docs: DataFrame) -> DataFrame:
        """Add the struct ``_stats`` holding every recorded count."""
        self.recording = False
        if not self._requests:
            return docs
        by_source: dict[str, dict[tuple, tuple]] = {}
        for key, request in self._requests.items():
            by_source.setdefault(self._source(key), {})[key] = request
        # One scalar subquery per source, each used once in the plan.
        parts = []
        for source, requests in sorted(by_source.items()):
            if source == "terms":
                row = self.index.term_row({k: r[0] for k, r in requests.items()})
            elif source == "fields":
                row = self.index.field_row({k: r[0] for k, r in requests.items()})
            else:
                row = _count(list(requests.values()))
            parts.append(row.scalar().alias(source))
        return docs.withColumn(STATS, F.struct(*parts))

    def _in_index(self, key: tuple) -> bool:
        path, kind, field, *rest = key
        if not self.index.covers(stored_name(path, field)):
            return False
        return kind in ("n_docs", "avgdl") or (kind == "df" and rest[0][0] == "term")


def _count(requests: list[tuple]) -> DataFrame:
    """All counts over the documents of one level, as one row with one struct."""
    flat = requests[0][1].flat()
    rows = flat.rows
    # Tokens are split once per document, not once per count.
    for name in sorted(flat.text_fields):
        f = flat.field(name)
        if f is not None and f.stored_tokens is None and "." not in name:
            rows = rows.withColumn(tokens_name(name), f.tokens)
    counted = Scope(rows.schema, flat.text_fields, rows, None, flat.path)
    return rows.agg(F.struct(*[build(counted).alias(name) for name, _, build in requests]).alias(STATS))
