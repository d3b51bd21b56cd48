"""Many searches in one job: queries are rows, joined with the postings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import analysis, scoring
from ..functions.binding import bound
from ..operators.joins import SALTS, Requests, fuzzy_matches, prefix_matches, settle
from ..operators.phrases import exact_frequency, sloppy_frequency
from ..operators.topn import top_n_per_group
from .index import TextIndex

# Documents whose scores are folded as arrays: so many numbers of documents times classes or clauses at once.
FOLD_NUMBERS = 1 << 20
# Rows of so many are gathered for that.
FOLD_ROWS = 1 << 18
# So many candidates are kept, besides the best of every query, before they are cut to those.
FOLD_CANDIDATES = 1 << 19


def _with_sizes(rows: DataFrame, index: TextIndex) -> DataFrame:
    """Add ``n_docs`` and ``avgdl`` of the row's field.

    The sizes are a map with one entry per text field, read by a scalar subquery;
    a join on a column that is often constant would turn into a cross join.
    """
    entry = F.struct("field", F.struct("n_docs", (F.col("sum_dl") / F.col("n_docs")).alias("avgdl")))
    sizes = index.field_stats.agg(F.map_from_entries(F.collect_list(entry)).alias("sizes")).scalar()
    sized = rows.withColumn("_size", sizes[F.col("field")])
    return sized.withColumns({"n_docs": F.col("_size.n_docs"), "avgdl": F.col("_size.avgdl")}).drop("_size")


def _weighted(terms: Requests, index: TextIndex, rows: DataFrame | None = None) -> DataFrame:
    """Add ``weight`` (idf) and ``avgdl`` to rows of (field, term)."""
    keys = index.keys
    wanted = terms.hinted(index.with_bucket(terms.rows if rows is None else rows))
    known = _with_sizes(index.term_stats.select(*keys, "df").join(wanted, keys), index)
    return known.withColumn("weight", scoring.idf(F.col("n_docs"), F.col("df"))).drop("n_docs")


def _bm25(tf: str = "tf") -> Column:
    return scoring.bm25(F.col("weight"), F.col(tf), F.col("dl"), F.col("avgdl"))


def numbered(rows: DataFrame, keys: list[str], extra: list[str] = ()) -> tuple[Requests, DataFrame]:
    """The distinct ``keys`` with a number ``_unit``, and the rows with it instead of them."""
    units = rows.select(*keys, *extra).distinct().withColumn("_unit", F.monotonically_increasing_id())
    units = settle(units)
    return units, rows.join(F.broadcast(units.rows.select(*keys, "_unit")), keys).drop(*keys, *extra)


def meet(weighted: Requests, index: TextIndex) -> DataFrame:
    """Weighted request rows with the ``_id`` and ``score`` of each posting of their terms.

    A posting is scored and sent to its document's partition once, however many requests want its term; it meets
    the requests there, so what follows per request and document needs no exchange.
    """
    if not weighted.small:
        return index.postings_for(weighted, columns=["_id", "tf", "dl"]).withColumn("score", _bm25()).drop("tf", "dl", *index.keys[:-2])
    units, wanted = numbered(weighted.rows, index.keys, ["weight", "avgdl", "df"])
    scored = index.postings_for(units, columns=["_id", "tf", "dl"]).select("_unit", "_id", _bm25().alias("score"))
    scored = index.by_document(scored, weighted.rows.agg(F.sum("df")).first()[0])
    names = units.rows.select("_unit", "field", "term")
    return scored.join(F.broadcast(wanted.join(F.broadcast(names), "_unit")), "_unit").drop("_unit")


def batch_match(
    queries: DataFrame,
    index: TextIndex,
    field: str,
    n: int,
    operator: str = "or",
    analyzer: str = "standard",
) -> DataFrame:
    """The ``n`` best documents of each row ``(query_id, query)``: one match query per row.

    Returns ``(query_id, rank, _id, _score)``.
    """
    if operator not in ("or", "and"):
        raise ValueError(f"unknown operator {operator!r}; expected 'or' or 'and'")
    words = queries.select("query_id", F.explode(analysis.tokens(F.col("query"), analyzer)).alias("term"))
    words = words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
    if operator == "and":
        total = words.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
        words = words.join(total, "query_id")
    words = settle(words.withColumn("field", F.lit(field)))
    weighted = settle(_weighted(words, index))
    pairs = meet(weighted, index)
    measures = [F.sum(F.col("score") * F.col("times")).alias("_score")]
    if operator == "and":
        measures += [F.count(F.lit(1)).alias("found"), F.max("n_terms").alias("n_terms")]
    hits = pairs.groupBy("query_id", "_id").agg(*measures)
    if operator == "and":
        hits = hits.filter(F.col("found") == F.col("n_terms")).drop("found", "n_terms")
    # Equal documents add the same terms in any order; rounding keeps their tie.
    order = [F.round("_score", 9).desc(), F.col("_id").asc()]
    return top_n_per_group(hits, ["query_id"], order, n)


# -- flat query strings ------------------------------------------------------------

# The switches of the simple syntax, and the most edits a near word may have.
DEFAULT_EDITS, MAX_EDITS = 2, 3
FLAGS = ("and", "or", "not", "prefix", "phrase", "escape", "whitespace", "fuzzy", "near", "slop")


@dataclass
class QueryStrings:
    """How a column of flat query strings is read.

    ``syntax`` is ``full`` (``AND OR NOT``, ``field:term``, ``^boost``) or
    ``simple`` (``+ | -``).  ``fields`` with ``boosts`` are searched where a part
    names no field.  ``flags`` (simple syntax) says which operators are active;
    the characters of the others are plain text.
    """

    fields: list[str]
    boosts: list[float] | None = None
    syntax: str = "full"
    default_operator: str = "or"
    analyzer: str = "standard"
    flags: list[str] | None = None
    minimum_should_match: str | int | None = None

    def __post_init__(self):
        if not self.fields:
            raise ValueError("query strings need at least one field")
        if self.boosts and len(self.boosts) != len(self.fields):
            raise ValueError(f"{len(self.fields)} fields but {len(self.boosts)} boosts")
        if self.syntax not in ("full", "simple"):
            raise ValueError(f"unknown syntax {self.syntax!r}")
        if self.default_operator.lower() not in ("or", "and"):
            raise ValueError(f"unknown operator {self.default_operator!r}; expected 'or' or 'and'")
        unknown = {f.lower() for f in self.flags or []} - set(FLAGS) - {"all", "none"}
        if unknown:
            raise ValueError(f"unknown flags {sorted(unknown)}")

    def on(self, *flags: str) -> bool:
        """Is any of the flags active?"""
        if self.flags is None or "all" in [f.lower() for f in self.flags]:
            return True
        return any(f in [x.lower() for x in self.flags] for f in flags)


def clause_rows(strings: DataFrame, spec: QueryStrings) -> DataFrame:
    """One row per clause and field of each ``(query_id, query)``.

    ``query_id, clause_id, occur, kind, field, terms, k, boost`` where ``kind`` is
    ``term``, ``phrase``, ``prefix``, ``fuzzy`` or ``all`` and ``k`` is the slop or
    the edit distance.

    The parts of a string are an array, refined by one ``transform`` per step;
    each step refers only to the one before.
    """
    parts = F.regexp_extract_all(F.col("query"), F.lit(_parts_regex(spec)), 0)
    shaped = bound(parts, lambda p: F.transform(p, lambda part, i: _with_occur(spec, p, part, i)))
    shaped = F.filter(shaped, lambda c: ~_is_one_of(c["part"], _operators(spec)))
    for step in (_without_sign, _without_boost, _without_field, _with_kind, _with_terms, _with_final_kind):
        shaped = F.transform(shaped, partial(step, spec))
    rows = strings.select("query_id", F.posexplode(shaped).alias("clause_id", "c"))
    rows = rows.filter((F.size("c.terms") > 0) | (F.col("c.kind") == "all"))
    boosts = spec.boosts or [1.0] * len(spec.fields)
    defaults = F.array(
        *[F.struct(F.lit(f).alias("field"), F.lit(float(b)).alias("boost")) for f, b in zip(spec.fields, boosts)]
    )
    own = F.array(F.struct(F.col("c.field").alias("field"), F.lit(1.0).alias("boost")))
    targets = F.when(F.col("c.field") != "", own).otherwise(defaults)
    return rows.withColumn("target", F.explode(targets)).select(
        "query_id", "clause_id", "c.occur", "c.kind", F.col("target.field").alias("field"), "c.terms", "c.k",
        (F.col("c.boost") * F.col("target.boost")).alias("boost"),
    )


# The operators of the two syntaxes, and the parts of a string.
_WORDS = {
    "full": {"and": ["AND", "&&"], "or": ["OR", "||"], "not": ["NOT", "!"]},
    "simple": {"and": ["+"], "or": ["|"], "not": ["-"]},
}
_SIGNS = {"full": {"and": "+", "or": "", "not": "-"}, "simple": {"and": "+", "or": "|", "not": "-"}}
_PHRASE = r'"[^"]*"(?:~\d+)?(?:\^[\d.]+)?'


def _parts_regex(spec: QueryStrings) -> str:
    if not spec.on("whitespace"):
        return r"[\s\S]+"
    if not spec.on("phrase"):
        return r"\S+"
    named = "" if spec.syntax == "simple" else r"(?:[\w.]+:)?"
    return rf"[+\-|]?{named}{_PHRASE}|\S+"


def _operators(spec: QueryStrings) -> list[str]:
    return [w for name, words in _WORDS[spec.syntax].items() if spec.on(name) for w in words]


def _is_one_of(col: Column, words: list[str]) -> Column:
    return F.coalesce(col.isin(*words), F.lit(False)) if words else F.lit(False)


def _with_occur(spec: QueryStrings, parts: Column, part: Column, i: Column) -> Column:
    """The role of a part, from its sign and the operators around it."""
    words, signs = _WORDS[spec.syntax], _SIGNS[spec.syntax]

    def neighbour(step: int) -> Column:
        return F.get(parts, i + F.lit(step))

    def signed(col: Column, name: str) -> Column:
        sign = signs[name]
        return F.coalesce(F.startswith(col, F.lit(sign)) & (F.length(col) > 1), F.lit(False)) if sign else F.lit(False)

    def linked(name: str) -> Column:
        link = _is_one_of(neighbour(-1), words[name]) | _is_one_of(neighbour(1), words[name]) | signed(part, name)
        # In the simple syntax a sign ties its part to the one before.
        return link | signed(neighbour(1), name) if spec.syntax == "simple" else link

    required = linked("and") | (
        _is_one_of(neighbour(-1), words["not"]) & _is_one_of(neighbour(-2), words["and"])
    )
    negated = _is_one_of(neighbour(-1), words["not"]) | signed(part, "not")
    occur = F.lit("must" if spec.default_operator.lower() == "and" else "should")
    for name, test, role in (("or", linked("or"), "should"), ("and", required, "must"), ("not", negated, "must_not")):
        if spec.on(name):
            occur = F.when(test, F.lit(role)).otherwise(occur)
    return F.struct(part.alias("part"), occur.alias("occur"))


def _without_sign(spec: QueryStrings, c: Column) -> Column:
    signs = "".join(sign for name, sign in _SIGNS[spec.syntax].items() if spec.on(name))
    body = F.regexp_replace(c["part"], rf"^[{signs}]", "") if signs else c["part"]
    return F.struct(body.alias("body"), c["occur"].alias("occur"))


def _without_boost(spec: QueryStrings, c: Column) -> Column:
    body, boost = c["body"], F.lit(1.0)
    if spec.syntax == "full":
        boost = F.coalesce(F.regexp_extract(body, r"\^([\d.]+)$", 1).try_cast("double"), boost)
        body = F.regexp_replace(body, r"\^[\d.]+$", "")
    return F.struct(body.alias("body"), c["occur"].alias("occur"), boost.alias("boost"))


def _without_field(spec: QueryStrings, c: Column) -> Column:
    body, field = c["body"], F.lit("")
    if spec.syntax == "full":
        # ``*:*`` names no field, as its star is no word character.
        field = F.regexp_extract(body, r"^([\w.]+):(?=.)", 1)
        body = F.regexp_replace(body, r"^[\w.]+:(?=.)", "")
    return F.struct(body.alias("body"), c["occur"].alias("occur"), c["boost"].alias("boost"), field.alias("field"))


def _with_kind(spec: QueryStrings, c: Column) -> Column:
    body = c["body"]
    # Behind a backslash (where escapes are on) an operator is plain text.
    plain = r'[^"\\]' if spec.on("escape") else r'[^"]'
    kind = F.lit("term")
    if spec.on("fuzzy"):
        kind = F.when(body.rlike(rf'^[^"]*{plain}~\d*$'), F.lit("fuzzy")).otherwise(kind)
    if spec.on("prefix"):
        kind = F.when(body.rlike(rf'^[^"]*{plain}\*$'), F.lit("prefix")).otherwise(kind)
    if spec.on("phrase"):
        kind = F.when(body.rlike(r'^".*"(~\d+)?$'), F.lit("phrase")).otherwise(kind)
    kind = F.when(body.isin("*", "*:*"), F.lit("all")).otherwise(kind)
    return F.struct(c.alias("c"), kind.alias("kind"))


def _with_terms(spec: QueryStrings, x: Column) -> Column:
    """Analysed words, and the number behind the tilde."""
    c, kind = x["c"], x["kind"]
    number = F.regexp_extract(c["body"], r"~(\d+)$", 1).try_cast("int")
    slop = F.coalesce(number, F.lit(0)) if spec.on("near", "slop") else F.lit(0)
    too_many = F.raise_error(F.concat(F.lit(f"at most {MAX_EDITS} edits are supported: "), c["body"])).cast("int")
    edits = F.coalesce(number, F.lit(DEFAULT_EDITS))
    edits = F.when((kind == "fuzzy") & (edits > MAX_EDITS), too_many).otherwise(edits)
    k = F.when(kind == "phrase", slop).when(kind == "fuzzy", edits).otherwise(F.lit(0))
    tilde = kind.isin("phrase", "fuzzy")
    text = F.when(tilde, F.regexp_replace(c["body"], r"~\d*$", "")).otherwise(c["body"])
    return F.struct(
        c["occur"].alias("occur"), c["boost"].alias("boost"), c["field"].alias("field"), kind.alias("kind"),
        k.alias("k"), analysis.tokens(text, spec.analyzer).alias("terms"),
    )


def _with_final_kind(spec: QueryStrings, c: Column) -> Column:
    """A prefix, near word or phrase needs its shape; anything else is plain text."""
    one = F.size(c["terms"]) == 1
    shapeless = (c["kind"].isin("prefix", "fuzzy") & ~one) | ((c["kind"] == "phrase") & one)
    return c.withField("kind", F.when(shapeless, F.lit("term")).otherwise(c["kind"]))


_CLAUSE = ["query_id", "clause_id", "field"]


def search_clauses(
    clauses: DataFrame,
    index: TextIndex,
    n: int | None,
    default_operator: str = "or",
    minimum_should_match: str | int | None = None,
    combine_fields: str = "max",
) -> DataFrame:
    """Evaluate clause rows as one boolean query per ``query_id``.

    Returns ``(query_id, _id, _score)``, with ``rank`` and only the best ``n`` if
    ``n`` is given.
    """
    clauses = settle(clauses)
    # Five kinds and three numbers of edits at most: only the parts that occur are planned.
    edits = F.when(F.col("kind") == "fuzzy", F.col("k")).otherwise(F.lit(0)).alias("k")
    shapes = {(r["kind"], r["k"]) for r in clauses.rows.select("kind", edits).distinct().collect()}
    kinds = {kind for kind, _ in shapes}
    # Fields with a dot may be children's, whose postings name the parent more than once.
    flat = not any("." in field for field in index.fields)
    if clauses.small and flat and "all" not in kinds and _plain_clauses(clauses.rows) and index.unique_ids():
        found = _search_plain(clauses, index, n, kinds, sorted(k for kind, k in shapes if kind == "fuzzy"), minimum_should_match)
        if found is not None:
            return found
    counts = settle(_clause_counts(clauses.rows))
    only_not = counts.rows.filter((F.col("n_must") == 0) & (F.col("n_should") == 0))
    parts = []
    if kinds & {"term", "prefix", "fuzzy"}:
        parts.append(_word_units(clauses, index, kinds, sorted(k for kind, k in shapes if kind == "fuzzy")))
    if "phrase" in kinds:
        parts.append(_phrase_units(clauses, index))
    if "all" in kinds or not only_not.isEmpty() or not parts:
        parts.append(_all_units(clauses, only_not, index))
    units = reduce(DataFrame.unionByName, parts)

    # One exchange serves the three groupings below, as each is within (query, document).
    units = units.repartition("query_id", "_id")
    per_field = units.groupBy(*_CLAUSE, "occur", "_id").agg(
        (F.sum("score") * F.max("boost")).alias("score"),
        F.count(F.lit(1)).alias("found"),
        F.max("n_units").alias("n_units"),
    )
    if default_operator.lower() == "and":
        per_field = per_field.filter(F.col("found") == F.col("n_units"))
    combine = F.max if combine_fields == "max" else F.sum
    per_clause = per_field.groupBy("query_id", "clause_id", "occur", "_id").agg(combine("score").alias("score"))
    is_a = {o: F.col("occur") == o for o in ("must", "should", "must_not")}
    per_doc = per_clause.groupBy("query_id", "_id").agg(
        F.sum(F.when(~is_a["must_not"], F.col("score")).otherwise(F.lit(0.0))).alias("_score"),
        *[F.sum(F.when(test, F.lit(1)).otherwise(F.lit(0))).alias(o) for o, test in is_a.items()],
    )

    needed = _needed(minimum_should_match)
    hits = per_doc.join(counts.hinted(), "query_id").filter(_fits(needed)).select("query_id", "_id", "_score")
    if n is None:
        return hits
    return top_n_per_group(hits, ["query_id"], [F.round("_score", 9).desc(), F.col("_id").asc()], n)


def _needed(minimum_should_match: str | int | None) -> Column:
    """How many optional clauses a document has to meet."""
    needed = _needed_column(minimum_should_match, F.col("n_should"))
    lonely = (F.col("n_must") == 0) & (F.col("n_should") > 0)
    return F.when(lonely, F.greatest(F.lit(1), needed)).otherwise(needed)


def _fits(needed: Column) -> Column:
    return (F.col("must_not") == 0) & (F.col("must") == F.col("n_must")) & (F.col("should") >= needed)


def _plain_clauses(clauses: DataFrame) -> bool:
    """Whether each clause is one unit of one field: a word, a class of words or a phrase."""
    words = F.when(F.col("kind") == "term", F.size("terms")).otherwise(F.lit(1))
    return clauses.groupBy("query_id", "clause_id").agg(F.sum(words).alias("units")).where("units > 1").isEmpty()


_ROLES = ("must", "should", "must_not")


def _search_plain(
    clauses: Requests, index: TextIndex, n: int | None, kinds: set[str], fuzzy_ks: list[int],
    minimum_should_match: str | int | None,
) -> DataFrame | None:
    """As ``search_clauses``, for clauses of one unit and documents named by unique ids.

    Equal units of all clauses meet the postings once, and what they find is dealt out by document.  Clauses join
    it there, so rows per clause and document are folded where they arise and never shuffled; None if a query only excludes.
    """
    counts = _clause_counts(clauses.rows)
    queries = settle(counts.withColumn("needed", _needed(minimum_should_match)).withColumn("_query", F.monotonically_increasing_id()))
    if not queries.small or not queries.rows.where("n_must = 0 and n_should = 0").isEmpty():
        return None
    asked = clauses.rows.join(F.broadcast(queries.rows.select("query_id", "_query")), "query_id")
    roles = [(F.col("occur") == role).cast("int").alias(role) for role in _ROLES]
    factor = F.when(F.col("occur") != "must_not", F.col("boost")).otherwise(F.lit(0.0)).alias("factor")
    asked = asked.select("_query", "field", "kind", "terms", "k", factor, *roles)
    role = ["_query", "factor", *_ROLES]

    if kinds <= {"prefix", "fuzzy"}:
        prefix = F.get("terms", F.lit(0)).alias("prefix")
        scored, wanted = _scored_classes(asked.select(*role, "field", "kind", "k", prefix), index, kinds, fuzzy_ks, False)
        hits = _folded(scored, wanted, queries, n)
        return _named(hits if n is None else index.few_parts(hits, queries.count), queries, n)

    parts = []
    if "term" in kinds:
        words = asked.where(F.col("kind") == "term").select(*role, "field", F.get("terms", F.lit(0)).alias("term"))
        weighted = settle(_weighted(clauses, index, words))
        if not weighted.small:
            return None
        parts.append(meet(weighted, index).select(*role, "_id", "score"))
    if kinds & {"prefix", "fuzzy"}:
        prefix = F.get("terms", F.lit(0)).alias("prefix")
        wanted = asked.where(F.col("kind").isin("prefix", "fuzzy")).select(*role, "field", "kind", "k", prefix)
        scored, wanted = _scored_classes(wanted, index, kinds, fuzzy_ks, True)
        parts.append(scored.join(F.broadcast(wanted), "_unit").select(*role, "_id", "score"))
    if "phrase" in kinds:
        phrases = asked.where(F.col("kind") == "phrase").select(*role, "field", "terms", "k")
        parts.append(_phrases_by_document(phrases, index).select(*role, "_id", "score"))
    units = parts[0] if len(parts) == 1 else index.by_document(reduce(DataFrame.unionByName, parts), None)
    per_doc = units.groupBy("_query", "_id").agg(
        F.sum(F.col("score") * F.col("factor")).alias("_score"), *[F.sum(r).alias(r) for r in _ROLES]
    )
    hits = per_doc.join(F.broadcast(queries.rows.drop("query_id", "n_should")), "_query").filter(_fits(F.col("needed")))
    hits = hits.select("_query", "_id", "_score")
    return _named(hits if n is None else index.few_parts(hits, queries.count), queries, n)


def _named(hits: DataFrame, queries: Requests, n: int | None) -> DataFrame:
    """The ``n`` best hits, with the ids of their queries."""
    if n is not None:
        hits = top_n_per_group(hits, ["_query"], [F.round("_score", 9).desc(), F.col("_id").asc()], n)
    named = hits.join(F.broadcast(queries.rows.select("_query", "query_id")), "_query")
    return named.select("query_id", "_id", "_score", *(["rank"] if n is not None else []))


def _scored_classes(
    wanted: DataFrame, index: TextIndex, kinds: set[str], fuzzy_ks: list[int], joined: bool
) -> tuple[DataFrame, DataFrame]:
    """The ``_unit``, ``_id`` and ``score`` of each class and document that holds a word of it, and ``wanted`` with its classes' units.

    Rows of a document are in one partition.  If they are to be ``joined`` with ``wanted``, there are more of these.
    """
    classes, wanted = numbered(wanted, _CLASS)
    times = wanted.groupBy("_unit").agg(F.count(F.lit(1)).alias("times"))
    named = classes.rows.join(F.broadcast(times), "_unit")
    covered = _covered_words(named, index, kinds, fuzzy_ks, True, ["_unit", "times"], index.term_stats.select(*index.keys, "df"))
    covered = settle(covered.select(*index.keys, "_unit", "times", "df"))
    pairs = covered.rows.agg(F.sum(F.col("df") * F.col("times") if joined else F.col("df"))).first()[0]
    columns = ["_unit", "_id", "tf", "dl"]
    if covered.small or "fuzzy" in kinds:
        found = index.postings_for(covered, columns=["_id", "tf", "dl"]).select(*columns)
    else:
        # The prefixes are few where the words under them are many.
        found = prefix_matches(classes.rows, index.postings.select("field", "term", "_id", "tf", "dl"), ["field"], True).select(*columns)
    held = index.by_document(found, pairs).groupBy("_unit", "_id").agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
    # Counted over the same columns as are scored, so both read one exchange.
    documents = F.count_if(F.col("tf").isNotNull() & F.col("dl").isNotNull()).alias("df")
    df = _with_sizes(held.groupBy("_unit").agg(documents).join(F.broadcast(classes.rows.select("_unit", "field")), "_unit"), index)
    weights = df.select("_unit", scoring.idf(F.col("n_docs"), F.col("df")).alias("weight"), "avgdl")
    return held.join(F.broadcast(weights), "_unit").select("_unit", "_id", _bm25().alias("score")), wanted


def _folded(scored: DataFrame, wanted: DataFrame, queries: Requests, n: int | None) -> DataFrame:
    """(_query, _id, _score) of the documents that fit, of each partition the ``n`` best of every query at least.

    ``scored`` has a row per unit and document, those of a document in one partition.  Their scores become a matrix
    of some documents at a time, whose rows are added up for each clause, so there is no row per query and document.
    The clauses were measured: they are sent to every task as arrays.
    """
    clauses = wanted.join(F.broadcast(queries.rows.select("_query", "n_must", "needed")), "_query")
    clauses = clauses.select("_query", "_unit", "factor", *_ROLES, "n_must", "needed").toArrow()
    columns = {name: clauses.column(name).to_numpy() for name in clauses.column_names}
    fold = _fold(columns, n, FOLD_NUMBERS, FOLD_ROWS, FOLD_CANDIDATES)
    # In the order of ids, so a later document never comes before an equal one.
    rows = scored.sortWithinPartitions("_id").select("_unit", "_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    id_type = scored.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(fold, f"_query long, _id {id_type}, _score double")


def _fold(
    clauses: dict[str, np.ndarray], n: int | None, numbers: int, rows: int, candidates: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes hits of batches of (_unit, _id, score) in the order of ids.

    The functions are local, so they are sent whole and executors need not have this package.
    """
    # Queries of many clauses come first, so those that have a j-th clause are the first so many.
    query, own, sizes = np.unique(clauses["_query"], return_inverse=True, return_counts=True)
    first = np.argsort(-sizes, kind="stable")
    place = np.empty(len(first), np.int64)
    place[first] = np.arange(len(first))
    by = np.lexsort((clauses["_unit"], place[own]))
    query, sizes = query[first], sizes[first]
    unit, unit_of = np.unique(clauses["_unit"], return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    unit_of, factor = unit_of[by], clauses["factor"][by].astype(np.float64)
    roles = {role: clauses[role][by].astype(np.int16) for role in ("must", "should", "must_not")}
    n_must, needed = (clauses[name][by][starts].astype(np.int64) for name in ("n_must", "needed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, numbers // max(1, len(unit)))
        floor = np.full(len(query), -np.inf)
        pool: list[tuple] = []
        held, rest = 0, None

        def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some: list[pa.RecordBatch] = []
            for batch in batches:
                if batch.num_rows:
                    some.append(batch)
                if sum(b.num_rows for b in some) >= rows:
                    yield pa.concat_batches(some)
                    some = []
            if some:
                yield pa.concat_batches(some)

        def of_documents(units: np.ndarray, docs: np.ndarray, scores: np.ndarray, n_docs: int) -> Iterator[tuple]:
            table, there = np.zeros((len(unit), n_docs)), np.zeros((len(unit), n_docs), bool)
            table[units, docs], there[units, docs] = scores, True
            step = max(1, numbers // n_docs)
            for low in range(0, len(query), step):
                high = min(low + step, len(query))
                total = np.zeros((high - low, n_docs))
                met = {role: np.zeros((high - low, n_docs), np.int16) for role, used in roles.items() if used.any()}
                for j in range(sizes[low] if high > low else 0):
                    more = int(np.searchsorted(-sizes[low:high], -j, side="left"))
                    at = starts[low:low + more] + j
                    total[:more] += table[unit_of[at]] * factor[at, None]
                    for role, count in met.items():
                        count[:more] += there[unit_of[at]] * roles[role][at, None]
                none = np.int16(0)
                fits = (met.get("must", none) == n_must[low:high, None]) & (met.get("should", none) >= needed[low:high, None])
                if "must_not" in met:
                    fits &= met["must_not"] == 0
                if n is not None:
                    fits &= np.round(total, 9) > floor[low:high, None]
                row, doc = np.nonzero(fits)
                yield row + low, doc, total[row, doc]

        def best() -> tuple:
            # The pool is in the order of ids, and the sort keeps it.
            row, ids, score = np.concatenate([p[0] for p in pool]), pa.concat_arrays([p[1] for p in pool]), np.concatenate([p[2] for p in pool])
            order = np.lexsort((-np.round(score, 9), row))
            row = row[order]
            begin = np.searchsorted(row, row)
            kept = order[np.arange(len(order)) - begin < n]
            last = np.flatnonzero(np.arange(len(order)) - begin == n - 1)
            floor[row[last]] = np.round(score[order[last]], 9)
            # Back in the order of arrival.
            kept = np.sort(kept)
            return np.concatenate([p[0] for p in pool])[kept], ids.take(pa.array(kept)), score[kept]

        def hits(row: np.ndarray, ids: pa.Array, score: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(query[row]), ids, pa.array(score)], ["_query", "_id", "_score"])

        def folded(units: np.ndarray, ids: pa.Array, scores: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole documents, some at a time."""
            nonlocal pool, held
            begins = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
            for low in range(0, len(begins), at_once):
                some = begins[low:low + at_once]
                end = begins[low + at_once] if low + at_once < len(begins) else len(codes)
                part = slice(some[0], end)
                docs = np.repeat(np.arange(len(some)), np.diff(np.append(some, end)))
                names = ids.take(pa.array(some))
                for row, doc, score in of_documents(units[part], docs, scores[part], len(some)):
                    if n is None:
                        if len(row):
                            yield hits(row, names.take(pa.array(doc)), score)
                        continue
                    pool.append((row, names.take(pa.array(doc)), score))
                    held += len(row)
                    if held > candidates + n * len(query):
                        pool = [best()]
                        held = len(pool[0][0])

        for batch in gathered(batches):
            units = np.searchsorted(unit, batch.column(0).to_numpy())
            ids, scores = batch.column(1), batch.column(2).to_numpy()
            if rest is not None:
                units, scores = np.concatenate([rest[0], units]), np.concatenate([rest[2], scores])
                ids = pa.concat_arrays([rest[1], ids])
            codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
            # The last document may go on in the next batch.
            last = int(np.flatnonzero(codes != codes[-1])[-1]) + 1 if codes[0] != codes[-1] else 0
            rest = units[last:], ids.slice(last), scores[last:]
            if last:
                yield from folded(units[:last], ids.slice(0, last), scores[:last], codes[:last])
        if rest is not None:
            yield from folded(*rest, np.zeros(len(rest[0]), np.int64))
        if pool:
            yield hits(*best())

    return run


def _phrases_by_document(wanted: DataFrame, index: TextIndex) -> DataFrame:
    """``wanted`` with the ``_id`` and ``score`` of each document that holds its phrase.

    The words in use are laid out by document and place.  An exact phrase is there where all its pairs of
    neighbours are; a sloppy one is looked for only where its two rarest words are near enough, so a document
    that just holds all words of a phrase costs nothing.
    """
    phrases, wanted = numbered(wanted, ["field", "terms", "k"])
    words = phrases.rows.select("_unit", "field", "k", F.size("terms").alias("m"), F.posexplode("terms").alias("j", "term"))
    weighted = settle(_weighted(phrases, index, words))
    # Phrases of which every word is known.
    whole = weighted.rows.groupBy("_unit").agg(
        F.sort_array(F.collect_list(F.struct("j", "field", "term", "df"))).alias("words"), F.max("m").alias("m"),
        F.max("k").alias("k"), F.sum("weight").alias("weight"), F.max("avgdl").alias("avgdl"),
    ).where(F.size("words") == F.col("m"))
    used, _ = numbered(whole.select("_unit", F.explode("words").alias("w")).select("_unit", "w.field", "w.term"), ["field", "term"])
    terms = settle(index.with_bucket(used.rows.withColumnRenamed("_unit", "_term")))
    fields = {name: i for i, name in enumerate(index.fields)}
    place = F.create_map(*[F.lit(x) for item in fields.items() for x in item])[F.col("field")].alias("_field")
    rows = index.postings_for(terms, columns=["_id", "dl", "positions"]).select("_term", place, "_id", "dl", "positions")
    tokens = index.field_stats.agg(F.sum("sum_dl")).first()[0]
    laid = index.by_document(rows, tokens)

    number = F.broadcast(terms.rows.select("field", "term", "_term"))
    spelled = whole.select("_unit", "k", "m", F.explode("words").alias("w")).select("_unit", "k", "m", "w.*").join(number, ["field", "term"])
    spelled = settle(spelled.select("_unit", "k", "m", "j", "df", "_term", "field", "term"))
    at = laid.select("_id", "_field", "dl", "_term", F.explode("positions").alias("at"))
    parts = []
    exact = spelled.rows.where("k = 0")
    if not exact.isEmpty():
        order = Window.partitionBy("_id", "_field").orderBy("at")
        follow = at.withColumns({"_next": F.lead("_term").over(order), "_at": F.lead("at").over(order)}).where("_at = at + 1")
        after = exact.select("_unit", (F.col("j") - 1).alias("j"), F.col("_term").alias("_next"))
        pairs = exact.select("_unit", "j", "m", "_term").join(F.broadcast(after), ["_unit", "j"])
        met = follow.join(F.broadcast(pairs), ["_term", "_next"]).select("_unit", "_id", "dl", "m", (F.col("at") - F.col("j")).alias("start"))
        starts = met.groupBy("_unit", "_id", "start").agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("m"), F.max("dl").alias("dl"))
        starts = starts.where("n = m - 1")
        parts.append(starts.groupBy("_unit", "_id").agg(F.max("dl").alias("dl"), F.count(F.lit(1)).cast("double").alias("freq")))
    sloppy = spelled.rows.where("k > 0")
    if not sloppy.isEmpty():
        parts.append(_sloppy_by_document(sloppy, terms, at, index))
    found = parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, parts) if parts else None
    if found is None:
        found = laid.select(F.lit(None).cast("long").alias("_unit"), "_id", "dl", F.lit(0.0).alias("freq")).limit(0)
    weights = whole.select("_unit", "weight", "avgdl")
    scored = found.join(F.broadcast(weights), "_unit").select("_unit", "_id", _bm25("freq").alias("score"))
    return scored.join(F.broadcast(wanted), "_unit")


def _sloppy_by_document(sloppy: DataFrame, terms: Requests, at: DataFrame, index: TextIndex) -> DataFrame:
    """Weights of sloppy phrases, found through places of their two rarest words that are near enough."""
    rare = sloppy.groupBy("_unit", "k").agg(F.slice(F.sort_array(F.collect_list(F.struct("df", "j", "_term"))), 1, 2).alias("two"))
    first, second = F.col("two")[0], F.col("two")[1]
    # Of the two words' places p and q, (q - j2) - (p - j1) is between -k and k: q is at most 2k behind p + j2 - j1 - k.
    gap = second["j"] - first["j"] - F.col("k")
    ends = F.array(
        F.struct(first["_term"].alias("_term"), F.lit(1).alias("end"), gap.alias("shift"), (gap + first["j"]).alias("base")),
        F.struct(second["_term"].alias("_term"), F.lit(2).alias("end"), F.lit(0).alias("shift"), F.lit(0).alias("base")),
    )
    wanted = rare.select("_unit", "k", F.explode(ends).alias("e")).select("_unit", "k", "e.*")
    met = at.join(F.broadcast(wanted), "_term").select("_unit", "_id", "_field", "k", "end", "base", (F.col("at") + F.col("shift")).alias("key"))
    # Read from the last place on, the latest second word is the next one.
    back = Window.partitionBy("_unit", "_id", "_field").orderBy(F.desc("key"), F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("_next", F.last(F.when(F.col("end") == 2, F.col("key")), True).over(back))
    near = met.where((F.col("end") == 1) & (F.col("_next") - F.col("key") <= 2 * F.col("k")))
    near = near.groupBy("_unit", "_id").agg(F.collect_set(F.col("key") - F.col("base")).alias("firsts"))
    asked = near.join(F.broadcast(sloppy.select("_unit", "k", "m", "j", "term", "_term")), "_unit")
    full = index.postings_for(terms, columns=["_id", "dl", "positions"]).select("_term", "_id", "dl", "positions")
    # Every window that counts spans at most the slop and holds one of the first words found, so no other place matters.
    offsets = F.transform("positions", lambda p: p - F.col("j"))
    offsets = F.filter(offsets, lambda o: F.exists("firsts", lambda f: F.abs(o - f) <= F.col("k")))
    together = (
        full.join(asked, ["_term", "_id"]).withColumn("place", F.struct("j", "term", offsets.alias("offsets")))
        .groupBy("_unit", "k", "m", "_id", "dl").agg(F.sort_array(F.collect_list("place")).alias("places"))
        .where(F.size("places") == F.col("m"))
    )
    freq = sloppy_frequency(F.col("places"), F.col("k"))
    return together.select("_unit", "_id", "dl", freq.alias("freq")).where("freq > 0")


def _clause_counts(clauses: DataFrame) -> DataFrame:
    """Number of required and optional clauses of each query."""
    distinct = clauses.select("query_id", "clause_id", "occur").distinct()
    return distinct.groupBy("query_id").agg(
        F.sum(F.when(F.col("occur") == "must", 1).otherwise(0)).alias("n_must"),
        F.sum(F.when(F.col("occur") == "should", 1).otherwise(0)).alias("n_should"),
    )


def _needed_column(spec: str | int | None, n_should: Column) -> Column:
    """``minimum_should_match`` where the number of optional clauses is a column."""
    if spec is None or str(spec).strip() == "":
        return F.lit(0)
    text = str(spec).strip().replace(" <", "<").replace("< ", "<")
    if "<" in text:
        needed, settled = n_should, []
        for condition in text.split():
            bound, _, rest = condition.partition("<")
            settled.append((n_should <= int(bound), needed))
            needed = _needed_column(rest, n_should)
        result = needed
        for test, value in reversed(settled):
            result = F.when(test, value).otherwise(result)
        return result
    if text.endswith("%"):
        value = (n_should * F.lit(int(text[:-1])) / F.lit(100.0)).cast("int")
        negative = text.startswith("-")
    else:
        value, negative = F.lit(int(text)), text.startswith("-")
    if negative:
        value = n_should + value
    return F.greatest(F.lit(0), F.least(n_should, value)).cast("int")


_UNIT = [*_CLAUSE, "occur", "boost", "n_units", "_id", "score"]
_CLASS = ["field", "kind", "k", "prefix"]


def _word_units(clauses: Requests, index: TextIndex, kinds: set[str], fuzzy_ks: list[int]) -> DataFrame:
    """One row per clause, document and unit: a plain word, or all words a prefix or near word stands for."""
    parts = []
    if "term" in kinds:
        plain = clauses.rows.filter(F.col("kind") == "term").select(
            *_CLAUSE, "occur", "boost", F.size("terms").alias("n_units"), F.explode("terms").alias("term")
        )
        words = settle(_weighted(clauses, index, plain))
        pairs = index.postings_for(words, columns=["_id", "tf", "dl"])
        score = scoring.bm25(F.col("weight"), F.col("tf"), F.col("dl"), F.col("avgdl"))
        parts.append(pairs.withColumn("score", score).select(*_UNIT))
    if kinds & {"prefix", "fuzzy"}:
        parts.append(_class_units(clauses, index, kinds, fuzzy_ks))
    return reduce(DataFrame.unionByName, parts)


def _class_units(clauses: Requests, index: TextIndex, kinds: set[str], fuzzy_ks: list[int]) -> DataFrame:
    """Prefixes and near words, each scored like one term.

    Equal ones of all queries are one class, which meets the postings once: term
    counts are summed per class and document, and the number of those rows is the
    class's document count.
    """
    wanted = clauses.rows.filter(F.col("kind").isin("prefix", "fuzzy")).select(
        *_CLAUSE, "occur", "boost", "kind", "k", F.lit(1).alias("n_units"), F.get("terms", F.lit(0)).alias("prefix")
    )
    covered = _covered_words(wanted.select(*_CLASS).distinct(), index, kinds, fuzzy_ks, clauses.small)
    pairs = index.postings_for(settle(index.with_bucket(covered)), columns=["_id", "tf", "dl"])
    held = pairs.groupBy(*_CLASS, "_id").agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
    df = _with_sizes(held.groupBy(*_CLASS).agg(F.count(F.lit(1)).alias("df")), index)
    weights = df.select(*_CLASS, scoring.idf(F.col("n_docs"), F.col("df")).alias("weight"), "avgdl")
    scored = held.join(clauses.hinted(weights), _CLASS)
    score = scoring.bm25(F.col("weight"), F.col("tf"), F.col("dl"), F.col("avgdl"))
    scored = scored.select(*_CLASS, "_id", score.alias("score"))
    return scored.join(clauses.hinted(wanted), _CLASS).select(*_UNIT)


def _covered_words(
    classes: DataFrame, index: TextIndex, kinds: set[str], fuzzy_ks: list[int], small: bool,
    more: list[str] = (), vocabulary: DataFrame | None = None,
) -> DataFrame:
    """Words of the vocabulary that each class stands for, with ``more`` columns of the classes."""
    vocabulary = index.term_stats.select("field", "term") if vocabulary is None else vocabulary
    kept = [*_CLASS, *more, *[c for c in vocabulary.columns if c != "field"]]
    parts = []
    if "prefix" in kinds:
        stems = classes.filter(F.col("kind") == "prefix")
        parts.append(prefix_matches(stems, vocabulary, ["field"], small).select(*kept))
    if "fuzzy" in kinds:
        near = classes.filter(F.col("kind") == "fuzzy").withColumnRenamed("prefix", "word")
        found = fuzzy_matches(near, vocabulary, ["field"], fuzzy_ks, small).withColumnRenamed("word", "prefix")
        parts.append(found.select(*kept))
    return reduce(DataFrame.unionByName, parts)


def _phrase_units(clauses: Requests, index: TextIndex) -> DataFrame:
    """Phrases: the positions of the words, brought together per document."""
    words = clauses.rows.filter(F.col("kind") == "phrase").select(
        *_CLAUSE, "occur", "boost", "k", F.size("terms").alias("m"), F.posexplode("terms").alias("j", "term")
    )
    weighted = settle(_weighted(clauses, index, words))
    # First the documents that hold every word, without positions; then the positions of only those.
    held = index.postings_for(weighted, columns=["_id"])
    whole = held.groupBy(*_CLAUSE, "_id").agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("m")).filter("n = m")
    pairs = index.postings_for(weighted, columns=["_id", "dl", "positions"])
    pairs = pairs.join(whole.select(*_CLAUSE, "_id"), [*_CLAUSE, "_id"], "left_semi")
    offsets = F.transform("positions", lambda p: p - F.col("j"))
    # A group holds the words of one phrase in one document, so it is bounded by both.
    together = (
        pairs.withColumn("place", F.struct("j", "term", offsets.alias("offsets")))
        .groupBy(*_CLAUSE, "occur", "boost", "k", "m", "_id", "dl", "avgdl")
        .agg(F.sort_array(F.collect_list("place")).alias("places"), F.sum("weight").alias("weight"))
        .filter(F.size("places") == F.col("m"))
    )
    freq = F.when(F.col("k") == 0, exact_frequency(F.col("places")).cast("double")).otherwise(
        sloppy_frequency(F.col("places"), F.col("k"))
    )
    found = together.withColumn("freq", freq).filter(F.col("freq") > 0)
    score = scoring.bm25(F.col("weight"), F.col("freq"), F.col("dl"), F.col("avgdl"))
    return found.select(
        *_CLAUSE, "occur", "boost", F.lit(1).alias("n_units"), "_id", score.alias("score"),
    )


def _all_units(clauses: Requests, only_not: DataFrame, index: TextIndex) -> DataFrame:
    """``*``, and the base of queries that only exclude: every indexed document."""
    # ``*`` names no field, so it counts once, with the largest boost of the fields searched.
    wildcard = clauses.rows.filter(F.col("kind") == "all").groupBy("query_id", "clause_id", "occur").agg(F.max("boost").alias("boost"))
    excluding = only_not.select(
        "query_id", F.lit(-1).alias("clause_id"), F.lit("should").alias("occur"), F.lit(0.0).alias("boost")
    )
    # Each document meets each such query: the result itself has that many rows.
    # The documents stay where they are and the queries come as one array, whose
    # size was checked, or, if there are too many, as salted rows.
    wanted = wildcard.unionByName(excluding)
    ids = index.documents
    if clauses.small:
        listed = wanted.agg(F.collect_list(F.struct("query_id", "clause_id", "occur", "boost")).alias("w")).scalar()
        pairs = ids.withColumn("w", F.explode(listed)).select("_id", "w.*")
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        spread = F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int")
        pairs = ids.withColumn("_salt", spread).join(wanted.withColumn("_salt", salt), "_salt").drop("_salt")
    return pairs.select(
        "query_id", "clause_id", F.lit("*").alias("field"), "occur", "boost", F.lit(1).alias("n_units"), "_id",
        F.lit(1.0).alias("score"),
    )


def search_strings(strings: DataFrame, index: TextIndex, spec: QueryStrings, n: int | None = 10) -> DataFrame:
    """The ``n`` best documents of each flat query string ``(query_id, query)``."""
    clauses = clause_rows(strings, spec)
    return search_clauses(
        clauses,
        index,
        n,
        spec.default_operator,
        spec.minimum_should_match,
        "max" if spec.syntax == "full" else "sum",
    )
