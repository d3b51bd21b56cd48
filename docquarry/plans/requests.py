"""Whole search requests as rows: text, fields with boosts, filters and a facet of each request's own.

All requests of a table are answered together; what differs from row to row is data, not plan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import analysis
from ..operators.joins import settle
from ..operators.topn import top_n_per_group
from ..session import shared_folder
from .batch import _weighted, meet
from .search import Collection


@dataclass
class RequestResults:
    """``hits`` (query_id, rank, _id, _score), ``totals`` (query_id, total) and ``facets``
    (query_id, facet, rank, key, count).  They share ``matched``, written once."""

    hits: DataFrame
    totals: DataFrame
    facets: DataFrame
    matched: DataFrame


def search_requests(
    requests: DataFrame, collection: Collection, filter_fields: list[str] = (), facet_fields: list[str] = (),
    rows: int = 10, buckets: int = 10,
) -> RequestResults:
    """Answer rows of

    ``query_id``  the name of the request, once in the table
    ``query``     its text
    ``boosts``    map of text field to boost: the fields to search; the best field's score counts.
                  Without the column or with NULL: all fields of the collection, unboosted
    ``operator``  ``and`` if one field has to hold all words; else, or without the column, one word will do
    ``filters``   map of field to the text form of the value it has to have, no influence on the score
    ``facet``     the field of which the ``buckets`` most frequent values among all hits are counted

    ``filter_fields`` and ``facet_fields`` name the plain columns that filters and facets may use; a
    filter or facet of another field raises an error when the rows are read.  A document without a
    value passes no filter of that field and is in no bucket.  A request without text, words or
    known fields has no hits, and a total of 0.  Columns left out mean NULL in every row.  Fewer than
    one of ``rows`` or ``buckets`` gives none.
    """
    index = collection.index
    if index is None:
        raise ValueError("requests are answered from postings: prepare the collection first")

    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in requests.columns else F.lit(None).cast(kind)

    asked = requests.select(
        "query_id", F.col("query").cast("string").alias("query"), given("boosts", "map<string,double>").alias("boosts"),
        F.coalesce(F.lower(given("operator", "string")) == "and", F.lit(False)).alias("every"),
        _checked(given("filters", "map<string,string>"), filter_fields).alias("filters"),
        _known(given("facet", "string"), facet_fields).alias("facet"),
    )
    asked = settle(asked)

    # One row per request, field and distinct word.
    fields = [
        F.struct(
            F.lit(name).alias("field"), F.when(F.col("boosts").isNull(), 1.0).otherwise(F.col("boosts")[name]).alias("boost"),
            analysis.tokens(F.col("query"), analyzer).alias("terms"),
        )
        for name, analyzer in collection.text_fields.items()
    ]
    searched = asked.rows.select("query_id", "every", F.explode(F.array(*fields)).alias("f")).where("f.boost is not null")
    words = searched.select("query_id", "every", "f.field", "f.boost", F.explode("f.terms").alias("term"))
    words = words.groupBy("query_id", "every", "field", "boost", "term").agg(F.count(F.lit(1)).alias("times"))
    needed = words.groupBy("query_id", "field").agg(F.count(F.lit(1)).alias("n_terms"))
    weighted = settle(_weighted(settle(words.join(needed, ["query_id", "field"])), index))

    pairs = meet(weighted, index)
    score = F.col("score") * F.col("times") * F.col("boost")
    per_field = pairs.groupBy("query_id", "_id", "field").agg(
        F.sum(score).alias("s"), F.count(F.lit(1)).alias("found"), F.max(F.when(F.col("every"), F.col("n_terms")).otherwise(1)).alias("least")
    )
    found = per_field.where("found >= least").groupBy("query_id", "_id").agg(F.max("s").alias("_score"))

    matched = found.join(asked.hinted().select("query_id", "filters", "facet"), "query_id")
    plain = list(dict.fromkeys([*filter_fields, *facet_fields]))
    if plain:
        values = F.struct(*[F.col(f"`{name}`").cast("string").alias(name) for name in plain]).alias("_values")
        # Hits stay in their documents' partitions and unsorted; the few values of these documents go there.
        matched = matched.join(collection.docs.select(F.col(collection.id_col).alias("_id"), values).hint("shuffle_hash"), "_id")
    for name in filter_fields:
        wanted = F.col("filters")[name]
        passes = F.col("filters").isNull() | ~F.map_contains_key("filters", name) | (F.col("_values")[name] == wanted)
        matched = matched.where(F.coalesce(passes, F.lit(False)))
    key = F.coalesce(*[F.when(F.col("facet") == name, F.col("_values")[name]) for name in facet_fields], F.lit(None).cast("string"))
    # Hits are what rankings, totals and facets are all made of, so they are computed once, and kept by column.
    matched = matched.select("query_id", "_id", "_score", "facet", key.alias("key"))
    spark = matched.sparkSession
    path = f"{shared_folder(spark)}/matched-{uuid.uuid4().hex}"
    matched.write.parquet(path)
    matched = spark.read.schema(matched.schema).parquet(path)

    # Equal documents add the same terms in any order; rounding keeps their tie.
    hits = top_n_per_group(matched.select("query_id", "_id", "_score"), ["query_id"], [F.round("_score", 9).desc(), F.col("_id").asc()], rows)
    counted = matched.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    totals = asked.rows.select("query_id").join(counted, "query_id", "left").na.fill(0, ["total"])
    counts = matched.where("key is not null").groupBy("query_id", "facet", "key").agg(F.count(F.lit(1)).alias("count"))
    facets = top_n_per_group(counts, ["query_id"], [F.desc("count"), F.asc("key")], buckets)
    return RequestResults(hits, totals, facets, matched)


def _known(name: Column, fields: list[str]) -> Column:
    """The name of a field, or an error if it is not among these."""
    message = F.concat(F.lit("no such field for facets: "), name)
    return F.when(name.isNull() | name.isin(*fields), name).otherwise(F.raise_error(message)) if fields else F.when(name.isNull(), name).otherwise(F.raise_error(message))


def _checked(filters: Column, fields: list[str]) -> Column:
    """The filters, or an error if one is on a field that is not among these."""
    others = F.array_except(F.map_keys(filters), F.array(*[F.lit(f) for f in fields]).cast("array<string>"))
    message = F.concat(F.lit("no such field for filters: "), F.array_join(others, ", "))
    return F.when(filters.isNull() | (F.size(others) == 0), filters).otherwise(F.raise_error(message))
