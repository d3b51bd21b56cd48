"""Sorting, paging, totals and export."""

from pyspark.sql import functions as F

from ..functions.fields import project_fields
from ..operators import queries as q
from ..operators.paging import Sort, keyset_page, sort_preset, total_hits
from ..plans.search import Collection, SearchRequest, search
from .base import documents, query, table


@query(
    "sort_nulls_last",
    """SELECT doc_id, quality, n_chars FROM documents LEFT JOIN labels USING (doc_id)
       WHERE n_chars < 2000 ORDER BY quality DESC NULLS LAST, n_chars, doc_id LIMIT 25 OFFSET 150""",
)
def sort_nulls_last(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    request = SearchRequest(
        q.Range("n_chars", lt=2000),
        start=150,
        rows=25,
        fields=["quality", "n_chars"],
        sort=[Sort("quality", True), Sort("n_chars")],
    )
    return search(Collection(docs, "doc_id"), request).hits.drop("_score")


@query("total_hits", "SELECT count(*) AS value, 'EQUAL_TO' AS relation FROM lineitem WHERE l_discount = 0.05")
def total_hits_exact(spark, folder):
    return search(_lineitem(spark, folder), SearchRequest(q.Term("l_discount", 0.05))).total


@query(
    "total_hits_capped",
    """SELECT least(count(*), 1000) AS value,
              CASE WHEN count(*) > 1000 THEN 'GREATER_THAN_OR_EQUAL_TO' ELSE 'EQUAL_TO' END AS relation
       FROM lineitem WHERE l_discount = 0.05""",
)
def total_hits_capped(spark, folder):
    request = SearchRequest(q.Term("l_discount", 0.05), track_total_hits_up_to=1000)
    return search(_lineitem(spark, folder), request).total


def _lineitem(spark, folder):
    return Collection(table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "keyset_page",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice < 250000.5 OR (o_totalprice = 250000.5 AND o_orderkey > 100)
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 500""",
)
def keyset(spark, folder):
    sort = [Sort("o_totalprice", True), Sort("o_orderkey")]
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return keyset_page(orders, sort, [250000.5, 100], 500)


@query(
    "keyset_request",
    """SELECT doc_id, source FROM documents WHERE lang = 'en' AND (source > 'src3' OR (source = 'src3' AND doc_id > 50))
       ORDER BY source, doc_id LIMIT 40""",
)
def keyset_request(spark, folder):
    request = SearchRequest(
        q.Term("lang", "en"), rows=40, fields=["source"], sort=[Sort("source"), Sort("_shard_doc")],
        search_after=["src3", 50],
    )
    return search(documents(spark, folder), request).hits.drop("_score")


@query("export_all", "SELECT * FROM lineitem")
def export_all(spark, folder):
    return search(_lineitem(spark, folder), SearchRequest(q.MatchAll(), export=True)).hits.drop("_score")


@query("export_limit", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 777")
def export_limit(spark, folder):
    collection = Collection(table(spark, folder, "events"), "event_id")
    request = SearchRequest(q.MatchAll(), fields=["value"], export=True, limit=777, sort=[Sort("_doc")])
    return search(collection, request).hits.drop("_score")


@query(
    "sort_preset",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'
       ORDER BY o_orderdate DESC, o_orderkey LIMIT 30""",
)
def presets(spark, folder):
    request = SearchRequest(
        q.Term("o_orderstatus", "F"), rows=30, fields=["o_orderdate"], sort=sort_preset("date", "o_orderdate")
    )
    return search(Collection(table(spark, folder, "orders"), "o_orderkey"), request).hits.drop("_score")


@query(
    "sort_preset_date_relevance",
    """SELECT o_orderkey, o_orderdate, round(o_totalprice, 2) AS score FROM orders
       ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey LIMIT 30""",
)
def preset_with_relevance(spark, folder):
    request = SearchRequest(
        q.FunctionScore(q.MatchAll(), q.FieldValueFactor("o_totalprice"), boost_mode="replace"),
        rows=30,
        fields=["o_orderdate"],
        sort=sort_preset("date_and_relevance", "o_orderdate"),
    )
    hits = search(Collection(table(spark, folder, "orders"), "o_orderkey"), request).hits
    return hits.select("o_orderkey", "o_orderdate", F.round("_score", 2).alias("score"))


@query(
    "field_patterns",
    """SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders WHERE o_custkey = 7""",
)
def field_patterns(spark, folder):
    request = SearchRequest(q.Term("o_custkey", 7), fields=["o_order*"], export=True)
    return search(Collection(table(spark, folder, "orders"), "o_orderkey"), request).hits.drop("_score")


@query(
    "fields_excluded",
    "SELECT p_partkey, p_name, p_size FROM part WHERE p_size = 7",
)
def fields_excluded(spark, folder):
    found = search(
        Collection(table(spark, folder, "part"), "p_partkey"), SearchRequest(q.Term("p_size", 7), export=True)
    ).hits
    return project_fields(found.drop("_score"), ["p_*"], ["p_partkey"], exclude=["p_brand", "p_t*", "*price"])


@query(
    "whole_source",
    "SELECT p_partkey, p_name AS name, p_retailprice AS price FROM part WHERE p_brand = 'Brand#3'",
)
def whole_source(spark, folder):
    request = SearchRequest(q.Term("p_brand", "Brand#3"), fields=[], fetch_source=True, export=True)
    hits = search(Collection(table(spark, folder, "part"), "p_partkey"), request).hits
    return hits.select("p_partkey", F.col("_source.p_name").alias("name"), F.col("_source.p_retailprice").alias("price"))


@query("no_rows", "SELECT count(*) AS value, 'EQUAL_TO' AS relation FROM events WHERE event_type = 'view'")
def no_rows(spark, folder):
    """A negative page size gives no hits, but the total is still counted."""
    collection = Collection(table(spark, folder, "events"), "event_id")
    result = search(collection, SearchRequest(q.Term("event_type", "view"), rows=-1))
    return total_hits(result.matched.unionByName(result.hits.select(*result.hits.columns), allowMissingColumns=True))
