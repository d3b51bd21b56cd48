import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from docquarry.operators import queries as q
from docquarry.operators.aggregations import (
    MaxOf,
    Order,
    SignificantTerms,
    TermsFacet,
    TopHits,
    aggregate,
)
from docquarry.operators.compile import scored
from docquarry.operators.paging import Sort, keyset_page, resolve_sort, sort_preset
from docquarry.operators.topn import top_n_per_group
from docquarry.plans.search import Collection, SearchRequest, search

N = 3000


@pytest.fixture(scope="module")
def corpus(spark):
    order = list(range(N))
    random.Random(5).shuffle(order)
    rows = [(str(i), f"This is an example text for document {i}", i, f"PMC{order[i]}_1.0_0.1") for i in range(N)]
    return spark.createDataFrame(rows, "_id string, text string, docnum long, sortid string").repartition(4).cache()


def walk(docs, sort, columns, page):
    last, seen = None, []
    while True:
        rows = keyset_page(docs, sort, last, page).collect()
        if not rows:
            return seen
        seen += rows
        last = [rows[-1][c] for c in columns]


@pytest.mark.parametrize("field", ["_shard_doc", "sortid"])
def test_keyset_pages_make_the_full_export(corpus, field):
    sort = resolve_sort(corpus, [Sort(field)], "_id")
    seen = walk(corpus, sort, [s.field for s in sort], 700)
    assert len(seen) == N
    assert {r["_id"] for r in seen} == {str(i) for i in range(N)}
    key = "_id" if field == "_shard_doc" else field
    assert [r[key] for r in seen] == sorted(r[key] for r in seen)


def test_full_export(corpus):
    result = search(Collection(corpus), SearchRequest(q.MatchAll(), export=True))
    assert result.hits.count() == N
    assert result.total.first()["value"] == N


def test_keyset_with_missing_values_and_both_directions(spark):
    rows = [(i, i % 3 if i % 4 else None, (i * 7) % 5 if i % 5 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "id int, a int, b int")
    for descending in (True, False):
        sort = [Sort("a", descending), Sort("b", not descending), Sort("id")]
        seen = [r["id"] for r in walk(docs, sort, ["a", "b", "id"], 7)]

        def rank(value, down):
            return (value is None, 0 if value is None else -value if down else value)

        expected = sorted(rows, key=lambda r: (rank(r[1], descending), rank(r[2], not descending), r[0]))
        assert seen == [r[0] for r in expected]


def test_total_ceiling(corpus):
    def total(limit):
        return search(Collection(corpus), SearchRequest(q.MatchAll(), track_total_hits_up_to=limit)).total.first()

    assert total(100) == Row(value=100, relation="GREATER_THAN_OR_EQUAL_TO")
    assert total(N) == Row(value=N, relation="EQUAL_TO")


def test_negative_rows_still_aggregate(corpus):
    result = search(Collection(corpus), SearchRequest(q.MatchAll(), rows=-1, aggregations=[MaxOf("m", "docnum")]))
    assert result.hits.count() == 0
    assert result.aggregations["m"].first()["max"] == N - 1


def test_fields(three):
    def columns(**options):
        return search(Collection(three), SearchRequest(q.MatchAll(), **options)).hits.columns

    assert columns() == ["_id", "_score", "text", "topics", "version", "published"]
    assert columns(fields=[]) == ["_id", "_score"]
    assert columns(fields=["t*", "nothing"]) == ["_id", "_score", "text", "topics"]
    assert columns(fields=[], fetch_source=True) == ["_id", "_score", "_source"]


def test_presets():
    assert sort_preset("date_and_relevance", "d") == [Sort("d", True), Sort("_score", True)]
    with pytest.raises(ValueError):
        sort_preset("other", "d")


def test_default_order_is_by_score(three):
    wanted = q.Bool.of(must=[q.MatchAll()], should=[q.Term("version", 2, boost=5.0)])
    hits = search(Collection(three), SearchRequest(wanted)).hits.collect()
    assert [r["_id"] for r in hits] == ["43", "42", "44"]


def test_export_in_storage_order_does_not_shuffle(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("_id"))
    hits = search(Collection(rows), SearchRequest(q.MatchAll(), export=True)).hits
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()


# -- facets ----------------------------------------------------------------------------

def facets(docs, *requests):
    matched = scored(docs, q.MatchAll())
    return aggregate(matched, list(requests), docs, "_id")


def test_multivalued_facet_counts_documents(spark):
    docs = spark.createDataFrame(
        [("1", ["a", "a", "b"]), ("2", ["b", None]), ("3", []), ("4", None)], "_id string, t array<string>"
    )
    found = facets(docs, TermsFacet("t", "t"))["t"].collect()
    assert found == [Row(term="b", doc_count=2), Row(term="a", doc_count=1)]


def test_facet_keeps_type_and_default_size(spark):
    docs = spark.range(100).select(F.col("id").cast("string").alias("_id"), (F.col("id") % 20).alias("n"))
    found = facets(docs, TermsFacet("n", "n"))["n"]
    assert found.schema["term"].dataType.typeName() == "long"
    assert found.count() == 10


def test_unknown_facet_field_is_empty(three):
    assert facets(three, TermsFacet("x", "nothing"))["x"].count() == 0
    assert facets(three, MaxOf("x", "nothing"))["x"].first()["max"] is None


def test_sub_aggregations(three):
    tree = TermsFacet(
        "v", "version", order=[Order("best")], sub=[None, MaxOf("best", script="length(text)"), TopHits("top", size=1)]
    )
    found = facets(three, tree)
    assert [r["term"] for r in found["v"].collect()] == [1, 2]
    assert sorted((r["parent_1"], r["max"]) for r in found["v.best"].collect()) == [(1, 58), (2, 11)]
    assert sorted((r["parent_1"], r["_id"], r["total"]) for r in found["v.top"].collect()) == [(1, "42", 2), (2, "43", 1)]


def test_orders_are_checked(three):
    for order in (Order("nothing"), Order("top")):
        with pytest.raises(ValueError):
            facets(three, TermsFacet("v", "version", order=[order], sub=[TopHits("top")]))


def test_significant_terms_need_three_documents(spark):
    rows = [(str(i), "x" if i < 10 else "y", "rare" if i < 2 else "typical" if i < 9 else "common") for i in range(60)]
    docs = spark.createDataFrame(rows, "_id string, g string, w string")
    matched = scored(docs, q.Term("g", "x"))
    found = aggregate(matched, [SignificantTerms("s", "w")], docs, "_id")["s"].collect()
    assert [(r["term"], r["doc_count"], r["bg_count"]) for r in found] == [("typical", 7, 7)]
    fg, bg = 7 / 10, 7 / 60
    assert found[0]["score"] == pytest.approx((fg - bg) * (fg / bg))


def test_large_group_limit_is_exact(spark):
    docs = spark.range(9000).select("id", F.lit(1).alias("k"))
    found = top_n_per_group(docs, ["k"], [F.col("id").desc()], 2500)
    assert found.agg(F.count("*"), F.min("id")).first() == Row(**{"count(1)": 2500, "min(id)": 6500})
