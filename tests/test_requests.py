"""A table of requests: each row's hits, total and facet are those of the same request made alone."""

import pytest

from docquarry.operators import queries as q
from docquarry.operators.aggregations import TermsFacet
from docquarry.plans.index import prepare
from docquarry.plans.requests import search_requests
from docquarry.plans.search import Collection, SearchRequest, search

SCHEMA = "query_id long, query string, boosts map<string,double>, operator string, filters map<string,string>, facet string"
REQUESTS = [
    (1, "red wine", None, None, None, "year"),
    (2, "red wine", {"title": 3.0, "text": 1.0}, "and", {"lang": "en"}, "lang"),
    (3, "red RED apple", {"title": 0.5}, "or", {"lang": "en", "year": "2001"}, None),
    (4, None, None, None, None, "lang"),
    (5, "nowhere", None, None, None, "lang"),
    (6, "apple", {"other": 1.0}, None, None, None),
    (7, "apple", {}, None, {}, "year"),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    words = ["red wine", "red apple", "wine", "green apple and red wine", None, "apple apple red", ""]
    rows = [(i, words[i % 7], words[(i * 3 + 1) % 7], ["en", "fr", None][i % 3], 2000 + i % 4) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, title string, text string, lang string, year int")
    return prepare(Collection(table, "doc_id", {"title": "standard", "text": "standard"}), str(tmp_path_factory.mktemp("requests")))


def alone(docs, query, boosts, operator, filters, facet):
    names = [f for f in (boosts if boosts is not None else docs.text_fields) if f in docs.text_fields]
    if query is None or not names:
        return [], 0, []
    best = [q.Match(f, query, operator=operator or "or", boost=(boosts or {}).get(f, 1.0)) for f in names]
    wanted = [q.Term(f, int(v) if f == "year" else v) for f, v in (filters or {}).items()]
    request = SearchRequest(
        q.Bool.of(must=[q.DisMax(best)], filter=wanted), rows=5, least_postings=10**9, aggregations=[TermsFacet("f", facet, size=2)] if facet else []
    )
    result = search(docs, request)
    hits = [(r["doc_id"], round(r["_score"], 6)) for r in result.hits.collect()]
    facets = [(str(r["term"]), r["doc_count"]) for r in result.aggregations["f"].collect()] if facet else []
    return hits, result.total.first()[0], sorted(facets, key=lambda f: (-f[1], f[0]))


def test_same_as_requests_made_alone(spark, docs):
    found = search_requests(spark.createDataFrame(REQUESTS, SCHEMA), docs, ["lang", "year"], ["lang", "year"], 5, 2)
    hits, totals, facets = found.hits.collect(), dict(map(tuple, found.totals.collect())), found.facets.collect()
    assert set(totals) == {r[0] for r in REQUESTS}
    for name, *request in REQUESTS:
        expected = alone(docs, *request)
        got = [(r["_id"], round(r["_score"], 6)) for r in sorted(hits, key=lambda r: r["rank"]) if r["query_id"] == name]
        counts = [(r["key"], r["count"]) for r in sorted(facets, key=lambda r: r["rank"]) if r["query_id"] == name]
        assert (got, totals[name], counts) == expected, name


def test_columns_left_out_and_unknown_fields(spark, docs):
    plain = spark.createDataFrame([("a", "wine")], "query_id string, query string")
    found = search_requests(plain, docs)
    assert found.hits.count() == 10 and found.facets.count() == 0 and found.totals.first()["total"] > 10
    assert search_requests(plain.limit(0), docs).totals.count() == 0
    for row in ((1, "wine", None, None, {"size": "1"}, None), (1, "wine", None, None, None, "size")):
        with pytest.raises(Exception, match="no such field"):
            search_requests(spark.createDataFrame([row], SCHEMA), docs, ["lang"], ["lang"]).hits.collect()
