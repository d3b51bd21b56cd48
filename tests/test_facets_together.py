"""Facets counted in one pass: the same as one by one, from one scan."""

import pytest
from pyspark.sql import functions as F

from docquarry.operators import queries as q
from docquarry.operators.aggregations import MaxOf, Order, StatsOf, TermsFacet, TopHits
from docquarry.operators.facets_together import can_be_together, count_buckets
from docquarry.plans.search import Collection, SearchRequest, search

ROWS = [
    (1, "a", ["x", "y", "x", None], 1.5, True, "Red fox"), (2, "a", ["y"], None, False, "red"), (3, "b", [], 7.25, None, "fox fox"),
    (4, None, None, 0.1, True, None), (5, "b", ["z", "x"], -3.0, True, "Blue"), (6, "c.d", ["x"], 2.0, False, ""),
]
SCHEMA = "id long, kind string, tags array<string>, price double, sold boolean, body string"


@pytest.fixture(scope="module")
def collection(spark):
    return Collection(spark.createDataFrame(ROWS, SCHEMA), "id", {"body": "standard"})


TREES = [
    [TermsFacet("kinds", "kind"), TermsFacet("tags", "tags", size=2), TermsFacet("words", "body", order=[Order("term", False)])],
    [TermsFacet("sold", "sold", sub=[TermsFacet("tags", "tags", size=1, order=[Order("count", False)], sub=[MaxOf("m", "price"), TermsFacet("k", "kind")])])],
    [TermsFacet("prices", "price", order=[Order("term")], size=3), MaxOf("most", "price"), MaxOf("twice", script="price * 2"), StatsOf("all", "price")],
    [TermsFacet("kinds", "kind", order=[Order("s", False, "min")], sub=[StatsOf("s", "price"), None]), TermsFacet("none", "nosuchfield")],
    [TermsFacet("tags", "tags", include="[xy]", exclude={"y"}), TermsFacet("more", "tags", exclude=["x", "nowhere"]), TermsFacet("kinds", "kind", include=[])],
]


def told(found):
    return {name: (df.columns, [tuple(r) for r in df.collect()]) for name, df in found.items()}


@pytest.mark.parametrize("number", range(len(TREES)))
@pytest.mark.parametrize("wanted", [q.MatchAll(), q.Range("id", gt=1), q.Range("id", gt=99)])
def test_same_as_one_by_one(collection, number, wanted):
    def run(together):
        return told(search(collection, SearchRequest(wanted, aggregations=TREES[number], facets_together=together)).aggregations)

    ours, theirs = run(True), run(False)
    assert {n: (sorted(c), sorted(map(repr, (dict(zip(c, r)).items() for r in rows)))) for n, (c, rows) in ours.items()}.keys() == theirs.keys()
    for name, (columns, rows) in theirs.items():
        got_columns, got = ours[name]
        assert sorted(got_columns) == sorted(columns), name
        as_dicts = lambda cs, rs: sorted((sorted(zip(cs, r)) for r in rs), key=repr)
        assert as_dicts(got_columns, got) == as_dicts(columns, rows), name


def test_one_scan_and_one_shuffle_for_three_facets(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("value > 1")
    trees = [TermsFacet("types", "event_type", sub=[MaxOf("m", "value")]), TermsFacet("users", "user_id"), TermsFacet("days", "ts")]
    plan = count_buckets(events, trees)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_trees_with_documents_stay_apart(collection):
    trees = [TermsFacet("kinds", "kind", sub=[TopHits("best")]), TermsFacet("tags", "tags")]
    assert [can_be_together(t) for t in trees] == [False, True]
    found = search(collection, SearchRequest(q.MatchAll(), aggregations=trees, facets_together=True)).aggregations
    assert set(found) == {"kinds", "kinds.best", "tags"}
    with pytest.raises(ValueError):
        bad = TermsFacet("kinds", "kind", order=[Order("nobody")])
        search(collection, SearchRequest(q.MatchAll(), aggregations=[bad], facets_together=True))


def test_keys_keep_their_type(spark):
    rows = spark.range(20).select("id", (F.col("id") / 7).alias("d"), (F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz")).alias("t"),
                                  F.col("id").cast("decimal(30,10)").alias("e"), (F.col("id") % 2 == 0).alias("b"))
    for name in ("d", "t", "e", "b", "id"):
        request = SearchRequest(q.MatchAll(), aggregations=[TermsFacet("f", name, size=50)], facets_together=True)
        found = search(Collection(rows, "id"), request).aggregations["f"]
        assert found.schema["term"].dataType == rows.schema[name].dataType
        assert {r[0] for r in found.select("term").collect()} == {r[0] for r in rows.select(name).collect()}
