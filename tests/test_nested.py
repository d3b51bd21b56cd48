import pytest
from pyspark.sql import functions as F

from docquarry.operators import nested_tables
from docquarry.operators import queries as q
from docquarry.operators.compile import matching, scored
from docquarry.operators.highlight import Highlight


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [
            ("1", [("bind", 0.9, 3, "one binds two"), ("express", 0.1, 5, "two express")]),
            ("2", [("bind", 0.2, 9, "nothing here"), ("bind", 0.6, 1, "it binds and binds"), ("bind", 0.7, 2, "binds")]),
            ("3", []),
            ("4", None),
        ],
        "_id string, events array<struct<type:string,likelihood:double,size:int,text:string>>",
    )


def test_conditions_hold_in_one_child(docs):
    both = q.Bool.of(must=[q.Term("events.type", "express"), q.Range("events.likelihood", gt=0.5)])
    assert matching(docs, q.Nested("events", both)).count() == 0
    either = q.Bool.of(must=[q.Term("events.type", "bind"), q.Range("events.likelihood", gt=0.5)])
    assert sorted(r["_id"] for r in matching(docs, q.Nested("events", either)).collect()) == ["1", "2"]


def test_negation_keeps_documents_without_children(docs):
    wanted = q.Bool.of(must_not=[q.Nested("events", q.Term("type", "bind"))])
    assert sorted(r["_id"] for r in matching(docs, wanted).collect()) == ["3", "4"]


@pytest.mark.parametrize("mode,expected", [("sum", 12.0), ("avg", 4.0), ("min", 1.0), ("max", 9.0), ("none", 0.0)])
def test_score_modes(docs, mode, expected):
    child = q.FunctionScore(
        q.ConstantScore(q.Term("events.type", "bind")), q.FieldValueFactor("events.size"), boost_mode="replace"
    )
    found = {r["_id"]: r["_score"] for r in scored(docs, q.Nested("events", child, mode)).collect()}
    assert found["2"] == pytest.approx(expected)


def test_inner_hits(docs):
    spec = Highlight()
    spec.add("events.text")
    child = q.Bool.of(must=[q.Match("events.text", "binds")], should=[q.Range("events.size", gte=2)])
    wanted = q.Nested(
        "events", child, inner_hits=q.InnerHits(size=2, fields=["events.te*"], explain=True, highlight=spec,
                                                fetch_source=True)
    )
    found = {r["_id"]: r for r in scored(docs, wanted, {"events.text": "standard"}).collect()}
    hits = found["2"]["inner_hits"]["events"]
    assert [h["text"] for h in hits] == ["binds", "it binds and binds"]
    assert hits[1]["text_highlight"] == ["it <em>binds</em> and <em>binds</em>"]
    assert hits[0]["_score"] == pytest.approx(hits[0]["_explain"]["clause_0"] + hits[0]["_explain"]["clause_1"])
    assert hits[0]["_source"]["type"] == "bind"


def test_table_form_agrees_with_arrays(docs):
    children = docs.select("_id", F.explode("events").alias("e")).select("_id", "e.*")
    child = q.FunctionScore(q.ConstantScore(q.Term("type", "bind")), q.FieldValueFactor("size"), boost_mode="replace")
    for mode in ("sum", "avg", "min", "max", "none"):
        arrays = scored(docs, q.Nested("events", child, mode)).select("_id", "_score").collect()
        tables = nested_tables.score_by_children(docs.select("_id"), children, "_id", child, mode)
        assert sorted(tables.select("_id", "_score").collect()) == sorted(arrays)
