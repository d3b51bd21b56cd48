"""Multi-valued fields: values, text, long term lists."""

import pytest
from pyspark.sql import functions as F

from docquarry.functions.fields import as_array, first_value
from docquarry.operators import queries as q
from docquarry.operators.compile import matching, scored
from docquarry.operators.term_tables import in_term_table


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [("1", ["Red fox", None, "blue sky"], 5), ("2", [], None), ("3", None, 7), ("4", ["fox"], 1)],
        "_id string, t array<string>, n int",
    )


def test_values(docs):
    kind = {f.name: f.dataType for f in docs.schema}
    rows = docs.select(
        "_id",
        first_value(F.col("t"), kind["t"]).alias("first"),
        as_array(F.col("t"), kind["t"]).alias("all"),
        as_array(F.col("n"), kind["n"]).alias("one"),
    ).collect()
    assert {r["_id"]: (r["first"], r["all"], r["one"]) for r in rows} == {
        "1": ("Red fox", ["Red fox", "blue sky"], [5]),
        "2": (None, [], None),
        "3": (None, None, [7]),
        "4": ("fox", ["fox"], [1]),
    }


def test_text_in_several_values(docs):
    found = scored(docs, q.Match("t", "FOX sky"), {"t": "standard"}).collect()
    scores = {r["_id"]: r["_score"] for r in found}
    assert set(scores) == {"1", "4"} and scores["1"] > scores["4"] > 0
    assert [r["_id"] for r in matching(docs, q.Term("t", "fox")).collect()] == ["4"]


def test_long_term_lists(spark, docs):
    terms = spark.createDataFrame([("fox",), ("fox",), ("blue sky",)], "w string")
    assert sorted(r["_id"] for r in in_term_table(docs, "t", terms, "w", "_id").collect()) == ["1", "4"]
    numbers = spark.createDataFrame([(7,), (5,)], "w int")
    assert sorted(r["_id"] for r in in_term_table(docs, "n", numbers, "w").collect()) == ["1", "3"]
    with pytest.raises(ValueError):
        in_term_table(docs, "t", terms, "w")
