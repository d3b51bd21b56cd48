"""Query strings as parts of other queries: the same hits and scores as the table of strings gives."""

import pytest

from docquarry.operators import queries as q
from docquarry.operators.compile import matching, scored
from docquarry.operators.highlight import Highlight
from docquarry.operators.query_strings import expanded
from docquarry.operators.scope import Scope
from docquarry.plans.batch import QueryStrings, search_strings
from docquarry.plans.index import build_index
from docquarry.plans.search import Collection, SearchRequest, search

ROWS = [
    (1, "red fox jumps", "the quick red fox", "en"), (2, "blue hen", "red hen and blue fox", "en"), (3, "fox", "nothing here", "de"),
    (4, "a-b c", "red red red fox fox", None), (5, None, "foxes are redder", "en"), (6, "hen", None, "de"),
]
FIELDS = {"title": "standard", "body": "standard"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "id long, title string, body string, lang string")


FULL = ["+red -hen", 'title:fox body:red^2 "red hen"~3', "fo* rde~2 hen", "* -fox", "red OR hen NOT fox", "!!"]
SIMPLE = ['"red fox" | hen', "fo* -blue fxo~2", "* -hen", "a-b"]


@pytest.mark.parametrize("syntax,operator", [("full", "or"), ("full", "and"), ("simple", "or")])
def test_same_as_a_table_of_strings(spark, docs, syntax, operator):
    texts = FULL if syntax == "full" else SIMPLE
    table = search_strings(
        spark.createDataFrame(list(enumerate(texts)), "query_id int, query string"),
        build_index(docs, "id", FIELDS), QueryStrings(["title", "body"], [2.0, 1.0], syntax, operator), None,
    ).collect()
    for number, text in enumerate(texts):
        wanted = q.QueryString(text, ["title", "body"], [2.0, 1.0], syntax, operator)
        ours = {r["id"]: round(r["_score"], 6) for r in scored(docs, wanted, FIELDS).select("id", "_score").collect()}
        assert ours == {r["_id"]: round(r["_score"], 6) for r in table if r["query_id"] == number}, text


# Each switch of the simple syntax alone, and the hits it gives for one string.
FLAGS = {
    "none": '+red -hen "red fox"~2 fo* fxo~2 | blue', "all": '+red -hen "red fox"~2 fo* fxo~2 | blue', "and": "red + hen", "or": "red | hen", "not": "red -hen",
    "prefix": "fo* xyz", "phrase": '"hen and" xyz', "escape": r"fo\* xyz", "whitespace": "red  hen", "fuzzy": "fxo~2 xyz", "near": '"red blue"~3', "slop": '"red blue"~3',
}


@pytest.mark.parametrize("flag", sorted(FLAGS))
def test_every_flag(spark, docs, flag):
    index = build_index(docs, "id", FIELDS)
    flags = [flag] if flag not in ("near", "slop") else [flag, "phrase"]
    table = search_strings(
        spark.createDataFrame([(1, FLAGS[flag])], "query_id int, query string"), index, QueryStrings(["body"], syntax="simple", flags=flags), None
    )
    wanted = q.QueryString(FLAGS[flag], ["body"], syntax="simple", flags=flags)
    ours = {r["id"]: round(r["_score"], 6) for r in scored(docs, wanted, FIELDS).select("id", "_score").collect()}
    assert ours == {r["_id"]: round(r["_score"], 6) for r in table.collect()}


def test_with_other_queries_patterns_and_highlights(spark, docs):
    wanted = q.Bool.of(must=[q.QueryString("fox", ["*"])], filter=[q.Term("lang", "en")])
    assert {r["id"] for r in matching(docs, wanted, FIELDS).collect()} == {1, 2}
    marks = Highlight()
    marks.add("body")
    found = search(Collection(docs, "id", FIELDS), SearchRequest(wanted, highlight=marks)).hits.collect()
    assert {r["id"] for r in found} == {1, 2} and all("fox" in str(r["highlight"]) for r in found)
    many = expanded(q.MultiMatch("fox", ["t*", "body"], [3.0, 1.0]), Scope(docs.schema, FIELDS, docs))
    assert many.fields == ["title", "body"] and many.weights == [3.0, 1.0]
    nested = spark.createDataFrame([(1, [("red fox",), ("hen",)]), (2, [("hen red",)])], "id long, parts array<struct<said:string>>")
    inside = q.Nested("parts", q.QueryString("+red +fox", ["parts.said"]))
    assert [r["id"] for r in matching(nested, inside, {"parts.said": "standard"}).collect()] == [1]
