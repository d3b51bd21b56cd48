"""Children's texts through the index: the same hits, scores and inner hits as from the documents themselves."""

import pytest
from pyspark.sql import functions as F

from docquarry.catalog.nested import _LINE_FIELDS, documents_with_lines
from docquarry.operators import queries as q
from docquarry.operators.compile import scored
from docquarry.plans.index import prepare
from docquarry.plans.search import Collection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    docs = documents_with_lines(spark, FOLDER).unionByName(
        spark.createDataFrame(
            [(10**6, "en", None), (10**6 + 1, "en", []), (10**6 + 2, None, [None, (0, None, None), (1, "", 0), (2, "thtion of thtion", 16)])],
            "doc_id long, lang string, lines array<struct<no:int,line:string,size:int>>",
        )
    )
    plain = Collection(docs, "doc_id", _LINE_FIELDS)
    return plain, prepare(plain, str(tmp_path_factory.mktemp("lines")))


def line(query, **more):
    return q.Nested("lines", query, **more)


QUERIES = [
    line(q.Match("lines.line", "thtion")),
    line(q.Match("lines.line", "of the", operator="and"), score_mode="max"),
    line(q.Match("lines.line", "nosuchword")),
    line(q.Match("lines.line", "attoin", fuzziness=1, transpositions=True), score_mode="sum"),
    line(q.MatchPhrase("lines.line", "of the"), score_mode="min"),
    line(q.MatchPhrase("lines.line", "of th", prefix=True)),
    line(q.Term("lines.line", "thtion"), score_mode="none"),
    line(q.Bool.of(should=[q.Match("lines.line", "thtion"), q.Match("lines.line", "attion")]), score_mode="sum"),
    line(q.Bool.of(should=[q.Match("lines.line", "thtion"), q.Range("lines.size", gt=400)])),
    line(q.Bool.of(must=[q.Range("lines.size", gt=40)], must_not=[q.Match("lines.line", "the")])),
    line(q.FunctionScore(q.Match("lines.line", "thtion"), q.FieldValueFactor("lines.size")), score_mode="avg"),
    q.Bool.of(must=[line(q.Match("lines.line", "thtion"))], filter=[q.Term("lang", "en")], boost=2.0),
    q.Bool.of(must_not=[line(q.Match("lines.line", "the"))]),
    q.Bool.of(should=[line(q.Match("lines.line", "thtion")), q.Term("lang", "de")]),
]


@pytest.mark.parametrize("number", range(len(QUERIES)))
def test_same_hits_and_scores(both, number):
    def told(c):
        found = scored(c.docs, QUERIES[number], c.text_fields, c.index)
        return sorted((r["doc_id"], round(r["_score"], 9)) for r in found.select("doc_id", "_score").collect())

    assert told(both[1]) == told(both[0])


def test_inner_hits_without_the_stored_tokens(both):
    wanted = line(q.Match("lines.line", "thtion"), inner_hits=q.InnerHits(size=2, fetch_source=True, fields=["*"]))

    def told(c):
        found = scored(c.docs, wanted, c.text_fields, c.index).orderBy("doc_id")
        return [r.asDict(recursive=True) for r in found.select("doc_id", F.explode("inner_hits.lines").alias("hit")).collect()]

    ours, theirs = told(both[1]), told(both[0])
    for a, b in zip(ours, theirs):
        a["hit"]["_score"], b["hit"]["_score"] = round(a["hit"]["_score"], 9), round(b["hit"]["_score"], 9)
    assert ours == theirs and ours


def test_other_documents_are_not_looked_into(both):
    c = both[1]
    found = scored(c.docs, QUERIES[0], c.text_fields, c.index)
    plan = found.select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Inner" in plan and "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1]
    with_lines = c.index.term_stats.where("field = 'lines.line' AND term = 'thtion'").first()["df"]
    exploded = c.docs.select(F.explode("lines").alias("x")).where(F.array_contains("x.line_tokens", "thtion")).count()
    assert with_lines == exploded
