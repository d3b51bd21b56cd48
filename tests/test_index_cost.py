"""What making the index and searching it by document cost: ordered postings, one exchange, few partitions."""

import re
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle

from docquarry.plans import index as module
from docquarry.plans.batch import QueryStrings, search_strings
from docquarry.plans.index import build_index, prepare
from docquarry.plans.search import Collection

TEXT = {"text": "standard"}


def expected(rows):
    found = {}
    for i, words in rows:
        for at, word in enumerate(words):
            found.setdefault((i, len(words), word), []).append(at)
    return sorted((i, dl, word, len(at), at) for (i, dl, word), at in found.items())


@pytest.mark.parametrize("tokens", [1, 4, 1000])
def test_postings_of_any_number_of_documents_at_a_time(tokens):
    make = module._posting_batches(tokens, 2)
    rows = [(7, ["b", "a", "b"]), (7, ["é"]), (3, ["a", "a", "ab", "", "b", "a"]), (1, ["b"])]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([w for _, w in rows])], ["_id", "t"])
    parts = [batch.slice(0, 1), batch.slice(1), batch.slice(0, 0)]
    found = [tuple(r.values()) for part in make(iter(parts)) for r in part.to_pylist()]
    assert sorted(found) == expected(rows)
    # A word that is not there has no posting but keeps its place.
    gap = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([["b", None, "b"]])], ["_id", "t"])
    assert [r for part in make(iter([gap])) for r in part.to_pylist()] == [{"_id": 1, "dl": 3, "term": "b", "tf": 2, "positions": [0, 2]}]


def test_postings_leave_the_documents_by_term_and_impact(spark):
    rows = [("x", "red blue red"), ("y", "blue " * 5), (None, "red"), ("z", None), ("w", "!"), ("v", "a " * 9 + "red")]
    docs = spark.createDataFrame(rows, "id string, text string").coalesce(1)
    found = build_index(docs, "id", TEXT).postings.collect()
    words = [(i, (text or "").replace("!", "").split()) for i, text in rows]
    plain = sorted((str(r["_id"]), r["dl"], r["term"], r["tf"], list(r["positions"])) for r in found)
    assert plain == expected([(str(i), w) for i, w in words])
    assert [r["term"] for r in found] == ["a", "blue", "blue", "red", "red", "red"]
    assert [r["_id"] for r in found] == ["v", "y", "x", "x", None, "v"]
    assert build_index(docs, "id", TEXT, positions=False).postings.columns == ["field", "_id", "dl", "term", "tf"]


def test_executors_need_not_have_the_package():
    """What is sent to them names no module of this package."""
    sent = cloudpickle.dumps(module._posting_batches(5, 5))
    found = subprocess.run(
        [sys.executable, "-c", "import sys, pickle; pickle.loads(sys.stdin.buffer.read()); print('docquarry' in sys.modules)"],
        input=sent, capture_output=True, cwd="/",
    )
    assert found.stdout.strip() == b"False", found.stderr


def answers(found):
    return sorted((r["query_id"], r["rank"], r["_id"], round(r["_score"], 9)) for r in found.collect())


def test_classes_are_counted_and_scored_from_one_exchange(spark, tmp_path, monkeypatch):
    rows = [(i, " ".join(f"{'abc'[(i * k) % 3]}{(i + k) % 7}" for k in range(i % 9))) for i in range(80)]
    docs = spark.createDataFrame(rows, "id long, text string")
    made = prepare(Collection(docs, "id", TEXT), str(tmp_path), files=2).index
    table = spark.createDataFrame([(0, "a* b*"), (1, "+a* -c3*"), (2, "b* c* a1*")], "query_id long, query string")
    found = search_strings(table, made, QueryStrings(["text"]), 4)
    before = answers(found)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange \[[^\]]*\], Exchange hashpartitioning\(_id#", plan), plan
    # Of each partition the best of every query are shuffled, so many small ones are put together first.
    monkeypatch.setattr(module, "TASK_PAIRS", 5)
    many = search_strings(table, made, QueryStrings(["text"]), 4)
    assert answers(many) == before
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Coalesce \d+", plan), plan


def test_terms_are_estimated_by_plain_aggregates(spark):
    words = spark.range(60000).selectExpr("concat('w', id % 20000) AS term").unionAll(spark.sql("SELECT cast(null AS string)"))
    found = module._vocabulary(words, "text")
    assert "approx_count_distinct" not in found._jdf.queryExecution().optimizedPlan().toString()
    (row,) = found.collect()
    assert row["field"] == "text" and 0.85 * 20000 < row["n_terms"] < 1.15 * 20000
    assert module._vocabulary(words.limit(0), "text").first()["n_terms"] == 0
