"""Batches meet their requests by document: what is shuffled follows the postings, not requests times documents."""

import re

import pytest

from docquarry.plans.batch import QueryStrings, batch_match, search_strings
from docquarry.plans.index import TASK_POSTINGS, prepare
from docquarry.plans.search import Collection

TEXT = {"text": "standard"}
TEXTS = ["red blue", "+red -blue green^3", '"red blue"', '"red blue red"', '"blue green red"~3', "re* gre*", "rad~1", '"red blue" re*']


def prepared(spark, rows, folder):
    docs = spark.createDataFrame(rows, "id long, text string")
    return prepare(Collection(docs, "id", TEXT), str(folder), files=2).index


@pytest.fixture(scope="module")
def rows():
    words = ["red", "blue", "green", "read", "rod"]
    return [(i, " ".join(words[(i * k + k * k) % 5] for k in range(i % 11))) for i in range(120)] + [(200, "red blue red blue red"), (201, None)]


def answers(spark, index):
    table = spark.createDataFrame(list(enumerate(TEXTS)), "query_id long, query string")
    found = search_strings(table, index, QueryStrings(["text"]), None).collect()
    return {(r["query_id"], r["_id"]): round(r["_score"], 9) for r in found}


def shuffled(df):
    """Names of the columns each exchange deals rows out by, in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_hits_are_folded_where_postings_meet(spark, rows, tmp_path):
    index = prepared(spark, rows, tmp_path)
    table = spark.createDataFrame([("a", "red blue"), ("b", "red rod")], "query_id string, query string")
    for found in (batch_match(table, index, "text", 3), search_strings(table, index, QueryStrings(["text"]), 3)):
        by = shuffled(found)
        assert any(re.match(r"_id#", keys) for keys in by), by
        assert not any("query" in keys and re.search(r", _id#", keys) for keys in by), by


def test_documents_of_one_id_give_what_they_gave(spark, rows, tmp_path, monkeypatch):
    """Where ids repeat the general form answers; where they do not, both forms agree."""
    index = prepared(spark, rows, tmp_path / "once")
    here = answers(spark, index)
    assert {q for q, _ in here} == set(range(len(TEXTS)))
    index._unique = False
    assert answers(spark, index) == here
    twice = prepared(spark, rows + rows[:7] + [(None, "red blue"), (None, "blue green red")], tmp_path / "twice")
    assert not twice.unique_ids()
    answers(spark, twice)


def test_tasks_that_sort_postings_follow_their_number(spark, tmp_path, monkeypatch):
    from docquarry.plans import index as module

    monkeypatch.setattr(module, "TASK_POSTINGS", 50)
    monkeypatch.setattr(module, "BUCKET_TERMS", 10)
    rows = [(i, " ".join(f"w{(i * 7 + k) % 400}" for k in range(20))) for i in range(100)]
    prepared(spark, rows, tmp_path)
    files = [p.name.split("-")[1] for p in (tmp_path / "postings").rglob("part-*.parquet")]
    assert len(set(files)) > 10 and TASK_POSTINGS > 50


CLASSES = ["re* gre*", "+re* -gre*", "+gre* rad~1 re*^3", "blue~1 blu* rod~1", "zzz*", "+zzz* re*", "r* r* b*"]


@pytest.mark.parametrize("as_id", [int, lambda i: f"é{i % 7}-{i}"])
def test_classes_are_folded_as_arrays(spark, rows, tmp_path, monkeypatch, as_id):
    """No row per query and document, and the rows of the general form, however few documents are folded at once."""
    from docquarry.plans import batch

    id_type = "long" if as_id is int else "string"
    docs = spark.createDataFrame([(as_id(i), text) for i, text in rows] + [(None, "red blue red")], f"id {id_type}, text string")
    index = prepare(Collection(docs, "id", TEXT), str(tmp_path), files=2).index
    table = spark.createDataFrame(list(enumerate(CLASSES)), "query_id long, query string")

    def found(n, spec=QueryStrings(["text"])):
        got = search_strings(table, index, spec, n).collect()
        return sorted((r["query_id"], r["_id"] is not None, r["_id"], round(r["_score"], 9), r["rank"] if n else None) for r in got)

    plan = search_strings(table, index, QueryStrings(["text"]), 3)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not re.search(r"Aggregate\(keys=\[_query#\w+, _id#", plan)
    some = QueryStrings(["text"], minimum_should_match=2)
    folded = [found(None), found(4), found(1), found(None, some)]
    for name, size in (("FOLD_NUMBERS", 20), ("FOLD_ROWS", 3), ("FOLD_CANDIDATES", 2)):
        monkeypatch.setattr(batch, name, size)
    assert [found(None), found(4), found(1), found(None, some)] == folded
    index._unique = False
    assert [found(None), found(4), found(1), found(None, some)] == folded and {q for q, *_ in folded[0]} == {0, 1, 2, 3, 6}
