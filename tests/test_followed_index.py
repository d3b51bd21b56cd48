"""An index kept by a stream: the same as one built anew of the documents after all changes."""

import pytest
from pyspark.sql import functions as F

from docquarry.operators import queries as q
from docquarry.plans.index import prepare
from docquarry.plans.search import Collection, SearchRequest, search
from docquarry.sources.documents import upsert
from docquarry.streaming.followed import FollowedIndex

SCHEMA = "doc_id long, text string, lang string, seq long, gone boolean"
FIELDS = {"text": "standard"}
BATCHES = [
    [(1, "red apple pie", "en", 1, False), (1, "green apple", "en", 2, False), (40, "a new red document", "en", 1, False), (None, "lost", "en", 9, False)],
    [(1, "late and older", "en", 1, False), (2, None, None, 3, None), (40, "red red wine", "fr", 4, False), (41, "", "en", 1, False)],
    [(3, "x", "en", 5, True), (40, "gone again", "en", 5, True), (77, "never there", "en", 1, True)],
    [(3, "third apple is back", "en", 6, False)],
    [],
]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    texts = ["red green blue", "an apple a day", "blue wine and red wine", "pie", None, ""] * 4
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    return prepare(Collection(docs, "doc_id", FIELDS), str(tmp_path_factory.mktemp("base")))


def expected(spark, base, batches, path):
    """The collection after the changes, prepared as a whole."""
    rows = [r for batch in batches for r in batch if r[0] is not None]
    changes = spark.createDataFrame(rows, SCHEMA)
    docs = upsert(base.docs.select("doc_id", "text", "lang"), changes, "doc_id", "seq").where(~F.coalesce("gone", F.lit(False)))
    return prepare(Collection(docs.select("doc_id", "text", "lang"), "doc_id", FIELDS), path)


def content(collection):
    index = collection.index
    take = lambda df, *columns: sorted(map(tuple, df.select(*columns).collect()), key=repr)
    return (
        take(index.postings, "field", "term", "_id", "tf", "dl", "positions"), take(index.term_stats, "field", "term", "df"),
        take(index.field_stats, "field", "n_docs", "sum_dl"), take(index.documents, "_id"),
        take(collection.docs, "doc_id", "text", "lang", "text_tokens"),
    )


def found(collection, text):
    request = SearchRequest(q.Match("text", text), rows=100, fetch_source=False, least_postings=0)
    return [(r["doc_id"], round(r["_score"], 9)) for r in search(collection, request).hits.collect()]


def test_batches_same_as_a_new_index(spark, base, tmp_path):
    followed = FollowedIndex(base, str(tmp_path / "changes"), "seq", "gone")
    assert content(followed.current()) == content(base)
    for number, batch in enumerate(BATCHES):
        followed.add(spark.createDataFrame(batch, SCHEMA), number)
        if number in (1, 4):
            anew = expected(spark, base, BATCHES[: number + 1], str(tmp_path / f"anew{number}"))
            assert content(followed.current()) == content(anew)
            for text in ("red wine", "apple", "never"):
                assert found(followed.current(), text) == found(anew, text)


def test_interrupted_batch_is_repeated(spark, base, tmp_path):
    followed = FollowedIndex(base, str(tmp_path / "changes"), "seq", "gone")
    followed.add(spark.createDataFrame(BATCHES[0], SCHEMA), 0)
    first = content(followed.current())
    write, tables = followed._write, []

    def stopping(rows, name, batch, *by):
        if name == "field_changes":
            raise RuntimeError("stopped")
        tables.append(name)
        write(rows, name, batch, *by)

    followed._write = stopping
    with pytest.raises(RuntimeError, match="stopped"):
        followed.add(spark.createDataFrame(BATCHES[1], SCHEMA), 1)
    assert "term_changes" in tables and content(followed.current()) == first
    followed._write = write
    for _ in range(2):
        followed.add(spark.createDataFrame(BATCHES[1], SCHEMA), 1)
    assert content(followed.current()) == content(expected(spark, base, BATCHES[:2], str(tmp_path / "anew")))


def test_terms_prune_the_partitions_of_changes(spark, base, tmp_path):
    followed = FollowedIndex(base, str(tmp_path / "changes"), "seq", "gone")
    followed.add(spark.createDataFrame(BATCHES[0], SCHEMA), 0)
    plan = followed.current().index.postings_of([("text", "red")])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "Scan parquet" in line and "positions" in line]
    assert len(scans) == 2 and all("bucket" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_only_prepared_collections(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError, match="prepared"):
        FollowedIndex(Collection(docs, "doc_id", FIELDS), "/nowhere")
