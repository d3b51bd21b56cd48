"""Postings read by term: pruning, equal results with and without, and the best page in two rounds."""

import random
import time

import pytest
from pyspark.sql import functions as F

from docquarry import catalog
from docquarry.catalog.base import documents, indexed_documents, prepared
from docquarry.catalog.text import pages
from docquarry.functions import analysis
from docquarry.operators import queries as q
from docquarry.operators.compile import scored
from docquarry.operators.posted import PROFILE, PostingsView
from docquarry.plans.index import LEVELS, build_index, refresh_index
from docquarry.plans.search import Collection, SearchRequest, count, search
from docquarry.plans.top import best_candidates, known_terms, required_terms, second_round, summed_terms, threshold
from docquarry.operators.scope import Scope

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def indexed(spark):
    return indexed_documents(spark, FOLDER)


def text_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["match_or", "phrase", "multi_match_best", "batch_search", "query_strings", "match_fuzzy"])
def test_only_the_partitions_of_the_terms_are_read(spark, name):
    text = text_of(catalog.QUERIES[name](spark, FOLDER))
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in text.splitlines() if "PartitionFilters: [" in line]
    assert any("bucket" in f and (" IN " in f or "INSET" in f or " = " in f) for f in filters), text


def test_words_are_spread_over_buckets(spark, indexed):
    index = indexed.index
    counts = index.term_stats.groupBy("bucket").count().collect()
    assert 1 < index.buckets == len(counts)
    wrong = index.term_stats.where(F.crc32(F.concat("field", F.lit("\0"), "term").cast("binary")) % index.buckets != F.col("bucket"))
    assert wrong.isEmpty()


def pairs(df, id_col):
    return sorted((r[0], round(r[1], 9)) for r in df.select(id_col, "_score").collect())


QUERIES = [
    q.Match("text", "thtion ention the"),
    q.Match("text", "the attion ertion", operator="and"),
    q.Match("text", "thtion attion ertion ontion", minimum_should_match="75%"),
    q.Match("text", "attion the attion"),
    q.Match("text", "attion enlich", fuzziness=1, operator="and"),
    q.Match("text", "taht", fuzziness=2, transpositions=True),
    q.Term("text", "enlich", boost=2.0),
    q.Terms("text", ["enlich", "thtion", "nosuchword"]),
    q.Wildcard("text", "thti*"),
    q.Wildcard("text", "*tti?n"),
    q.MatchPhrase("text", "of the"),
    q.MatchPhrase("text", "the of the", slop=3),
    q.MatchPhrase("text", "of th", prefix=True),
    q.MatchPhrase("text", "thti", prefix=True),
    q.MatchPhrase("text", "nosuchword the"),
    q.MatchPhrase("text", "of the of", slop=2, prefix=True),
    q.Match("text", "!!"),
    q.DisMax([q.Match("text", "thtion"), q.MatchPhrase("text", "of the")], tie_breaker=0.3),
    q.Bool.of(must=[q.Range("doc_id", lt=100)], should=[q.Match("text", "the")], must_not=[q.Match("text", "thtion")]),
    q.Bool.of(should=[q.Match("text", "thtion"), q.Term("lang", "de")]),
    q.Bool.of(filter=[q.Term("lang", "en")], must=[q.Match("text", "thtion ention")]),
    q.Bool.of(must=[q.Term("lang", "en")], should=[q.Match("text", "the"), q.Match("text", "thtion")], minimum_should_match=1),
    q.Bool.of(must_not=[q.MatchPhrase("text", "of the")]),
    q.ConstantScore(q.Match("text", "enlich")),
    q.FunctionScore(q.Match("text", "thtion"), q.FieldValueFactor("n_chars", modifier="log1p")),
    q.MultiMatch("thtion the", ["text", "lang", "nosuchfield"]),
    q.MultiMatch("of the", ["text"], type="phrase"),
    q.MultiMatch("thtion the", ["text"], type="cross_fields", operator="and"),
]


@pytest.mark.parametrize("number", range(len(QUERIES)))
def test_same_hits_and_scores_as_from_the_texts(spark, indexed, number):
    plain = documents(spark, FOLDER)
    wanted = QUERIES[number]
    expected = pairs(scored(plain.docs, wanted, plain.text_fields), "doc_id")
    assert pairs(scored(indexed.docs, wanted, indexed.text_fields, indexed.index), "doc_id") == expected
    assert count(indexed, wanted).first()[0] == len(expected)


def test_two_fields_same_as_from_the_texts(spark):
    plain, ready = pages(spark, FOLDER), prepared(spark, FOLDER, pages(spark, FOLDER), "pages")
    for kind in ("best_fields", "most_fields", "cross_fields", "phrase", "phrase_prefix"):
        wanted = q.MultiMatch("feed example", ["url", "html"], [2.0, 1.0], type=kind)
        expected = pairs(scored(plain.docs, wanted, plain.text_fields), "page_id")
        assert pairs(scored(ready.docs, wanted, ready.text_fields, ready.index), "page_id") == expected


def best(collection, wanted, start, rows, least):
    request = SearchRequest(wanted, start=start, rows=rows, fields=["lang"], least_postings=least)
    return [(r["doc_id"], r["lang"], round(r["_score"], 9)) for r in search(collection, request).hits.collect()]


def test_best_page_is_the_same_in_two_rounds(spark, indexed):
    rng = random.Random(3)
    frequent = [r["term"] for r in indexed.index.term_stats.orderBy(F.desc("df"), "term").limit(40).collect()]
    rare = [r["term"] for r in indexed.index.term_stats.where("df between 8 and 20").orderBy("term").limit(200).collect()]
    cut = 0
    for trial in range(6):
        words = rng.sample(rare, rng.randint(1, 2)) + rng.sample(frequent, rng.randint(1, 3))
        wanted = q.Match("text", " ".join(words))
        if trial % 3 == 0:
            wanted = q.Bool.of(should=[q.Match("text", words[0], boost=3.0), q.Term("text", words[-1]), wanted])
        start, rows = rng.choice([(0, 3), (0, 5), (2, 3)])
        cut += best_candidates(indexed.docs, wanted, indexed.text_fields, indexed.index, start + rows, 0) is not None
        assert best(indexed, wanted, start, rows, 0) == best(indexed, wanted, start, rows, 10**12)
    assert cut >= 2


def test_second_round_reads_fewer_postings(spark, indexed):
    rare = indexed.index.term_stats.where("df between 10 and 15").orderBy("term").first()["term"]
    view = PostingsView(indexed.index)
    boosts = summed_terms(q.Match("text", f"{rare} the"), Scope(indexed.docs.schema, indexed.text_fields, indexed.docs, view=view))
    terms = known_terms(indexed.index, boosts)
    required = required_terms(terms, threshold(indexed.index, terms, 3))
    assert set(required) == {("text", rare)}
    for name, term in boosts:
        view.frequency(name, ("term", term))
    view.recording = False
    everything = indexed.index.postings_of(list(boosts)).count()
    assert second_round(view, required).count() < everything / 3
    levels = {t.term: t for t in terms}
    held = indexed.index.postings_of([("text", "the")]).agg(*[F.count_if(F.col("impact") >= 2.2 * (i + 1) / LEVELS) for i in range(LEVELS)]).first()
    assert list(held) == levels["the"].levels


def test_refreshed_index_same_as_a_new_one(spark, indexed):
    changed = indexed.docs.where("doc_id < 20").select("doc_id", F.concat("text", F.lit(" thtion zebra")).alias("text"))
    changed = changed.unionByName(spark.createDataFrame([(10**6, "thtion alone")], "doc_id long, text string"))
    refreshed = refresh_index(indexed.index, changed, "doc_id", {"text": "standard"})
    rest = documents(spark, FOLDER).docs.select("doc_id", "text").join(changed.select("doc_id"), "doc_id", "left_anti").unionByName(changed)
    fresh = build_index(rest, "doc_id", {"text": "standard"})
    columns = ["field", "term", "_id", "tf", "dl"]
    assert refreshed.postings.select(columns).exceptAll(fresh.postings.select(columns)).isEmpty()
    assert fresh.postings.select(columns).exceptAll(refreshed.postings.select(columns)).isEmpty()
    assert sorted(map(tuple, refreshed.field_stats.select("field", "n_docs", "sum_dl").collect())) == sorted(
        map(tuple, fresh.field_stats.select("field", "n_docs", "sum_dl").collect()))
    got = pairs(scored(rest, q.Match("text", "zebra thtion"), {"text": "standard"}, refreshed), "doc_id")
    assert got == pairs(scored(rest, q.Match("text", "zebra thtion"), {"text": "standard"}), "doc_id")


def test_near_words_of_any_length_compile_at_once(spark):
    start = time.time()
    test = analysis.edit_distance_within(F.col("w"), "abcdefghijklmnopqrstuvwxy", 3, True)
    rows = spark.createDataFrame([("abdcefghijklmnopqrstuvwyx",), ("bacdefghijklmnopqrtsuvwyx",), ("bacdfeghijklmnopqrtsuvwyx",), ("",)], "w string")
    found = rows.select(test.alias("t"))
    found._jdf.queryExecution().optimizedPlan()
    assert time.time() - start < 5
    assert [r["t"] for r in found.collect()] == [True, True, False, False]


def test_an_empty_collection_and_words_of_nobody(spark, tmp_path):
    from docquarry.plans.index import prepare

    empty = Collection(spark.createDataFrame([], "key string, body string"), "key", {"body": "standard"})
    ready = prepare(empty, str(tmp_path))
    assert scored(ready.docs, q.Match("body", "any"), ready.text_fields, ready.index).count() == 0
    rows = spark.createDataFrame([("a", None), ("b", ""), ("c", "One one"), ("d", "two")], "key string, body string")
    ready = prepare(Collection(rows, "key", {"body": "standard"}), str(tmp_path / "more"))
    assert [r["key"] for r in scored(ready.docs, q.Match("body", "one"), ready.text_fields, ready.index).collect()] == ["c"]
    assert count(ready, q.Bool.of(must_not=[q.Match("body", "one")])).first()[0] == 3
    assert PROFILE not in scored(ready.docs, q.Match("body", "one"), ready.text_fields, ready.index).columns
