"""Batch search against single queries, and query strings."""

import random

import pytest
from pyspark.sql import functions as F

from docquarry.operators import queries as q
from docquarry.operators.compile import scored
from docquarry.plans.batch import QueryStrings, batch_match, clause_rows, search_strings
from docquarry.plans.index import build_index, prepare, refresh_index
from docquarry.plans.search import Collection

TEXT = {"text": "standard"}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    words = ["red", "rod", "read", "blue", "blur", "green", "a", "b", "c"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(150)] + [(150, ""), (151, None)]
    return spark.createDataFrame(rows, "id int, text string").repartition(4)


@pytest.fixture(scope="module")
def collection(docs, tmp_path_factory):
    return prepare(Collection(docs, "id", TEXT), str(tmp_path_factory.mktemp("index")), files=3)


@pytest.fixture(scope="module")
def index(collection):
    return collection.index


def single(docs, query):
    return {r["id"]: round(r["_score"], 9) for r in scored(docs, query, TEXT).collect()}


def strings(spark, index, text, **options):
    table = spark.createDataFrame([("x", text)], "query_id string, query string")
    found = search_strings(table, index, QueryStrings(["text"], **options), None)
    return {r["_id"]: round(r["_score"], 9) for r in found.collect()}


def test_postings_reproduce_texts(docs, index):
    rebuilt = {}
    for r in index.postings.collect():
        for p in r["positions"]:
            rebuilt.setdefault(r["_id"], {})[p] = r["term"]
        assert len(r["positions"]) == r["tf"]
    for r in docs.collect():
        assert [t for _, t in sorted(rebuilt.get(r["id"], {}).items())] == (r["text"] or "").split()


def test_prepared_scores_equal_unprepared(docs, collection):
    for query in (q.Match("text", "red blue a"), q.MatchPhrase("text", "a b"), q.Match("text", "rad", fuzziness=1)):
        stored = scored(collection.docs, query, TEXT, collection.index)
        assert {r["id"]: round(r["_score"], 9) for r in stored.collect()} == single(docs, query)


def test_batch_equals_single_queries(spark, docs, index):
    texts = {"1": "red blue", "2": "green green a", "3": "nothing", "4": "c b a"}
    table = spark.createDataFrame(list(texts.items()), "query_id string, query string")
    found = {}
    for r in batch_match(table, index, "text", 500).collect():
        found.setdefault(r["query_id"], {})[r["_id"]] = round(r["_score"], 9)
    assert "3" not in found
    for key in ("1", "2", "4"):
        assert found[key] == single(docs, q.Match("text", texts[key]))
    ands = batch_match(table.filter("query_id = '4'"), index, "text", 500, operator="and")
    assert {r["_id"]: round(r["_score"], 9) for r in ands.collect()} == single(
        docs, q.Match("text", "c b a", operator="and")
    )


@pytest.mark.parametrize(
    "text,query",
    [
        ("red", q.Match("text", "red")),
        ("red text:blue", q.Match("text", "red blue")),
        ("+red -blue green^3", q.Bool.of(must=[q.Match("text", "red")], must_not=[q.Match("text", "blue")],
                                         should=[q.Match("text", "green", boost=3.0)])),
        ("red AND NOT blue", q.Bool.of(must=[q.Match("text", "red")], must_not=[q.Match("text", "blue")])),
        ('"a b"', q.MatchPhrase("text", "a b")),
        ('"a b c"~2 OR red', q.Bool.of(should=[q.MatchPhrase("text", "a b c", slop=2), q.Match("text", "red")])),
        ('"a b a"~3', q.MatchPhrase("text", "a b a", slop=3)),
        ('"c b"~5^2', q.MatchPhrase("text", "c b", slop=5, boost=2.0)),
        ("rad~1", q.Match("text", "rad", fuzziness=1)),
        ("bleu~", q.Match("text", "bleu", fuzziness=2)),
        ("grn~2 r~1", q.Bool.of(should=[q.Match("text", "grn", fuzziness=2), q.Match("text", "r", fuzziness=1)])),
        ("rodxyz~3", q.Match("text", "rodxyz", fuzziness=3)),
        ("-red", q.Bool.of(must=[q.ConstantScore(q.MatchAll(), boost=0.0)], must_not=[q.Match("text", "red")])),
        ("* -red", q.Bool.of(should=[q.MatchAll()], must_not=[q.Match("text", "red")])),
    ],
)
def test_query_strings_equal_queries(spark, docs, index, text, query):
    expected = single(docs, query)
    assert strings(spark, index, text) == expected
    assert expected, "the case should find something"


def test_prefix_words_count_as_one_term(spark, docs, index):
    found = strings(spark, index, "re*")
    holders = {r["id"] for r in docs.collect() if any(w.startswith("re") for w in (r["text"] or "").split())}
    assert set(found) == holders


@pytest.mark.parametrize(
    "options,text,rows",
    [
        ({"syntax": "simple"}, "a + b", [("must", "term", ["a"]), ("must", "term", ["b"])]),
        ({"syntax": "simple"}, "a -b | c", [("should", "term", ["a"]), ("must_not", "term", ["b"]), ("should", "term", ["c"])]),
        ({"syntax": "simple", "flags": ["and"]}, "a*", [("should", "term", ["a", "*"][:1])]),
        ({"syntax": "simple", "flags": ["phrase", "whitespace"]}, '"a b" -c', [("should", "phrase", ["a", "b"]), ("should", "term", ["c"])]),
        ({"syntax": "simple", "flags": ["whitespace"]}, '"a b"~2', [("should", "term", ["a"]), ("should", "term", ["b", "2"])]),
        ({"syntax": "simple", "flags": ["none"]}, "a -b", [("should", "term", ["a", "b"])]),
        ({"syntax": "simple", "flags": ["escape", "prefix", "whitespace"]}, r"ab\* cd*", [("should", "term", ["ab"]), ("should", "prefix", ["cd"])]),
        ({"syntax": "simple", "flags": ["slop", "phrase", "whitespace"]}, '"a b"~2', [("should", "phrase", ["a", "b"])]),
        ({"default_operator": "and"}, "a b OR c", [("must", "term", ["a"]), ("should", "term", ["b"]), ("should", "term", ["c"])]),
        ({}, "x:a y", [("should", "term", ["a"]), ("should", "term", ["y"])]),
        ({}, "foo-bar", [("should", "term", ["foo", "bar"])]),
    ],
)
def test_clause_rows(spark, options, text, rows):
    table = spark.createDataFrame([("x", text)], "query_id string, query string")
    found = clause_rows(table, QueryStrings(["text"], **options)).orderBy("clause_id").collect()
    assert [(r["occur"], r["kind"], r["terms"]) for r in found] == rows


def test_wrong_specs_are_refused():
    for options in ({"boosts": [1.0, 2.0]}, {"syntax": "other"}, {"default_operator": "xor"}, {"flags": ["what"]}):
        with pytest.raises(ValueError):
            QueryStrings(["text"], **options)


def test_refresh_replaces_postings(spark, docs, index):
    changed = spark.createDataFrame([(0, "zebra zebra"), (1, "")], "id int, text string")
    fresh = refresh_index(index, changed, "id", TEXT)
    full = build_index(
        docs.filter("id > 1").unionByName(changed), "id", TEXT
    )
    key = ["term", "_id", "tf"]
    assert sorted(fresh.postings.select(key).collect()) == sorted(full.postings.select(key).collect())
    assert sorted(fresh.term_stats.select("term", "df").collect()) == sorted(full.term_stats.select("term", "df").collect())
    assert fresh.field_stats.select("n_docs", "sum_dl").collect() == full.field_stats.select("n_docs", "sum_dl").collect()


def test_sloppy_match_against_brute_force(docs):
    """A phrase matches if some choice of distinct positions spans at most the slop."""
    from itertools import product

    for terms, slop in ((["a", "b"], 1), (["a", "b", "c"], 3), (["a", "a"], 2)):
        wanted = set()
        for r in docs.collect():
            words = (r["text"] or "").split()
            places = [[p for p, w in enumerate(words) if w == t] for t in terms]
            for chosen in product(*places):
                offsets = [p - j for j, p in enumerate(chosen)]
                if len(set(chosen)) == len(chosen) and max(offsets) - min(offsets) <= slop:
                    wanted.add(r["id"])
                    break
        found = scored(docs, q.MatchPhrase("text", " ".join(terms), slop=slop), TEXT)
        assert {r["id"] for r in found.select(F.col("id")).collect()} == wanted, terms


def test_too_many_edits_are_refused(spark, index):
    with pytest.raises(Exception, match="at most 3 edits"):
        strings(spark, index, "word~4")


def test_both_join_forms_agree(spark, index, monkeypatch):
    """Beyond the size limit requests are salted and shuffled; every kind of clause gives the same."""
    from docquarry.operators import joins

    texts = ["red blue", '"a b" -red', "re* gre*", "rad~1 bleu~2", '"a b c"~3', "* -red", "-red"]
    small = [strings(spark, index, t) for t in texts]
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    assert [strings(spark, index, t) for t in texts] == small


def test_near_words_against_brute_force(spark):
    from docquarry.operators.joins import fuzzy_matches

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
    terms, words = sorted({word() for _ in range(120)}), [(word(), rng.randint(1, 3)) for _ in range(25)]

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            new = [i]
            for j, d in enumerate(y, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    wanted = spark.createDataFrame([("f", w, k) for w, k in set(words)], "field string, word string, k int")
    vocabulary = spark.createDataFrame([("f", t) for t in terms], "field string, term string")
    found = {(r["word"], r["k"], r["term"]) for r in fuzzy_matches(wanted, vocabulary, ["field"], [1, 2, 3]).collect()}
    assert found == {(w, k, t) for w, k in words for t in terms if distance(w, t) <= k}
