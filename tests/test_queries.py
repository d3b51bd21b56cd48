"""Query semantics on small literal documents."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from docquarry.functions import analysis
from docquarry.operators import queries as q
from docquarry.operators.compile import match_column, matching, scored
from docquarry.plans.search import Collection, SearchRequest, count, search

TEXT = {"text": "standard"}


def ids(df, key="_id"):
    return sorted(r[key] for r in df.select(key).collect())


def test_count_request(three):
    assert count(Collection(three), q.MatchAll()).collect() == [Row(count=3)]


def test_term_on_unknown_field_matches_nothing(three):
    result = search(Collection(three), SearchRequest(q.Term("doesnotexist", "anything"), export=True))
    assert result.hits.collect() == []
    assert result.total.first()["value"] == 0


def test_export_limit_keeps_total(three):
    result = search(Collection(three), SearchRequest(q.MatchAll(), export=True, limit=2))
    assert result.hits.count() == 2
    assert result.total.first() == Row(value=3, relation="EQUAL_TO")


@pytest.mark.parametrize(
    "query,expected",
    [
        (q.Term("topics", "biology"), ["42"]),
        (q.Terms("topics", ["biology", "technology"]), ["42", "44"]),
        (q.Term("published", True), ["43"]),
        (q.Term("version", "1"), ["42", "44"]),
        (q.Term("version", "one"), []),
        (q.Term("text", "Document"), []),
        (q.Term("text", "document"), ["43", "44"]),
        (q.Term("text.keyword", "Document 43"), ["43"]),
        (q.Match("text", "DOCUMENT mammals"), ["42", "43", "44"]),
        (q.Match("text", "document 44", operator="AND"), ["44"]),
        (q.Match("text", "..."), []),
        (q.Match("topics", "biology"), ["42"]),
        (q.MatchPhrase("text", "of many"), ["42"]),
        (q.MatchPhrase("text", "many of"), []),
        (q.MatchPhrase("text", "many of", slop=2), ["42"]),
        (q.MatchPhrase("text", "many of", slop=1), []),
        (q.MatchPhrase("text", "document 4", prefix=True), ["43", "44"]),
        (q.Wildcard("topics", "*olog?"), ["42", "44"]),
        (q.Wildcard("text", "docu*"), ["43", "44"]),
        (q.Wildcard("text", "d?c*t"), ["43", "44"]),
        (q.Range("version", gt=1), ["43"]),
        (q.Range("version", gte=1, lt=2), ["42", "44"]),
        (q.Range("topics", gte="p"), ["43", "44"]),
        (q.Bool.of(must_not=[q.Term("topics", "biology")]), ["43", "44"]),
        (q.Bool.of(must_not=[q.Term("nothing", 1)]), ["42", "43", "44"]),
        (q.Bool.of(should=[q.Term("version", 2)], filter=[q.MatchAll()]), ["42", "43", "44"]),
        (q.Bool.of(should=[q.Term("version", 2)], filter=[q.MatchAll()], minimum_should_match=1), ["43"]),
    ],
)
def test_matches(three, query, expected):
    assert ids(matching(three, query, TEXT)) == expected


@pytest.mark.parametrize(
    "query,error",
    [
        (None, ValueError),
        (q.Query(), TypeError),
        (q.Bool([]), ValueError),
        (q.Bool([q.Clause(None, [q.MatchAll()])]), ValueError),
        (q.Match("text", "a", operator="xor"), ValueError),
        (q.MultiMatch("a", ["text"], operator="xor"), ValueError),
        (q.MultiMatch("a", ["text"], weights=[1.0, 2.0]), ValueError),
        (q.FunctionScore(q.MatchAll()), ValueError),
        (q.FunctionScore(q.MatchAll(), functions=[q.FunctionItem()], score_mode="replace"), ValueError),
        (q.Nested("text", q.MatchAll(), score_mode="median"), ValueError),
        (q.Range("version", gt=1, relation="near"), ValueError),
    ],
)
def test_wrong_queries_are_refused(three, query, error):
    with pytest.raises(error):
        matching(three, query, TEXT)


@pytest.mark.parametrize(
    "spec,n,expected",
    [(3, 5, 3), ("-1", 5, 4), ("75%", 4, 3), ("75%", 5, 3), ("-25%", 5, 4), ("2<75%", 2, 2), ("2<75%", 4, 3),
     ("2<-25% 9<-3", 12, 9), ("9", 3, 3), ("", 3, None), (None, 3, None)],
)
def test_minimum_should_match(spec, n, expected):
    assert analysis.minimum_should_match(spec, n) == expected


def test_minimum_should_match_column_agrees(spark):
    from docquarry.plans.batch import _needed_column

    specs = ["3", "-1", "75%", "-25%", "2<75%", "2<-25% 9<-3", "9", "-60%"]
    df = spark.range(1, 15).select(F.col("id").cast("int").alias("n"))
    row = df.select("n", *[_needed_column(s, F.col("n")).alias(s) for s in specs]).collect()
    for r in row:
        for s in specs:
            assert r[s] == analysis.minimum_should_match(s, r["n"]), (s, r["n"])


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c c c c"), (4, None), (5, "")], "id int, text string")
    found = {r["id"]: r["_score"] for r in scored(docs, q.Match("text", "a b", boost=2.0), TEXT).collect()}
    n, average = 3, 3.0

    def part(df, tf, dl):
        return math.log(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * dl / average))

    assert found == {
        1: pytest.approx(2 * (part(1, 2, 3) + part(2, 1, 3))),
        2: pytest.approx(2 * part(2, 1, 2)),
    }


def test_must_is_intersection_and_should_is_union(spark):
    docs = spark.range(200).select(
        F.col("id"), (F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("b")
    )
    one, two = q.Term("a", 1), q.Term("b", 2)
    left, right = set(ids(matching(docs, one), "id")), set(ids(matching(docs, two), "id"))
    assert set(ids(matching(docs, q.Bool.of(must=[one, two])), "id")) == left & right
    assert set(ids(matching(docs, q.Bool.of(should=[one, two])), "id")) == left | right
    assert set(ids(matching(docs, q.Bool.of(must=[one], must_not=[two])), "id")) == left - right


def test_strict_bounds_win(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert ids(matching(docs, q.Range("v", gt=1, gte=1, lt=3, lte=3)), "v") == [2]


def test_date_formats_and_zones(spark):
    docs = spark.sql(
        "SELECT 1 AS id, timestamp_ntz'2024-01-01 22:30:00' AS ts, timestamp'2024-01-01 22:30:00Z' AS lt "
        "UNION ALL SELECT 2, timestamp_ntz'2024-01-02 00:30:00', timestamp'2024-01-02 00:30:00Z'"
    )
    for field in ("ts", "lt"):
        assert ids(matching(docs, q.Range(field, gte="2024-01-02", format="yyyy-MM-dd")), "id") == [2]
        berlin = q.Range(field, gte="02.01.2024", format="yyyy-MM-dd||dd.MM.yyyy", time_zone="+02:00")
        assert ids(matching(docs, berlin), "id") == [1, 2]
        assert ids(matching(docs, q.Range(field, gt=1704148200000, format="epoch_millis")), "id") == [2]
        assert ids(matching(docs, q.Range(field, gte=1704148200, format="epoch_second")), "id") == [1, 2]


def test_interval_relations(spark):
    docs = spark.sql(
        "SELECT 1 AS id, named_struct('gte', 1, 'lte', 5) AS v UNION ALL SELECT 2, named_struct('gte', 4, 'lte', 20) "
        "UNION ALL SELECT 3, named_struct('gte', 11, 'lte', CAST(NULL AS INT)) UNION ALL SELECT 4, NULL"
    )
    def found(relation):
        return ids(matching(docs, q.Range("v", gte=4, lte=12, relation=relation)), "id")

    assert found("intersects") == [1, 2, 3]
    assert found("within") == []
    assert found("contains") == [2]
    assert ids(matching(docs, q.Range("v", gte=5, lte=5, relation="contains")), "id") == [1, 2]
    assert ids(matching(docs, q.Range("v", gte=0, lte=6, relation="within")), "id") == [1]


def test_match_column_is_never_null(spark):
    docs = spark.createDataFrame([(1,), (None,)], "v int")
    values = [r[0] for r in docs.select(match_column(docs, q.Term("v", 1))).collect()]
    assert values == [True, False]


@pytest.mark.parametrize("transpositions", [False, True])
@pytest.mark.parametrize("k", [1, 2, 3])
def test_fuzzy_against_brute_force(spark, k, transpositions):
    import random

    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    docs = spark.createDataFrame([(w,) for w in sorted(set(words))], "text string")
    for term in ("abca", "aab", "bcabc"):
        wanted = {w for w in words if distance(w, term, transpositions) <= k}
        query = q.Match("text", term, fuzziness=k, transpositions=transpositions)
        assert set(ids(matching(docs, query, TEXT), "text")) == wanted, term


def distance(a, b, transpositions):
    rows = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(
                rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1])
            )
            if transpositions and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


def test_fuzziness_auto():
    assert [analysis.auto_fuzziness(t) for t in ("ab", "abc", "abcde", "abcdef")] == [0, 1, 1, 2]


def test_function_score_missing_field_uses_default(spark):
    docs = spark.createDataFrame([(1, 4.0), (2, None)], "id int, v double")
    query = q.FunctionScore(q.MatchAll(), q.FieldValueFactor("v", 2.0, "sqrt", 8.0), boost_mode="sum", boost=3.0)
    found = {r["id"]: r["_score"] for r in scored(docs, query).collect()}
    assert found == {1: pytest.approx(3 + 8 ** 0.5), 2: pytest.approx(3 + 4.0)}


def test_analyzers(spark):
    df = spark.createDataFrame([("Foo-Bar  éÀ 12",)], "t string")
    row = df.select(*[analysis.tokens(F.col("t"), a).alias(a) for a in analysis.ANALYZERS]).first()
    for a in analysis.ANALYZERS:
        assert row[a] == analysis.analyze("Foo-Bar  éÀ 12", a)
    assert row["standard"] == ["foo", "bar", "éà", "12"]
