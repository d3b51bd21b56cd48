import pytest
from pyspark.sql import functions as F

from docquarry.operators import queries as q
from docquarry.operators.highlight import Highlight
from docquarry.operators.suggest import suggest, suggest_batch
from docquarry.plans.search import Collection, SearchRequest, search

TEXT = {"text": "standard", "title": "standard"}
LONG = "One fish. Two fish! Red fish, blue fish. " + "Black fish and old fish and new fish. " * 3


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [("1", LONG, "Fish tales"), ("2", "Of mice and men", "Mice"), ("3", None, "Nothing")],
        "_id string, text string, title string",
    )


def marked(docs, wanted, field="text", key="1", **options):
    spec = Highlight()
    spec.add(field, **options)
    hits = search(Collection(docs, "_id", TEXT), SearchRequest(wanted, highlight=spec, export=True)).hits
    return {r["_id"]: r["highlight"] for r in hits.collect()}[key].get(field)


def test_whole_field(docs):
    assert marked(docs, q.Match("text", "red BLUE"), fragments=0) == [
        LONG.replace("Red", "<em>Red</em>").replace("blue", "<em>blue</em>")
    ]


def test_fragments_cover_the_text_in_order(docs):
    found = marked(docs, q.Match("text", "fish"), fragments=100, fragment_size=20, pre="", post="")
    assert "".join(found) in LONG and len(found) > 3
    assert len(marked(docs, q.Match("text", "fish"), fragments=2, fragment_size=20)) == 2


def test_order_by_score(docs):
    found = marked(docs, q.Match("text", "old new red"), fragments=1, fragment_size=40, order="score")
    assert found[0].count("<em>") >= 2


def test_phrases_mark_only_phrases(docs):
    found = marked(docs, q.MatchPhrase("text", "blue fish"), fragments=0)
    assert found == [LONG.replace("blue fish", "<em>blue</em> <em>fish</em>")]


def test_span_fragmenter_keeps_phrases_together(docs):
    query = q.MatchPhrase("text", "two fish")
    assert marked(docs, query, fragments=5, fragment_size=13) is None
    assert marked(docs, query, fragments=5, fragment_size=13, fragmenter="span") is not None


@pytest.mark.parametrize(
    "query,expected",
    [
        (q.Wildcard("text", "b*k"), {"Black"}),
        (q.MatchPhrase("text", "old fi", prefix=True), {"old", "fish"}),
        (q.Match("text", "blu", fuzziness=1), {"blue"}),
        (q.Bool.of(must=[q.Match("text", "red")], must_not=[q.Match("text", "zebra")]), {"Red"}),
    ],
)
def test_kinds_of_terms(docs, query, expected):
    import re

    found = marked(docs, query, fragments=0)
    assert set(re.findall("<em>(.*?)</em>", found[0])) == expected


def test_field_match_and_own_query(docs):
    query = q.Match("title", "fish")
    assert marked(docs, query) is None
    assert marked(docs, query, require_field_match=False)
    assert marked(docs, query, matched_fields=["ti*"])
    assert marked(docs, query, query=q.Match("text", "red"), fragments=0) == [LONG.replace("Red", "<em>Red</em>")]


def test_no_match_size_and_offset(docs):
    assert marked(docs, q.Match("title", "mice"), key="2", no_match_size=7) == ["Of mice"]
    assert marked(docs, q.Match("text", "mice"), key="2", fragments=0, fragment_offset=3) == ["<em>mice</em> and men"]


@pytest.mark.parametrize("scanner,end", [("sentence", ". "), ("word", "fish"), ("chars", "fish")])
def test_boundary_scanners(docs, scanner, end):
    found = marked(docs, q.Match("text", "red"), fragments=1, fragment_size=36, boundary_scanner=scanner, pre="[", post="]")
    assert found[0].endswith(end)


def test_styled_tags(docs):
    assert '<em class="hlt1">Red</em>' in marked(docs, q.Match("text", "red"), fragments=0, tags_schema="styled")[0]


def test_suggestions(spark):
    table = spark.createDataFrame(
        [("Apple", 3, "x", 1), ("apple", 5, "x", 2), ("Apricot", 9, "y", 3), ("Apple", 4, "y", 4), ("Pear", 9, "x", 5)],
        "name string, w int, cat string, extra int",
    )
    found = suggest(table, "name", "aP", "w", ["extra"]).collect()
    assert [(r["text"], r["weight"], r["extra"]) for r in found] == [("Apricot", 9, 3), ("apple", 5, 2), ("Apple", 4, 4)]
    only = suggest(table, "name", "a", "w", categories={"cat": ["x"]}).collect()
    assert [r["text"] for r in only] == ["apple", "Apple"]
    prefixes = spark.createDataFrame([(1, "Ap"), (2, "pear"), (3, ""), (4, "q")], "request_id int, prefix string")
    batch = suggest_batch(table, "name", prefixes, "w", size=2).orderBy("request_id", "rank").collect()
    assert [(r["request_id"], r["text"]) for r in batch] == [(1, "Apricot"), (1, "apple"), (2, "Pear"), (3, "Apricot"), (3, "Pear")]
