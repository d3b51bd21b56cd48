"""Children of documents: lines inside a document, line items in a table of their own."""

from pyspark.sql import functions as F

from ..operators import nested_tables
from ..operators import queries as q
from ..operators.compile import matching, scored
from ..operators.highlight import Highlight
from ..plans.search import Collection
from .base import bm25_sql, prepared, query, table, tokens_sql

_LINE_FIELDS = {"lines.line": "standard"}


def documents_with_lines(spark, folder):
    """Each document with its lines as nested children, made row by row."""
    docs = table(spark, folder, "documents")
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(i.alias("no"), line.alias("line"), F.length(line).alias("size")),
    )
    return docs.select("doc_id", "lang", lines.alias("lines"))


def indexed_lines(spark, folder):
    """The same with the tokens of all lines stored beside them, and an index of the lines."""
    return prepared(spark, folder, Collection(documents_with_lines(spark, folder), "doc_id", _LINE_FIELDS), "lines")


def _scored_lines(spark, folder, wanted):
    lines = indexed_lines(spark, folder)
    return scored(lines.docs, wanted, lines.text_fields, lines.index)


_LINES = """lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
        FROM documents)"""

_LINE_QUERY = q.Bool.of(must=[q.Match("lines.line", "thtion")], filter=[q.Range("lines.size", gte=200)])


@query(
    "nested_exists",
    f"""WITH {_LINES} SELECT DISTINCT doc_id FROM lines
        WHERE length(line) >= 200 AND list_contains({tokens_sql('line')}, 'thtion')""",
)
def nested_exists(spark, folder):
    wanted = q.Nested("lines", _LINE_QUERY)
    lines = indexed_lines(spark, folder)
    return matching(lines.docs, wanted, lines.text_fields, lines.index).select("doc_id")


@query(
    "nested_exists_unprepared",
    f"""WITH {_LINES} SELECT DISTINCT doc_id FROM lines
        WHERE length(line) >= 200 AND list_contains({tokens_sql('line')}, 'thtion')""",
)
def nested_exists_unprepared(spark, folder):
    wanted = q.Nested("lines", _LINE_QUERY)
    return matching(documents_with_lines(spark, folder), wanted, _LINE_FIELDS).select("doc_id")


@query(
    "nested_not_exists",
    f"""WITH {_LINES} SELECT doc_id FROM documents WHERE doc_id NOT IN (
            SELECT doc_id FROM lines WHERE length(line) >= 200 AND list_contains({tokens_sql('line')}, 'thtion'))""",
)
def nested_not_exists(spark, folder):
    wanted = q.Bool.of(must_not=[q.Nested("lines", _LINE_QUERY)])
    return matching(documents_with_lines(spark, folder), wanted, _LINE_FIELDS).select("doc_id")


_LINE_SCORES = f"""{_LINES},
    toks AS (SELECT *, {tokens_sql('line')} AS t FROM lines),
    size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
    tf AS (SELECT doc_id, no, line, len(t) AS dl, len(list_filter(t, lambda x: x = 'thtion')) AS tf FROM toks),
    df AS (SELECT count(*) FILTER (tf > 0) AS df FROM tf),
    sc AS (SELECT doc_id, no, line, {bm25_sql('tf', 'df')} AS s FROM tf, df, size
           WHERE tf > 0 AND length(line) >= 200)"""


def _register_score_mode(mode: str, expression: str) -> None:
    @query(
        f"nested_score_{mode}",
        f"WITH {_LINE_SCORES} SELECT doc_id, round({expression}, 6) AS score FROM sc GROUP BY doc_id",
    )
    def score_mode(spark, folder):
        wanted = q.Nested("lines", _LINE_QUERY, score_mode=mode)
        found = _scored_lines(spark, folder, wanted)
        return found.select("doc_id", F.round("_score", 6).alias("score"))


for _mode, _expression in {"sum": "sum(s)", "avg": "avg(s)", "min": "min(s)", "max": "max(s)", "none": "0::DOUBLE"}.items():
    _register_score_mode(_mode, _expression)


@query(
    "inner_hits",
    f"""WITH {_LINE_SCORES},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, no) AS r FROM sc)
        SELECT doc_id, no, line, round(s, 6) AS score FROM ranked WHERE r <= 3""",
)
def inner_hits(spark, folder):
    wanted = q.Nested("lines", _LINE_QUERY, inner_hits=q.InnerHits(fields=["line", "no"]))
    found = _scored_lines(spark, folder, wanted)
    hits = found.select("doc_id", F.explode("inner_hits.lines").alias("hit"))
    return hits.select("doc_id", F.col("hit.no").cast("long").alias("no"), "hit.line", F.round("hit._score", 6).alias("score"))


@query(
    "inner_hits_highlight",
    f"""WITH {_LINE_SCORES},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, no) AS r FROM sc)
        SELECT doc_id, no, array_to_string(list_transform(regexp_extract_all(line, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'),
               lambda x: CASE WHEN lower(x) = 'thtion' THEN '<b>' || x || '</b>' ELSE x END), '') AS marked
        FROM ranked WHERE r <= 2""",
)
def inner_hits_highlight(spark, folder):
    """The best lines of each document with the words of the query marked."""
    marks = Highlight()
    marks.add("lines.line", fragments=0, pre="<b>", post="</b>")
    wanted = q.Nested("lines", _LINE_QUERY, inner_hits=q.InnerHits(size=2, fields=["no"], highlight=marks))
    hits = _scored_lines(spark, folder, wanted).select("doc_id", F.explode("inner_hits.lines").alias("hit"))
    return hits.select("doc_id", F.col("hit.no").cast("long").alias("no"), F.col("hit.line_highlight")[0].alias("marked"))


# -- children in a table of their own ---------------------------------------------

_ITEM_QUERY = q.Bool.of(filter=[q.Range("l_quantity", gt=40), q.Term("l_returnflag", "R")])
_ITEM_WHERE = "l_quantity > 40 AND l_returnflag = 'R'"


def _tables(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return orders.select("l_orderkey", "o_orderpriority"), table(spark, folder, "lineitem")


@query(
    "children_semi",
    f"""SELECT o_orderkey AS l_orderkey, o_orderpriority FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {_ITEM_WHERE})""",
)
def children_semi(spark, folder):
    return nested_tables.with_matching_child(*_tables(spark, folder), "l_orderkey", _ITEM_QUERY)


@query(
    "children_anti",
    f"""SELECT o_orderkey AS l_orderkey, o_orderpriority FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE {_ITEM_WHERE})""",
)
def children_anti(spark, folder):
    return nested_tables.without_matching_child(*_tables(spark, folder), "l_orderkey", _ITEM_QUERY)


_ITEM_SCORE = q.FunctionScore(
    q.ConstantScore(_ITEM_QUERY), q.FieldValueFactor("l_quantity"), boost_mode="replace"
)


def _register_child_score(mode: str, expression: str) -> None:
    @query(
        f"children_score_{mode}",
        f"""SELECT l_orderkey, o_orderpriority, round({expression}, 6) AS score
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE {_ITEM_WHERE} GROUP BY ALL""",
    )
    def child_score(spark, folder):
        found = nested_tables.score_by_children(*_tables(spark, folder), "l_orderkey", _ITEM_SCORE, mode)
        return found.select("l_orderkey", "o_orderpriority", F.round("_score", 6).alias("score"))


for _mode, _expression in {
    "sum": "sum(l_quantity)", "avg": "avg(l_quantity)", "min": "min(l_quantity)", "max": "max(l_quantity)",
    "none": "0::DOUBLE",
}.items():
    _register_child_score(_mode, _expression)


@query(
    "children_inner_hits",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, r AS rank FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS r
            FROM lineitem WHERE {_ITEM_WHERE}) WHERE r <= 2""",
)
def children_inner_hits(spark, folder):
    found = nested_tables.inner_hits(
        table(spark, folder, "lineitem"), "l_orderkey", _ITEM_SCORE, ["l_linenumber", "l_partkey", "l_suppkey"], 2
    )
    return found.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("rank").cast("long").alias("rank")
    )
