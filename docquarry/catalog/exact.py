"""Queries on exact values: terms, ranges, wildcards, boolean combinations."""

from pyspark.sql import functions as F

from ..operators import queries as q
from ..operators.compile import matching, scored
from ..operators.paging import Sort
from ..plans.search import Collection, SearchRequest, count, search
from .base import query, table

_EVENT_QUERY = q.Bool.of(
    must=[q.Terms("event_type", ["click", "purchase", "view"])],
    filter=[q.Range("value", gte=50)],
    must_not=[q.Term("user_id", 13)],
)
_EVENT_WHERE = "event_type IN ('click', 'purchase', 'view') AND value >= 50 AND user_id <> 13"


def events(spark, folder) -> Collection:
    return Collection(table(spark, folder, "events"), "event_id")


@query(
    "bool_filter_page",
    f"""SELECT event_id, event_type, user_id, value FROM events WHERE {_EVENT_WHERE}
        ORDER BY value DESC, event_id LIMIT 10 OFFSET 5""",
)
def bool_filter_page(spark, folder):
    request = SearchRequest(
        _EVENT_QUERY,
        start=5,
        rows=10,
        fields=["event_type", "user_id", "value"],
        sort=[Sort("value", descending=True), Sort("event_id")],
    )
    return search(events(spark, folder), request).hits.drop("_score")


@query(
    "bool_min_should",
    """SELECT event_id FROM events
       WHERE (event_type = 'click')::INT + (value >= 100)::INT + (user_id < 100)::INT >= 2""",
)
def bool_min_should(spark, folder):
    should = [q.Term("event_type", "click"), q.Range("value", gte=100), q.Range("user_id", lt=100)]
    found = matching(table(spark, folder, "events"), q.Bool.of(should=should, minimum_should_match=2))
    return found.select("event_id")


@query(
    "bool_min_should_percent",
    """SELECT event_id FROM events
       WHERE event_type <> 'error'
         AND (event_type = 'click')::INT + (value >= 100)::INT + (user_id < 100)::INT >= 2""",  # 60% of 3, rounded down, may miss
)
def bool_min_should_percent(spark, folder):
    should = [q.Term("event_type", "click"), q.Range("value", gte=100), q.Range("user_id", lt=100)]
    wanted = q.Bool.of(should=should, must_not=[q.Term("event_type", "error")], minimum_should_match="-60%")
    return matching(table(spark, folder, "events"), wanted).select("event_id")


@query("match_all_count", "SELECT count(*) AS count FROM lineitem")
def match_all_count(spark, folder):
    return count(Collection(table(spark, folder, "lineitem"), "l_orderkey"), q.MatchAll())


@query("filtered_count", f"SELECT count(*) AS count FROM events WHERE {_EVENT_WHERE}")
def filtered_count(spark, folder):
    return count(events(spark, folder), _EVENT_QUERY)


@query("unknown_field", "SELECT event_id, event_type FROM events WHERE false")
def unknown_field(spark, folder):
    request = SearchRequest(q.Term("doesnotexist", "anything"), fields=["event_type"])
    return search(events(spark, folder), request).hits.drop("_score")


@query(
    "term_keyword_score",
    """WITH n AS (SELECT count(event_type) AS n, count(*) FILTER (event_type = 'purchase') AS df FROM events)
       SELECT event_id, round(2 * ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS score
       FROM events, n WHERE event_type = 'purchase'""",
)
def term_keyword_score(spark, folder):
    found = scored(table(spark, folder, "events"), q.Term("event_type", "purchase", boost=2.0))
    return found.select("event_id", F.round("_score", 6).alias("score"))


@query(
    "terms_in",
    """SELECT o_orderkey, 1.5::DOUBLE AS score FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def terms_in(spark, folder):
    found = scored(table(spark, folder, "orders"), q.Terms("o_orderpriority", ["1-URGENT", "5-LOW"], boost=1.5))
    return found.select("o_orderkey", F.col("_score").alias("score"))


@query(
    "terms_semi",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_brand = 'Brand#7')""",
)
def terms_semi(spark, folder):
    from ..operators.term_tables import in_term_table

    wanted = matching(table(spark, folder, "part"), q.Term("p_brand", "Brand#7")).select("p_partkey")
    found = in_term_table(table(spark, folder, "lineitem"), "l_partkey", wanted, "p_partkey")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("wildcard_prefix", "SELECT doc_id, source FROM documents WHERE source LIKE 'src1%'")
def wildcard_prefix(spark, folder):
    return matching(table(spark, folder, "documents"), q.Wildcard("source", "src1*")).select("doc_id", "source")


@query("wildcard_pattern", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%d _i%t'")
def wildcard_pattern(spark, folder):
    return matching(table(spark, folder, "part"), q.Wildcard("p_name", "*d ?i*t")).select("p_partkey", "p_name")


@query(
    "range_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
       WHERE l_quantity > 10 AND l_quantity <= 12 AND l_discount >= 0.05""",
)
def range_numeric(spark, folder):
    wanted = q.Bool.of(filter=[q.Range("l_quantity", gt=10, gte=5, lte=12), q.Range("l_discount", gte=0.05)])
    found = matching(table(spark, folder, "lineitem"), wanted)
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "range_date_tz",
    """SELECT event_id FROM events
       WHERE ts >= TIMESTAMP '2024-01-01 22:00:00' AND ts < TIMESTAMP '2024-01-03 22:00:00'""",
)
def range_date_tz(spark, folder):
    wanted = q.Range("ts", gte="02/01/2024", lt="04/01/2024", format="yyyy-MM-dd||dd/MM/yyyy", time_zone="+02:00")
    return matching(table(spark, folder, "events"), wanted).select("event_id")


@query(
    "range_relation",
    """WITH spans AS (SELECT o_orderkey, o_orderdate AS lo, o_orderdate + INTERVAL 90 DAY AS hi FROM orders)
       SELECT o_orderkey,
              lo <= TIMESTAMP '1997-06-30' AND hi >= TIMESTAMP '1997-01-01' AS intersects,
              lo >= TIMESTAMP '1997-01-01' AND hi <= TIMESTAMP '1997-06-30' AS within,
              lo <= TIMESTAMP '1997-01-01' AND hi >= TIMESTAMP '1997-01-15' AS contains
       FROM spans WHERE lo <= TIMESTAMP '1997-06-30' AND hi >= TIMESTAMP '1997-01-01'""",
)
def range_relation(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "valid",
        F.struct(
            F.col("o_orderdate").alias("gte"), (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("lte")
        ),
    )
    half_year = {"gte": "1997-01-01", "lte": "1997-06-30"}
    short = {"gte": "1997-01-01", "lte": "1997-01-15"}
    from ..operators.compile import match_column

    found = matching(orders, q.Range("valid", relation="intersects", **half_year))
    return found.select(
        "o_orderkey",
        match_column(orders, q.Range("valid", relation="intersects", **half_year)).alias("intersects"),
        match_column(orders, q.Range("valid", relation="within", **half_year)).alias("within"),
        match_column(orders, q.Range("valid", relation="contains", **short)).alias("contains"),
    )


@query(
    "must_not_keeps_missing",
    """SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality <> 1""",
)
def must_not_keeps_missing(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return matching(docs, q.Bool.of(must_not=[q.Term("quality", 1)])).select("doc_id")


@query(
    "post_filter_hits",
    """SELECT event_id, event_type, value FROM events WHERE value >= 200 AND event_type = 'click'
       ORDER BY value DESC, event_id LIMIT 20""",
)
def post_filter_hits(spark, folder):
    return _post_filtered(spark, folder).hits.drop("_score")


@query(
    "post_filter_total",
    """SELECT count(*) AS value, 'EQUAL_TO' AS relation FROM events WHERE value >= 200 AND event_type = 'click'""",
)
def post_filter_total(spark, folder):
    return _post_filtered(spark, folder).total


@query(
    "post_filter_facet",
    """SELECT event_type AS term, count(*) AS doc_count FROM events WHERE value >= 200 GROUP BY event_type""",
)
def post_filter_facet(spark, folder):
    return _post_filtered(spark, folder).aggregations["types"]


def _post_filtered(spark, folder):
    from ..operators.aggregations import TermsFacet

    request = SearchRequest(
        q.Range("value", gte=200),
        rows=20,
        fields=["event_type", "value"],
        sort=[Sort("value", descending=True)],
        post_filter=q.Term("event_type", "click"),
        aggregations=[TermsFacet("types", "event_type")],
    )
    return search(events(spark, folder), request)
