"""Facets: terms, maxima, top hits, significant terms, at any depth."""

from pyspark.sql import functions as F

from ..operators import queries as q
from ..operators.aggregations import (
    MaxOf,
    Order,
    SignificantTerms,
    StatsOf,
    TermsFacet,
    TopHits,
    field_terms,
)
from ..operators.compile import scored
from ..plans.search import Collection, SearchRequest, search
from .base import documents, indexed_documents, query, table, term_scores_sql, tokens_sql


def _facets(collection, requests, wanted=None):
    request = SearchRequest(wanted or q.MatchAll(), rows=0, aggregations=requests)
    return search(collection, request).aggregations


def _orders(spark, folder):
    return Collection(table(spark, folder, "orders"), "o_orderkey")


@query("facet_terms", "SELECT lang AS term, count(*) AS doc_count FROM documents GROUP BY lang")
def facet_terms(spark, folder):
    return _facets(documents(spark, folder), [TermsFacet("langs", "lang")])["langs"]


@query(
    "facet_size_by_term",
    "SELECT source AS term, count(*) AS doc_count FROM documents GROUP BY source ORDER BY term LIMIT 5",
)
def facet_size_by_term(spark, folder):
    facet = TermsFacet("sources", "source", size=5, order=[Order("term", descending=False)])
    return _facets(documents(spark, folder), [facet])["sources"]


@query(
    "facet_numeric_top",
    """SELECT user_id AS term, count(*) AS doc_count FROM events WHERE event_type = 'click'
       GROUP BY user_id ORDER BY doc_count DESC, term LIMIT 10""",
)
def facet_numeric_top(spark, folder):
    collection = Collection(table(spark, folder, "events"), "event_id")
    return _facets(collection, [TermsFacet("users", "user_id")], q.Term("event_type", "click"))["users"]


@query(
    "facet_multivalued",
    "SELECT role AS term, count(DISTINCT conv_id) AS doc_count FROM conversations GROUP BY role",
)
def facet_multivalued(spark, folder):
    # A set of roles per conversation; it never holds more than the distinct roles.
    turns = table(spark, folder, "conversations")
    docs = turns.groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return _facets(Collection(docs, "conv_id"), [TermsFacet("roles", "roles")])["roles"]


@query(
    "facet_text_terms",
    f"""SELECT term, count(*) AS doc_count
        FROM (SELECT doc_id, unnest(list_distinct({tokens_sql('text')})) AS term FROM documents)
        GROUP BY term ORDER BY doc_count DESC, term LIMIT 25""",
)
def facet_text_terms(spark, folder):
    return _facets(indexed_documents(spark, folder), [TermsFacet("words", "text", size=25)])["words"]


@query(
    "facet_include_regex",
    """SELECT source AS term, count(*) AS doc_count FROM documents
       WHERE regexp_full_match(source, 'src1.*') AND NOT regexp_full_match(source, '.*[57]') GROUP BY source""",
)
def facet_include_regex(spark, folder):
    facet = TermsFacet("sources", "source", size=100, include="src1.*", exclude=".*[57]")
    return _facets(documents(spark, folder), [facet])["sources"]


@query(
    "facet_exclude_set",
    """SELECT source AS term, count(*) AS doc_count FROM documents
       WHERE source IN ('src1', 'src2', 'src3') AND source NOT IN ('src2', 'nowhere') GROUP BY source""",
)
def facet_exclude_set(spark, folder):
    facet = TermsFacet("sources", "source", include={"src1", "src2", "src3"}, exclude=("src2", "nowhere"))
    return _facets(documents(spark, folder), [facet])["sources"]


@query(
    "facet_mixed_selection",
    """SELECT source AS term, count(*) AS doc_count FROM documents
       WHERE regexp_full_match(source, 'src.') AND source NOT IN ('src2') GROUP BY source""",
)
def facet_mixed_selection(spark, folder):
    facet = TermsFacet("sources", "source", size=50, include="src.", exclude=["src2"])
    return _facets(documents(spark, folder), [facet])["sources"]


@query(
    "facet_order_submax",
    """SELECT o_custkey AS term, count(*) AS doc_count FROM orders GROUP BY o_custkey
       ORDER BY max(o_totalprice) DESC, o_custkey LIMIT 20""",
)
def facet_order_submax(spark, folder):
    facet = TermsFacet(
        "customers", "o_custkey", size=20, order=[Order("price")], sub=[MaxOf("price", "o_totalprice")]
    )
    return _facets(_orders(spark, folder), [facet])["customers"]


@query(
    "facet_order_multi",
    """SELECT l_suppkey AS term, count(*) AS doc_count FROM lineitem GROUP BY l_suppkey
       ORDER BY min(l_quantity), max(l_quantity) DESC, avg(l_quantity) DESC, l_suppkey LIMIT 15""",
)
def facet_order_multi(spark, folder):
    facet = TermsFacet(
        "suppliers",
        "l_suppkey",
        size=15,
        order=[Order("quantity", False, "min"), Order("quantity", True, "max"), Order("quantity", True, "avg")],
        sub=[StatsOf("quantity", "l_quantity")],
    )
    return _facets(Collection(table(spark, folder, "lineitem"), "l_orderkey"), [facet])["suppliers"]


@query(
    "facet_order_compound",
    """SELECT o_custkey AS term, count(*) AS doc_count FROM orders GROUP BY o_custkey
       ORDER BY doc_count, o_custkey DESC LIMIT 12""",
)
def facet_order_compound(spark, folder):
    facet = TermsFacet("customers", "o_custkey", size=12, order=[Order("count", False), Order("term", True)])
    return _facets(_orders(spark, folder), [facet])["customers"]


_TOP_CUSTOMERS = """top AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey
                            ORDER BY n DESC, o_custkey LIMIT 10)"""


def _customer_tree(spark, folder):
    tree = TermsFacet(
        "customers",
        "o_custkey",
        sub=[
            TermsFacet(
                "priorities",
                "o_orderpriority",
                size=2,
                sub=[MaxOf("dearest", "o_totalprice"), TermsFacet("states", "o_orderstatus", size=1)],
            ),
            MaxOf("dearest", "o_totalprice"),
            TopHits("examples", include=["o_total*", "o_orderdate"], exclude=["o_orderdate"], size=2),
        ],
    )
    wanted = q.FunctionScore(q.MatchAll(), q.FieldValueFactor("o_totalprice"), boost_mode="replace")
    return _facets(_orders(spark, folder), [tree], wanted)


_TOP_PRIORITIES = f"""{_TOP_CUSTOMERS},
    second AS (SELECT o_custkey, o_orderpriority, count(*) AS n, max(o_totalprice) AS dearest
               FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top) GROUP BY ALL),
    kept AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM second)"""


@query(
    "facet_nested",
    f"""WITH {_TOP_PRIORITIES}
        SELECT o_custkey AS parent_1, o_orderpriority AS term, n AS doc_count FROM kept WHERE r <= 2""",
)
def facet_nested(spark, folder):
    return _customer_tree(spark, folder)["customers.priorities"]


@query(
    "facet_nested_max",
    f"""WITH {_TOP_PRIORITIES}
        SELECT o_custkey AS parent_1, o_orderpriority AS parent_2, dearest AS max FROM kept WHERE r <= 2""",
)
def facet_nested_max(spark, folder):
    return _customer_tree(spark, folder)["customers.priorities.dearest"]


@query(
    "facet_three_levels",
    f"""WITH {_TOP_PRIORITIES},
        third AS (SELECT o_custkey, o_orderpriority, o_orderstatus, count(*) AS n FROM orders
                  JOIN (SELECT o_custkey, o_orderpriority FROM kept WHERE r <= 2) USING (o_custkey, o_orderpriority)
                  GROUP BY ALL),
        best AS (SELECT *, row_number() OVER (
                     PARTITION BY o_custkey, o_orderpriority ORDER BY n DESC, o_orderstatus) AS r FROM third)
        SELECT o_custkey AS parent_1, o_orderpriority AS parent_2, o_orderstatus AS term, n AS doc_count
        FROM best WHERE r = 1""",
)
def facet_three_levels(spark, folder):
    return _customer_tree(spark, folder)["customers.priorities.states"]


@query(
    "facet_top_hits",
    f"""WITH {_TOP_CUSTOMERS},
        best AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
                 FROM orders JOIN top USING (o_custkey))
        SELECT o_custkey AS parent_1, o_orderkey, o_totalprice, rank, n AS total FROM best WHERE rank <= 2""",
)
def facet_top_hits(spark, folder):
    found = _customer_tree(spark, folder)["customers.examples"]
    return found.drop("_score").withColumn("rank", F.col("rank").cast("long"))


@query("max_field", "SELECT max(l_extendedprice) AS max FROM lineitem WHERE l_returnflag = 'R'")
def max_field(spark, folder):
    collection = Collection(table(spark, folder, "lineitem"), "l_orderkey")
    return _facets(collection, [MaxOf("price", "l_extendedprice")], q.Term("l_returnflag", "R"))["price"]


@query("max_script", "SELECT round(max(l_extendedprice * (1 - l_discount)), 6) AS max FROM lineitem")
def max_script(spark, folder):
    collection = Collection(table(spark, folder, "lineitem"), "l_orderkey")
    found = _facets(collection, [MaxOf("revenue", script="l_extendedprice * (1 - l_discount)")])["revenue"]
    return found.select(F.round("max", 6).alias("max"))


@query(
    "max_score",
    f"""WITH {term_scores_sql(['thtion', 'ention'])}, total AS (SELECT doc_id, sum(s) AS s FROM sc GROUP BY doc_id)
        SELECT round(max(s), 6) AS max FROM total""",
)
def max_score(spark, folder):
    found = _facets(indexed_documents(spark, folder), [MaxOf("best", script="_score")], q.Match("text", "thtion ention"))
    return found["best"].select(F.round("max", 6).alias("max"))


@query(
    "top_hits",
    """SELECT event_type AS parent_1, event_id, user_id, value, rank, total FROM (
           SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank,
                  count(*) OVER (PARTITION BY event_type) AS total FROM events) WHERE rank <= 3""",
)
def top_hits(spark, folder):
    tree = TermsFacet("types", "event_type", sub=[TopHits("best", include=["user_id", "value"])])
    wanted = q.FunctionScore(q.MatchAll(), q.FieldValueFactor("value"), boost_mode="replace")
    found = _facets(Collection(table(spark, folder, "events"), "event_id"), [tree], wanted)["types.best"]
    return found.drop("_score").withColumn("rank", F.col("rank").cast("long"))


@query(
    "top_hits_all",
    """SELECT event_id, event_type, value, row_number() OVER (ORDER BY value DESC, event_id) AS rank,
              (SELECT count(*) FROM events WHERE event_type = 'view') AS total
       FROM events WHERE event_type = 'view' ORDER BY rank LIMIT 3""",
)
def top_hits_all(spark, folder):
    wanted = q.FunctionScore(q.Term("event_type", "view"), q.FieldValueFactor("value"), boost_mode="replace")
    found = _facets(
        Collection(table(spark, folder, "events"), "event_id"),
        [TopHits("best", include=["event_type", "value"])],
        wanted,
    )["best"]
    return found.drop("_score").withColumn("rank", F.col("rank").cast("long"))


_SIGNIFICANT = f"""WITH words AS (SELECT doc_id, lang, unnest(list_distinct({tokens_sql('text')})) AS term FROM documents),
    counts AS (SELECT term, count(*) FILTER (lang = 'de') AS fg, count(*) AS bg FROM words GROUP BY term),
    size AS (SELECT count(*) FILTER (lang = 'de') AS n_fg, count(*) AS n_bg FROM documents),
    shares AS (SELECT term, fg, bg, fg / n_fg AS f, bg / n_bg AS b FROM counts, size WHERE fg >= 3)
    SELECT term, fg AS doc_count, bg AS bg_count, round((f - b) * (f / b), 6) AS score FROM shares WHERE f > b
    ORDER BY round((f - b) * (f / b), 12) DESC, term LIMIT 10"""


@query("significant_terms", _SIGNIFICANT)
def significant_terms(spark, folder):
    found = _facets(documents(spark, folder), [SignificantTerms("typical", "text")], q.Term("lang", "de"))["typical"]
    return found.withColumn("score", F.round("score", 6))


@query("significant_terms_indexed", _SIGNIFICANT)
def significant_terms_indexed(spark, folder):
    found = _facets(indexed_documents(spark, folder), [SignificantTerms("typical", "text")], q.Term("lang", "de"))["typical"]
    return found.withColumn("score", F.round("score", 6))


@query(
    "significant_per_bucket",
    """WITH counts AS (SELECT o_orderpriority AS parent_1, o_orderstatus AS term, count(*) AS fg FROM orders GROUP BY ALL),
        parents AS (SELECT parent_1, sum(fg) AS n_fg FROM counts GROUP BY ALL),
        background AS (SELECT term, sum(fg) AS bg FROM counts GROUP BY ALL),
        shares AS (SELECT *, fg / n_fg AS f, bg / (SELECT count(*) FROM orders) AS b
                   FROM counts JOIN parents USING (parent_1) JOIN background USING (term))
        SELECT parent_1, term, fg AS doc_count, bg::BIGINT AS bg_count, round((f - b) * (f / b), 6) AS score
        FROM shares WHERE f > b""",
)
def significant_per_bucket(spark, folder):
    tree = TermsFacet("priorities", "o_orderpriority", sub=[SignificantTerms("typical", "o_orderstatus")])
    found = _facets(_orders(spark, folder), [tree])["priorities.typical"]
    return found.withColumn("score", F.round("score", 6))


@query(
    "field_terms",
    f"""WITH {term_scores_sql(['thtion', 'ention'])}, total AS (SELECT doc_id, sum(s) AS s FROM sc GROUP BY doc_id)
        SELECT source AS term, count(*) AS count, round(max(s), 6) AS max_doc_score
        FROM total JOIN documents USING (doc_id) GROUP BY source
        ORDER BY count DESC, round(max(s), 9), term LIMIT 8""",
)
def field_terms_query(spark, folder):
    docs = indexed_documents(spark, folder)
    matched = scored(docs.docs, q.Match("text", "thtion ention"), docs.text_fields, docs.index)
    found = field_terms(matched, "source", 8, [Order("count"), Order("doc_score", descending=False)])
    return found.withColumn("max_doc_score", F.round("max_doc_score", 6))


# -- several facets in one pass ---------------------------------------------------------

_TOGETHER = [
    TermsFacet("types", "event_type", sub=[
        MaxOf("most", "value"),
        TermsFacet("users", "user_id", size=2, order=[Order("spread", metric="avg")], sub=[StatsOf("spread", "value")]),
    ]),
    TermsFacet("users", "user_id", size=5, order=[Order("most"), Order("term", False)], sub=[MaxOf("most", "value")]),
    TermsFacet("some", "event_type", include="c.*|v.*", exclude=["view"]),
    MaxOf("most", "value"),
]


@query(
    "facets_one_pass",
    """WITH hits AS (SELECT * FROM events WHERE value >= 5),
        types AS (SELECT event_type, count(*) AS n, max(value) AS m FROM hits GROUP BY event_type ORDER BY n DESC, event_type LIMIT 10),
        pairs AS (SELECT event_type, user_id, count(*) AS n, avg(value) AS a, max(value) AS m,
                         row_number() OVER (PARTITION BY event_type ORDER BY avg(value) DESC, user_id) AS rank
                  FROM hits SEMI JOIN types USING (event_type) GROUP BY event_type, user_id),
        users AS (SELECT user_id, count(*) AS n, max(value) AS m FROM hits GROUP BY user_id ORDER BY m DESC, user_id LIMIT 5)
        SELECT 'types' AS facet, '' AS parent, event_type AS term, n AS doc_count, NULL::DOUBLE AS "max" FROM types
        UNION ALL SELECT 'types.most', event_type, '', NULL, m FROM types
        UNION ALL SELECT 'types.users', event_type, user_id::VARCHAR, n, NULL FROM pairs WHERE rank <= 2
        UNION ALL SELECT 'types.users.spread', event_type, user_id::VARCHAR, NULL, m FROM pairs WHERE rank <= 2
        UNION ALL SELECT 'users', '', user_id::VARCHAR, n, NULL FROM users
        UNION ALL SELECT 'users.most', user_id::VARCHAR, '', NULL, m FROM users
        UNION ALL SELECT 'some', '', event_type, count(*), NULL FROM hits
                  WHERE regexp_full_match(event_type, 'c.*|v.*') AND event_type <> 'view' GROUP BY event_type
        UNION ALL SELECT 'most', '', '', NULL, max(value) FROM hits""",
)
def facets_one_pass(spark, folder):
    """Four trees of facets and measures counted in one pass, told as one table."""
    collection = Collection(table(spark, folder, "events"), "event_id")
    request = SearchRequest(q.Range("value", gte=5), rows=0, aggregations=_TOGETHER, facets_together=True)
    found = search(collection, request).aggregations
    told = None
    for name, rows in found.items():
        inner = "term" if "term" in rows.columns else "parent_2" if "parent_2" in rows.columns else None
        part = rows.select(
            F.lit(name).alias("facet"),
            (F.col("parent_1").cast("string") if "parent_1" in rows.columns else F.lit("")).alias("parent"),
            (F.col(inner).cast("string") if inner else F.lit("")).alias("term"),
            (F.col("doc_count") if "doc_count" in rows.columns else F.lit(None).cast("long")).alias("doc_count"),
            (F.col("max") if "max" in rows.columns else F.lit(None).cast("double")).alias("max"),
        )
        told = part if told is None else told.unionByName(part)
    return told
