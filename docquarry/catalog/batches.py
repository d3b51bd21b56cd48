"""Many queries in one job, answered from the postings tables."""

from pyspark.sql import functions as F

from ..functions import analysis
from ..plans.batch import QueryStrings, batch_match, search_strings
from ..plans.requests import search_requests
from .base import bm25_sql, document_index, indexed_documents, query, table, tokens_sql

_POSTINGS = f"""
    toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
    size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
    every AS (SELECT doc_id, len(t) AS dl, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM toks),
    tf AS (SELECT doc_id, term, max(dl) AS dl, count(*) AS tf FROM every GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    sc AS (SELECT doc_id, term, {bm25_sql('tf', 'df')} AS s FROM tf JOIN df USING (term), size)"""


@query(
    "index_postings",
    f"""WITH {_POSTINGS} SELECT doc_id AS _id, term, tf, dl FROM tf""",
)
def index_postings(spark, folder):
    index = document_index(spark, folder)
    return index.postings.select("_id", "term", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"))


@query("index_term_stats", f"WITH {_POSTINGS} SELECT term, df FROM df")
def index_term_stats(spark, folder):
    return document_index(spark, folder).term_stats.select("term", "df")


@query("index_field_stats", f"WITH {_POSTINGS} SELECT n AS n_docs, round(avgdl, 6) AS avgdl FROM size")
def index_field_stats(spark, folder):
    stats = document_index(spark, folder).field_stats
    return stats.select("n_docs", F.round(F.col("sum_dl") / F.col("n_docs"), 6).alias("avgdl"))


# The queries of a batch are the texts of ``benchmark``, all of them and whole.
_BATCH = f"""{_POSTINGS},
    asked AS (SELECT item_id AS query_id, unnest({tokens_sql('text')}) AS term FROM benchmark),
    times AS (SELECT query_id, term, count(*) AS times FROM asked GROUP BY ALL)"""


@query(
    "batch_search",
    f"""WITH {_BATCH},
        total AS (SELECT query_id, doc_id, sum(s * times) AS s FROM times JOIN sc USING (term) GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id) AS rank
                   FROM total)
        SELECT query_id, rank, doc_id AS _id, round(s, 6) AS score FROM ranked WHERE rank <= 20""",
)
def batch_search(spark, folder):
    queries = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    found = batch_match(queries, document_index(spark, folder), "text", 20)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "_id", F.round("_score", 6).alias("score"))


@query(
    "batch_search_all_terms",
    f"""WITH {_BATCH},
        wanted AS (SELECT query_id, count(*) AS k FROM times GROUP BY query_id),
        total AS (SELECT query_id, doc_id, sum(s * times) AS s, count(*) AS k
                  FROM times JOIN sc USING (term) GROUP BY ALL),
        ranked AS (SELECT query_id, doc_id, s,
                          row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id) AS rank
                   FROM total JOIN wanted USING (query_id, k))
        SELECT query_id, rank, doc_id AS _id, round(s, 6) AS score FROM ranked WHERE rank <= 5""",
)
def batch_search_all_terms(spark, folder):
    queries = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    found = batch_match(queries, document_index(spark, folder), "text", 5, operator="and")
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "_id", F.round("_score", 6).alias("score"))


@query(
    "request_table",
    f"""WITH {_BATCH},
        wanted AS (SELECT item_id AS query_id, CASE item_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' END AS lang,
                          CASE item_id % 2 WHEN 0 THEN 'source' ELSE 'lang' END AS facet, 1.0 + item_id % 4 AS boost,
                          item_id % 5 = 0 AS every FROM benchmark),
        needed AS (SELECT query_id, count(*) AS k FROM times GROUP BY query_id),
        total AS (SELECT query_id, doc_id, sum(s * times) AS s, count(*) AS k FROM times JOIN sc USING (term) GROUP BY ALL),
        hits AS (SELECT query_id, doc_id, s * boost AS s, CASE facet WHEN 'source' THEN source ELSE d.lang END AS key
                 FROM total JOIN wanted w USING (query_id) JOIN needed n USING (query_id) JOIN documents d USING (doc_id)
                 WHERE (NOT every OR total.k = n.k) AND (w.lang IS NULL OR d.lang = w.lang)),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id) AS rank,
                          doc_id::VARCHAR AS key, round(s, 6) AS score FROM hits),
        counted AS (SELECT query_id, key, count(*) AS n FROM hits WHERE key IS NOT NULL GROUP BY ALL),
        facets AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, key) AS rank, key, n::DOUBLE AS score
                   FROM counted),
        totals AS (SELECT w.query_id, count(doc_id) AS n FROM wanted w LEFT JOIN hits h ON h.query_id = w.query_id GROUP BY ALL)
        SELECT query_id, 'hit' AS part, rank, key, score FROM ranked WHERE rank <= 10
        UNION ALL SELECT query_id, 'facet', rank, key, score FROM facets WHERE rank <= 3
        UNION ALL SELECT query_id, 'total', 0, NULL, n::DOUBLE FROM totals""",
)
def request_table(spark, folder):
    """Every benchmark text as a request with an operator, a boost, a filter and a facet of its own."""
    item = F.col("item_id")
    lang = F.when(item % 3 == 0, "en").when(item % 3 == 1, "de")
    requests = table(spark, folder, "benchmark").select(
        item.alias("query_id"), F.col("text").alias("query"),
        F.create_map(F.lit("text"), (1 + item % 4).cast("double")).alias("boosts"),
        F.when(item % 5 == 0, "and").alias("operator"),
        F.when(lang.isNotNull(), F.create_map(F.lit("lang"), lang)).alias("filters"),
        F.when(item % 2 == 0, "source").otherwise("lang").alias("facet"),
    )
    found = search_requests(requests, indexed_documents(spark, folder), ["lang"], ["source", "lang"], 10, 3)
    rank = F.col("rank").cast("long").alias("rank")
    hits = found.hits.select("query_id", F.lit("hit").alias("part"), rank, F.col("_id").cast("string").alias("key"), F.round("_score", 6).alias("score"))
    facets = found.facets.select("query_id", F.lit("facet").alias("part"), rank, "key", F.col("count").cast("double").alias("score"))
    totals = found.totals.select(
        "query_id", F.lit("total").alias("part"), F.lit(0).cast("long").alias("rank"), F.lit(None).cast("string").alias("key"),
        F.col("total").cast("double").alias("score"))
    return hits.unionByName(facets).unionByName(totals)


# -- query strings --------------------------------------------------------------------
# Each benchmark text is cut into runs of four words, the last one filled up from the
# text's beginning, and every run gives one string.  So all words of all texts are used.

def _runs(spark, folder):
    words = analysis.tokens(F.col("text"))
    rows = table(spark, folder, "benchmark").select("item_id", words.alias("all")).filter(F.size("all") > 0)
    rows = rows.select("item_id", "all", F.explode(F.sequence(F.lit(0), F.size("all") - 1, F.lit(4))).alias("at"))
    four = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.get("all", (F.col("at") + j) % F.size("all")))
    return rows.select(F.concat_ws("-", "item_id", "at").alias("query_id"), four.alias("w"))


def _asked(spark, folder, build):
    """One string per run, made by ``build`` from its four words."""
    w = [F.col("w")[i] for i in range(4)]
    return _runs(spark, folder).select("query_id", F.concat(*[F.lit(x) if isinstance(x, str) else x for x in build(w)]).alias("query"))


def _string_result(found):
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "_id", F.round("_score", 6).alias("score"))


_FIRST = f"""{_POSTINGS},
    parts AS (SELECT item_id, {tokens_sql('text')} AS w FROM benchmark),
    runs AS (SELECT item_id, w, unnest(range(0, len(w), 4)) AS i FROM parts WHERE len(w) > 0),
    asked AS (SELECT item_id || '-' || i AS query_id, w[1 + i] AS a, w[1 + (i + 1) % len(w)] AS b,
                     w[1 + (i + 2) % len(w)] AS c, w[1 + (i + 3) % len(w)] AS d FROM runs)"""

_RANKED = """ranked AS (SELECT query_id, doc_id, s,
                     row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, doc_id) AS rank FROM total)
        SELECT query_id, rank, doc_id AS _id, round(s, 6) AS score FROM ranked WHERE rank <= 10"""


@query(
    "query_strings",
    f"""WITH {_FIRST},
        must AS (SELECT query_id, doc_id, s FROM asked JOIN sc ON term = a),
        should AS (SELECT query_id, doc_id, 2 * s AS s FROM asked JOIN sc ON term = b),
        must_not AS (SELECT query_id, doc_id FROM asked JOIN sc ON term = c),
        more AS (SELECT query_id, doc_id, s FROM asked JOIN sc ON term = d),
        total AS (SELECT query_id, doc_id, m.s + coalesce(o.s, 0) + coalesce(p.s, 0) AS s
                  FROM must m LEFT JOIN should o USING (query_id, doc_id) LEFT JOIN more p USING (query_id, doc_id)
                  ANTI JOIN must_not USING (query_id, doc_id)),
        {_RANKED}""",
)
def query_strings(spark, folder):
    """Required, optional (one boosted) and excluded words."""
    strings = _asked(spark, folder, lambda w: ("+", w[0], " ", w[1], "^2 -", w[2], " ", w[3]))
    return _string_result(search_strings(strings, document_index(spark, folder), QueryStrings(["text"])))


@query(
    "query_strings_phrase",
    f"""WITH {_FIRST},
        phrases AS (SELECT query_id, 1 AS k, a AS x, b AS y FROM asked UNION ALL SELECT query_id, 2, c, d FROM asked),
        pairs AS (SELECT query_id, k, p.doc_id, max(p.dl) AS dl, count(*) AS tf
                  FROM phrases JOIN every p ON p.term = x JOIN every r ON r.doc_id = p.doc_id AND r.pos = p.pos + 1 AND r.term = y
                  GROUP BY ALL),
        weight AS (SELECT query_id, k, ln(1 + (n - p.df + 0.5) / (p.df + 0.5)) + ln(1 + (n - r.df + 0.5) / (r.df + 0.5)) AS w
                   FROM phrases JOIN df p ON p.term = x JOIN df r ON r.term = y, size),
        total AS (SELECT query_id, doc_id, sum(2.2 * w * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS s
                  FROM pairs JOIN weight USING (query_id, k), size GROUP BY ALL),
        {_RANKED}""",
)
def query_strings_phrase(spark, folder):
    """One phrase or another, with the field named for the first."""
    strings = _asked(spark, folder, lambda w: ('text:"', w[0], " ", w[1], '" OR "', w[2], " ", w[3], '"'))
    return _string_result(search_strings(strings, document_index(spark, folder), QueryStrings(["text"])))


def _classes_sql(condition: str, form: str = "{}") -> str:
    """Each of the four words stands for the terms under a condition on ``w`` and ``term`` and on
    forms of the two, ``x`` and ``y``."""
    return f"""
        words AS (SELECT query_id, unnest([1, 2, 3, 4]) AS i, unnest([a, b, c, d]) AS w FROM asked),
        covered AS (SELECT w, term FROM (SELECT DISTINCT w, {form.format('w')} AS x FROM words)
                    JOIN (SELECT term, {form.format('term')} AS y FROM df) ON {condition}),
        hits AS (SELECT w, doc_id, max(dl) AS dl, sum(tf) AS tf FROM covered JOIN tf USING (term) GROUP BY ALL),
        freq AS (SELECT w, count(*) AS df FROM hits GROUP BY w),
        scores AS (SELECT w, doc_id, {bm25_sql('tf', 'df')} AS s FROM hits JOIN freq USING (w), size),
        total AS (SELECT query_id, doc_id, sum(s) AS s FROM words JOIN scores USING (w) GROUP BY ALL)"""


@query("query_strings_prefix", f"WITH {_FIRST}, {_classes_sql('starts_with(term, substr(w, 1, 3))')}, {_RANKED}")
def query_strings_prefix(spark, folder):
    """The first three letters of every word as a prefix."""
    strings = _asked(
        spark, folder, lambda w: [x for v in w for x in (F.substring(v, 1, 3), "* ")]
    )
    return _string_result(search_strings(strings, document_index(spark, folder), QueryStrings(["text"])))


@query(
    "query_strings_simple",
    f"""WITH {_FIRST},
        words AS (SELECT query_id, unnest([a, b, c]) AS term, unnest([1, 2, 3]) AS i FROM asked),
        must AS (SELECT query_id, doc_id, sum(3 * s) AS s FROM words JOIN sc USING (term)
                 GROUP BY ALL HAVING count(*) = 3),
        must_not AS (SELECT query_id, doc_id FROM asked JOIN sc ON term = d),
        total AS (SELECT * FROM must ANTI JOIN must_not USING (query_id, doc_id)),
        {_RANKED}""",
)
def query_strings_simple(spark, folder):
    """The simple syntax: ``a + b* + c -d``, the prefix operator switched off."""
    strings = _asked(spark, folder, lambda w: (w[0], " + ", w[1], "* + ", w[2], " -", w[3]))
    spec = QueryStrings(["text"], [3.0], syntax="simple", flags=["AND", "NOT", "WHITESPACE"])
    return _string_result(search_strings(strings, document_index(spark, folder), spec))


# The letters of the texts beyond ASCII.  The SQL distance counts bytes, so each
# becomes one capital letter, which no lower-cased word has.
_LETTERS = "àáâäçèéêëìíîïñòóôöùúûüýÿßœ"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ONE_BYTE = f"translate({{}}, '{_LETTERS}', '{_CAPITALS}')"
_NEAR = "abs(length(x) - length(y)) <= 1 AND levenshtein(x, y) <= 1"


@query("query_strings_fuzzy", f"WITH {_FIRST}, {_classes_sql(_NEAR, _ONE_BYTE)}, {_RANKED}")
def query_strings_fuzzy(spark, folder):
    """Every word with at most one edit."""
    strings = _asked(spark, folder, lambda w: [x for v in w for x in (v, "~1 ")])
    return _string_result(search_strings(strings, document_index(spark, folder), QueryStrings(["text"])))


@query("query_strings_sloppy")
def query_strings_sloppy(spark, folder):
    """Phrases with gaps; checked against the single-query form by a test."""
    strings = _asked(spark, folder, lambda w: ('"', w[0], " ", w[1], " ", w[2], " ", w[3], '"~4'))
    return _string_result(search_strings(strings, document_index(spark, folder), QueryStrings(["text"])))


@query(
    "query_strings_all",
    f"""WITH {_POSTINGS}, numbers AS (SELECT doc_id FROM documents),
        nots AS (SELECT DISTINCT doc_id FROM tf WHERE term = 'the')
        SELECT 'all' AS query_id, doc_id AS _id, 1.0 AS score FROM numbers
        UNION ALL SELECT 'not', doc_id, 0.0 FROM numbers ANTI JOIN nots USING (doc_id)""",
)
def query_strings_all(spark, folder):
    """``*`` and a purely negative string: every document counts, also one without words."""
    strings = spark.createDataFrame([("all", "*"), ("not", "-the")], "query_id string, query string")
    found = search_strings(strings, document_index(spark, folder), QueryStrings(["text"]), None)
    return found.select("query_id", "_id", F.round("_score", 6).alias("score"))
