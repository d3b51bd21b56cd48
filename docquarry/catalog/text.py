"""Full-text queries with relevance: match, fuzzy, phrase, several fields."""

from pyspark.sql import functions as F

from ..operators import queries as q
from ..operators.compile import matching, scored
from ..plans.search import Collection, SearchRequest, search
from .base import bm25_sql, documents, indexed_documents, prepared, query, table, term_scores_sql, tokens_sql

_ANALYZED = {"text": "standard"}


def _scores(spark, folder, wanted):
    """Scores over the prepared documents: stored tokens, stored counts."""
    return _scores_in(indexed_documents(spark, folder), wanted)


def _scores_in(collection: Collection, wanted):
    found = scored(collection.docs, wanted, collection.text_fields, collection.index)
    return found.select(collection.id_col, F.round("_score", 6).alias("score"))


@query(
    "match_or",
    f"""WITH {term_scores_sql(['thtion', 'ention', 'queque'])}
        SELECT doc_id, round(sum(s), 6) AS score FROM sc GROUP BY doc_id""",
)
def match_or(spark, folder):
    return _scores(spark, folder, q.Match("text", "Thtion ention queque"))


@query(
    "match_unprepared",
    f"""WITH {term_scores_sql(['thtion', 'ention', 'queque'])}
        SELECT doc_id, round(sum(s), 6) AS score FROM sc GROUP BY doc_id""",
)
def match_unprepared(spark, folder):
    """As ``match_or``, but texts are analysed and counted within the query itself."""
    return _scores_in(documents(spark, folder), q.Match("text", "Thtion ention queque"))


@query(
    "match_or_top",
    f"""WITH {term_scores_sql(['thtion', 'ention'])}, total AS (SELECT doc_id, sum(s) AS s FROM sc GROUP BY doc_id)
        SELECT doc_id, lang, round(s, 6) AS score FROM total JOIN documents USING (doc_id)
        ORDER BY round(s, 9) DESC, doc_id LIMIT 10""",
)
def match_or_top(spark, folder):
    request = SearchRequest(q.Match("text", "thtion ention"), fields=["lang"])
    return search(indexed_documents(spark, folder), request).hits.select("doc_id", "lang", F.round("_score", 6).alias("score"))


@query(
    "match_or_top_cut",
    f"""WITH {term_scores_sql(['the', 'thtion', 'enlich'])}, total AS (SELECT doc_id, sum(s) AS s FROM sc GROUP BY doc_id)
        SELECT doc_id, lang, round(s, 6) AS score FROM total JOIN documents USING (doc_id)
        ORDER BY round(s, 9) DESC, doc_id LIMIT 10""",
)
def match_or_top_cut(spark, folder):
    """The best page in two rounds: what cannot enter it is neither joined nor scored."""
    request = SearchRequest(q.Match("text", "the thtion enlich"), fields=["lang"], least_postings=0)
    return search(indexed_documents(spark, folder), request).hits.select("doc_id", "lang", F.round("_score", 6).alias("score"))


@query(
    "match_and",
    f"""WITH {term_scores_sql(['the', 'attion', 'ertion'])}
        SELECT doc_id, round(2 * sum(s), 6) AS score FROM sc GROUP BY doc_id HAVING count(*) = 3""",
)
def match_and(spark, folder):
    return _scores(spark, folder, q.Match("text", "the attion ertion", operator="and", boost=2.0))


@query(
    "match_msm",
    f"""WITH {term_scores_sql(['thtion', 'attion', 'ertion', 'ontion'])}
        SELECT doc_id, round(sum(s), 6) AS score FROM sc GROUP BY doc_id HAVING count(*) >= 3""",
)
def match_msm(spark, folder):
    return _scores(spark, folder, q.Match("text", "thtion attion ertion ontion", minimum_should_match="75%"))


@query(
    "term_on_text",
    f"""WITH {term_scores_sql(['enlich'])} SELECT doc_id, round(s, 6) AS score FROM sc""",
)
def term_on_text(spark, folder):
    return _scores(spark, folder, q.Term("text", "enlich"))


@query(
    "constant_score",
    f"""SELECT doc_id, 3.5::DOUBLE AS score FROM documents WHERE list_contains({tokens_sql('text')}, 'enlich')""",
)
def constant_score(spark, folder):
    return _scores(spark, folder, q.ConstantScore(q.Match("text", "enlich"), boost=3.5))


@query(
    "bool_text_scores",
    f"""WITH {term_scores_sql(['thtion', 'attion', 'ertion'])},
        by_doc AS (
            SELECT doc_id,
                   max(CASE WHEN term = 'thtion' THEN s END) AS a,
                   max(CASE WHEN term = 'attion' THEN s END) AS b,
                   max(CASE WHEN term = 'ertion' THEN s END) AS c
            FROM sc GROUP BY doc_id)
        SELECT doc_id, round(a + coalesce(3 * b, 0), 6) AS score FROM by_doc JOIN documents USING (doc_id)
        WHERE a IS NOT NULL AND c IS NULL AND lang = 'en'""",
)
def bool_text_scores(spark, folder):
    wanted = q.Bool.of(
        must=[q.Match("text", "thtion")],
        should=[q.Match("text", "attion", boost=3.0)],
        must_not=[q.Match("text", "ertion")],
        filter=[q.Term("lang", "en")],
    )
    return _scores(spark, folder, wanted)


@query(
    "query_string_in_bool",
    f"""WITH {term_scores_sql(['thtion', 'attion', 'ertion', 'enlich'])},
        by_doc AS (SELECT doc_id, max(CASE WHEN term = 'thtion' THEN s END) AS a, max(CASE WHEN term = 'attion' THEN s END) AS b,
                          max(CASE WHEN term = 'ertion' THEN s END) AS c, max(CASE WHEN term = 'enlich' THEN s END) AS d
                   FROM sc GROUP BY doc_id)
        SELECT doc_id, round(2 * (a + coalesce(3 * b, 0)) + coalesce(d, 0), 6) AS score FROM by_doc JOIN documents USING (doc_id)
        WHERE a IS NOT NULL AND c IS NULL AND lang = 'en'""",
)
def query_string_in_bool(spark, folder):
    """A string is one part of a boolean query, beside a filter and another query."""
    wanted = q.Bool.of(
        must=[q.QueryString("+thtion attion^3 -ertion", ["te*"], boost=2.0)],
        should=[q.QueryString("enlich", ["text"], syntax="simple")],
        filter=[q.Term("lang", "en")],
    )
    return _scores(spark, folder, wanted)


@query(
    "dis_max",
    f"""WITH {term_scores_sql(['thtion', 'attion', 'queque'])}
        SELECT doc_id, round(max(s) + 0.3 * (sum(s) - max(s)), 6) AS score FROM sc GROUP BY doc_id""",
)
def dis_max(spark, folder):
    parts = [q.Match("text", t) for t in ("thtion", "attion", "queque")]
    return _scores(spark, folder, q.DisMax(parts, tie_breaker=0.3))


def _fuzzy_sql(distance: str, term: str, k: int) -> str:
    # The SQL distance counts bytes, so words with other letters are measured
    # with each such letter replaced by one byte that no query term contains.
    return f"""
    WITH toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
    size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
    words AS (SELECT doc_id, len(t) AS dl, unnest(t) AS w FROM toks),
    vocabulary AS (SELECT DISTINCT w FROM words),
    near AS (SELECT w FROM vocabulary WHERE {distance}(regexp_replace(w, '[^a-z0-9]', '_', 'g'), '{term}') <= {k}),
    tf AS (SELECT doc_id, max(dl) AS dl, count(*) AS tf FROM words WHERE w IN (SELECT w FROM near) GROUP BY doc_id),
    df AS (SELECT count(*) AS df FROM tf)
    SELECT doc_id, round({bm25_sql('tf', 'df')}, 6) AS score FROM tf, df, size"""


@query("match_fuzzy", _fuzzy_sql("levenshtein", "attion", 1))
def match_fuzzy(spark, folder):
    return _scores(spark, folder, q.Match("text", "attion", fuzziness=1))


@query("match_fuzzy_auto", _fuzzy_sql("levenshtein", "queque", 2))
def match_fuzzy_auto(spark, folder):
    return _scores(spark, folder, q.Match("text", "queque", fuzziness="auto"))


@query("match_fuzzy_transpose", _fuzzy_sql("damerau_levenshtein", "taht", 1))
def match_fuzzy_transpose(spark, folder):
    return _scores(spark, folder, q.Match("text", "taht", fuzziness=1, transpositions=True))


def _phrase_sql(terms: list[str]) -> str:
    joins = "".join(
        f" JOIN found a{j} ON a{j}.doc_id = a0.doc_id AND a{j}.w = '{t}' AND a{j}.pos = a0.pos + {j}"
        for j, t in enumerate(terms) if j
    )
    listed = ", ".join(f"'{t}'" for t in dict.fromkeys(terms))
    weight = " + ".join(
        f"(SELECT ln(1 + (n - df + 0.5) / (df + 0.5)) FROM df, size WHERE w = '{t}')" for t in terms
    )
    return f"""
    WITH toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
    size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
    every AS (SELECT doc_id, len(t) AS dl, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks),
    found AS (SELECT * FROM every WHERE w IN ({listed})),
    df AS (SELECT w, count(DISTINCT doc_id) AS df FROM found GROUP BY w),
    tf AS (SELECT a0.doc_id, max(a0.dl) AS dl, count(*) AS tf FROM found a0{joins} WHERE a0.w = '{terms[0]}'
           GROUP BY a0.doc_id)
    SELECT doc_id, round(2.2 * ({weight}) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score FROM tf, size"""


@query("phrase", _phrase_sql(["of", "the"]))
def phrase(spark, folder):
    return _scores(spark, folder, q.MatchPhrase("text", "Of the"))


@query("phrase_unprepared", _phrase_sql(["of", "the"]))
def phrase_unprepared(spark, folder):
    return _scores_in(documents(spark, folder), q.MatchPhrase("text", "Of the"))


@query("phrase_three", _phrase_sql(["in", "the", "of"]))
def phrase_three(spark, folder):
    return _scores(spark, folder, q.MatchPhrase("text", "in the of"))


@query(
    "phrase_slop",
    f"""WITH toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
        every AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks),
        a AS (SELECT doc_id, pos FROM every WHERE w = 'of'),
        b AS (SELECT doc_id, pos - 1 AS pos FROM every WHERE w = 'the')
        SELECT DISTINCT a.doc_id FROM a JOIN b ON a.doc_id = b.doc_id AND abs(a.pos - b.pos) <= 2""",
)
def phrase_slop(spark, folder):
    wanted = q.MatchPhrase("text", "of the", slop=2)
    collection = indexed_documents(spark, folder)
    return matching(collection.docs, wanted, _ANALYZED, collection.index).select("doc_id")


# Events of the sloppy count: each offset of one word, with the next offset of the
# other.  On a tie the first word of the phrase goes first.
@query(
    "phrase_slop_scores",
    f"""WITH toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
        size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
        every AS (SELECT doc_id, len(t) AS dl, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks),
        places AS (SELECT doc_id, dl, CASE w WHEN 'thtion' THEN 0 ELSE 1 END AS j,
                          pos - CASE w WHEN 'thtion' THEN 0 ELSE 1 END AS o
                   FROM every WHERE w IN ('thtion', 'the')),
        df AS (SELECT j, count(DISTINCT doc_id) AS df FROM places GROUP BY j),
        events AS (
            SELECT *,
                   min(CASE WHEN j = 1 THEN o END) OVER later AS next1,
                   min(CASE WHEN j = 0 THEN o END) OVER later AS next0
            FROM places
            WINDOW later AS (PARTITION BY doc_id ORDER BY o, j ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
        spans AS (SELECT doc_id, dl, CASE j WHEN 0 THEN next1 ELSE next0 END AS other,
                         CASE j WHEN 0 THEN next0 ELSE next1 END AS again, o FROM events),
        tf AS (SELECT doc_id, max(dl) AS dl, sum(1.0 / (1 + other - o)) AS tf FROM spans
               WHERE other - o <= 3 AND (again IS NULL OR again > other) GROUP BY doc_id)
        SELECT doc_id,
               round(2.2 * (SELECT sum(ln(1 + (n - df + 0.5) / (df + 0.5))) FROM df, size)
                     * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
        FROM tf, size""",
)
def phrase_slop_scores(spark, folder):
    return _scores(spark, folder, q.MatchPhrase("text", "thtion the", slop=3))


# -- several fields ----------------------------------------------------------------

# A page's address and its markup are two fields of very different length.
_PAGE_FIELDS = {"url": "standard", "html": "standard"}


def _fields_sql(terms: list[str], shared_df: bool = False) -> str:
    """CTEs ending in ``sc(page_id, field, term, s)``."""
    listed = ", ".join(f"'{t}'" for t in terms)
    df = (
        "(SELECT term, max(df) AS df FROM per_field GROUP BY term) USING (term)"
        if shared_df
        else "per_field USING (field, term)"
    )
    n = "(SELECT max(n) FROM size)" if shared_df else "n"
    return f"""
    toks AS (SELECT page_id, 'url' AS field, {tokens_sql('url')} AS t FROM pages
             UNION ALL SELECT page_id, 'html', {tokens_sql('html')} FROM pages),
    size AS (SELECT field, count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl
             FROM toks GROUP BY field),
    words AS (SELECT page_id, field, len(t) AS dl, unnest(t) AS term FROM toks),
    tf AS (SELECT page_id, field, term, max(dl) AS dl, count(*) AS tf FROM words WHERE term IN ({listed}) GROUP BY ALL),
    per_field AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
    sc AS (SELECT page_id, field, term,
                  2.2 * ln(1 + ({n} - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS s
           FROM tf JOIN {df} JOIN size USING (field))"""


_PER_FIELD = """by_field AS (SELECT page_id, field, sum(CASE field WHEN 'url' THEN 2 * s ELSE s END) AS s, count(*) AS k
                 FROM sc GROUP BY page_id, field)"""


def _multi(spark, folder, kind, text, operator="or", weights=(2.0, 1.0)):
    wanted = q.MultiMatch(text, ["url", "html"], list(weights), operator, kind)
    return _scores_in(prepared(spark, folder, pages(spark, folder), "pages"), wanted)


@query(
    "multi_match_best",
    f"""WITH {_fields_sql(['feed', 'example', 'attion'])}, {_PER_FIELD}
        SELECT page_id, round(max(s), 6) AS score FROM by_field GROUP BY page_id""",
)
def multi_match_best(spark, folder):
    return _multi(spark, folder, "best_fields", "feed example attion")


@query(
    "multi_match_best_and",
    f"""WITH {_fields_sql(['en', 'example'])}, {_PER_FIELD}
        SELECT page_id, round(max(s), 6) AS score FROM by_field WHERE k = 2 GROUP BY page_id""",
)
def multi_match_best_and(spark, folder):
    return _multi(spark, folder, "best_fields", "en example", "and")


@query(
    "multi_match_most",
    f"""WITH {_fields_sql(['feed', 'example', 'attion'])}, {_PER_FIELD}
        SELECT page_id, round(sum(s), 6) AS score FROM by_field GROUP BY page_id""",
)
def multi_match_most(spark, folder):
    return _multi(spark, folder, "most_fields", "feed example attion")


@query(
    "multi_match_cross",
    f"""WITH {_fields_sql(['feed', 'attion'], shared_df=True)},
        by_term AS (SELECT page_id, term, max(CASE field WHEN 'url' THEN 2 * s ELSE s END) AS s
                    FROM sc GROUP BY page_id, term)
        SELECT page_id, round(sum(s), 6) AS score FROM by_term GROUP BY page_id HAVING count(*) = 2""",
)
def multi_match_cross(spark, folder):
    return _multi(spark, folder, "cross_fields", "feed attion", "and")


def _page_phrase_sql(prefix: bool) -> str:
    last = "starts_with(b.w, 'html')" if prefix else "b.w = 'html'"
    return f"""
    WITH toks AS (SELECT page_id, {tokens_sql('html')} AS t FROM pages),
    size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
    every AS (SELECT page_id, len(t) AS dl, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks),
    df AS (SELECT count(DISTINCT page_id) FILTER (w = 'doctype') AS d0,
                  count(DISTINCT page_id) FILTER ({last.replace('b.', '')}) AS d1 FROM every),
    tf AS (SELECT a.page_id, max(a.dl) AS dl, count(*) AS tf FROM every a
           JOIN every b ON a.page_id = b.page_id AND b.pos = a.pos + 1
           WHERE a.w = 'doctype' AND {last} GROUP BY a.page_id)
    SELECT page_id,
           round(2.2 * (ln(1 + (n - d0 + 0.5) / (d0 + 0.5)) + ln(1 + (n - d1 + 0.5) / (d1 + 0.5)))
                 * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
    FROM tf, df, size"""


@query("multi_match_phrase", _page_phrase_sql(False))
def multi_match_phrase(spark, folder):
    return _multi(spark, folder, "phrase", "doctype html")


@query("multi_match_phrase_prefix", _page_phrase_sql(True).replace("'html')", "'ht')"))
def multi_match_phrase_prefix(spark, folder):
    return _multi(spark, folder, "phrase_prefix", "doctype ht")


@query(
    "stream_filter_equivalent",
    f"""SELECT doc_id FROM documents
        WHERE list_contains({tokens_sql('text')}, 'thtion') AND NOT list_contains({tokens_sql('text')}, 'the')""",
)
def stream_filter_equivalent(spark, folder):
    """The condition alone, as a standing query would apply it."""
    wanted = q.Bool.of(must=[q.Match("text", "thtion")], must_not=[q.Match("text", "the")])
    return matching(table(spark, folder, "documents"), wanted, _ANALYZED).select("doc_id")


def pages(spark, folder) -> Collection:
    return Collection(table(spark, folder, "pages"), "page_id", _PAGE_FIELDS)
