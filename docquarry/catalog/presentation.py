"""Highlights and suggestions."""

from pyspark.sql import functions as F

from ..operators import queries as q
from ..operators.highlight import Highlight
from ..operators.suggest import count_suggestions, suggest, suggest_batch
from ..plans.search import SearchRequest, search
from ..functions.fields import as_array, first_value
from .base import indexed_documents, prepared, query, table, tokens_sql
from .text import pages

_PIECES = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"


def _marked_sql(text: str, condition: str, pre: str = "<em>", post: str = "</em>") -> str:
    pieces = _PIECES.format(text)
    return f"""array_to_string(list_transform({pieces},
        lambda x: CASE WHEN {condition} THEN '{pre}' || x || '{post}' ELSE x END), '')"""


def _highlighted(spark, folder, wanted, spec, fields=()):
    request = SearchRequest(wanted, fields=list(fields), export=True, highlight=spec)
    return search(indexed_documents(spark, folder), request).hits


@query(
    "highlight_full",
    f"""SELECT doc_id, {_marked_sql('text', "lower(x) IN ('thtion', 'ention')")} AS marked FROM documents
        WHERE list_has_any({tokens_sql('text')}, ['thtion', 'ention'])""",
)
def highlight_full(spark, folder):
    spec = Highlight()
    spec.add("text", fragments=0)
    hits = _highlighted(spark, folder, q.Match("text", "thtion ention"), spec)
    return hits.select("doc_id", F.col("highlight.text")[0].alias("marked"))


_FRAGMENTS = r"regexp_extract_all(text, '[\s\S]{1,100}[\p{L}\p{N}]*')"


@query(
    "highlight_fragments",
    f"""WITH cut AS (SELECT doc_id, unnest({_FRAGMENTS}) AS plain, generate_subscripts({_FRAGMENTS}, 1) AS i
                     FROM documents WHERE list_contains({tokens_sql('text')}, 'thtion')),
        marked AS (SELECT doc_id, i, plain, {_marked_sql('plain', "lower(x) = 'thtion'", '[', ']')} AS fragment FROM cut),
        hits AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS place FROM marked
                 WHERE fragment <> plain)
        SELECT doc_id, place::INT AS place, fragment FROM hits WHERE place < 3""",
)
def highlight_fragments(spark, folder):
    spec = Highlight()
    spec.add("text", pre="[", post="]")
    hits = _highlighted(spark, folder, q.Match("text", "thtion"), spec)
    return hits.select("doc_id", F.posexplode("highlight.text").alias("place", "fragment"))


@query(
    "highlight_by_score",
    f"""WITH cut AS (SELECT doc_id, unnest({_FRAGMENTS}) AS plain, generate_subscripts({_FRAGMENTS}, 1) AS i
                     FROM documents WHERE list_has_any({tokens_sql('text')}, ['the', 'attion'])
                                      AND list_contains({tokens_sql('text')}, 'attion')),
        marked AS (SELECT doc_id, i, plain, {_marked_sql('plain', "lower(x) IN ('the', 'attion')")} AS fragment FROM cut),
        hits AS (SELECT *, row_number() OVER (
                     PARTITION BY doc_id ORDER BY length(fragment) - length(plain) DESC, i) - 1 AS place
                 FROM marked WHERE fragment <> plain)
        SELECT doc_id, place::INT AS place, fragment FROM hits WHERE place < 2""",
)
def highlight_by_score(spark, folder):
    spec = Highlight()
    spec.add("text", fragments=2, order="score", query=q.Match("text", "the attion"))
    hits = _highlighted(spark, folder, q.Match("text", "attion"), spec)
    return hits.select("doc_id", F.posexplode("highlight.text").alias("place", "fragment"))


@query(
    "highlight_no_match",
    f"""SELECT doc_id, substr(text, 1, 80) AS fragment FROM documents
        WHERE lang = 'fr' AND NOT list_contains({tokens_sql('text')}, 'thtion')""",
)
def highlight_no_match(spark, folder):
    spec = Highlight()
    spec.add("text", no_match_size=80)
    wanted = q.Bool.of(filter=[q.Term("lang", "fr")], must_not=[q.Match("text", "thtion")])
    hits = _highlighted(spark, folder, wanted, spec)
    return hits.select("doc_id", F.explode("highlight.text").alias("fragment"))


@query(
    "highlight_any_field",
    f"""SELECT doc_id, {_marked_sql('text', "lower(x) = 'de'")} AS marked FROM documents
        WHERE lang = 'de' AND list_contains({tokens_sql('text')}, 'de')""",
)
def highlight_any_field(spark, folder):
    """Without the field-match rule, the term of another field is marked too."""
    spec = Highlight()
    spec.add("text", fragments=0, require_field_match=False)
    hits = _highlighted(spark, folder, q.Term("lang", "de"), spec)
    return hits.select("doc_id", F.explode("highlight.text").alias("marked"))


# -- suggestions ---------------------------------------------------------------------

@query(
    "suggest_prefix",
    """SELECT p_name AS text, max(p_size) AS weight FROM part WHERE starts_with(lower(p_name), 'bl')
       GROUP BY p_name ORDER BY weight DESC, text LIMIT 5""",
)
def suggest_prefix(spark, folder):
    return suggest(table(spark, folder, "part"), "p_name", "BL", "p_size")


@query(
    "suggest_payload",
    """SELECT text, weight, p_brand, p_partkey FROM (
           SELECT p_name AS text, p_size AS weight, p_brand, p_partkey,
                  row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_brand DESC, p_partkey DESC) AS r
           FROM part WHERE starts_with(p_name, 'red'))
       WHERE r = 1 ORDER BY weight DESC, text LIMIT 4""",
)
def suggest_payload(spark, folder):
    return suggest(table(spark, folder, "part"), "p_name", "red", "p_size", ["p_brand", "p_partkey"], size=4)


@query(
    "suggest_category",
    """SELECT p_name AS text, max(p_size) AS weight FROM part
       WHERE starts_with(p_name, 'small') AND p_brand IN ('Brand#3', 'Brand#7') AND p_type IN ('LARGE', 'ECONOMY')
       GROUP BY p_name ORDER BY weight DESC, text LIMIT 5""",
)
def suggest_category(spark, folder):
    categories = {"p_brand": ["Brand#3", "Brand#7"], "p_type": ["LARGE", "ECONOMY"]}
    return suggest(table(spark, folder, "part"), "p_name", "small", "p_size", categories=categories)


@query(
    "suggest_count",
    "SELECT least(count(DISTINCT p_name), 50) AS count FROM part WHERE starts_with(p_name, 'h')",
)
def suggest_count(spark, folder):
    return count_suggestions(suggest(table(spark, folder, "part"), "p_name", "h", "p_size", size=50))


@query(
    "suggest_batch",
    """WITH prefixes AS (SELECT DISTINCT substr(p_type, 1, 2) AS request_id, lower(substr(p_type, 1, 2)) AS prefix
                         FROM part),
        options AS (SELECT p_name AS text, max(p_size) AS weight FROM part GROUP BY p_name),
        found AS (SELECT request_id, text, weight,
                         row_number() OVER (PARTITION BY request_id ORDER BY weight DESC, text) AS rank
                  FROM prefixes JOIN options ON starts_with(lower(text), prefix))
        SELECT request_id, text, weight, rank FROM found WHERE rank <= 5""",
)
def suggest_for_types(spark, folder):
    """One request per kind of part: names that begin like it."""
    part = table(spark, folder, "part")
    start = F.substring("p_type", 1, 2)
    prefixes = part.select(start.alias("request_id"), start.alias("prefix")).distinct()
    found = suggest_batch(part, "p_name", prefixes, "p_size")
    return found.withColumn("rank", F.col("rank").cast("long"))


# -- options of the highlighter ----------------------------------------------------------

def _cut_sql(fragment: str) -> str:
    """As ``highlight_fragments``, with fragments of another shape."""
    cut = f"regexp_extract_all(text, '{fragment}')"
    return f"""WITH cut AS (SELECT doc_id, unnest({cut}) AS plain, generate_subscripts({cut}, 1) AS i
                     FROM documents WHERE list_contains({tokens_sql('text')}, 'thtion')),
        marked AS (SELECT doc_id, i, plain, {_marked_sql('plain', "lower(x) = 'thtion'", '[', ']')} AS fragment FROM cut),
        hits AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS place FROM marked
                 WHERE fragment <> plain)
        SELECT doc_id, place::INT AS place, fragment FROM hits WHERE place < 2"""


def _register_scanner(name: str, fragment: str, **options) -> None:
    @query(f"highlight_{name}", _cut_sql(fragment))
    def highlight_scanner(spark, folder):
        spec = Highlight()
        spec.add("text", pre="[", post="]", fragments=2, fragment_size=60, **options)
        hits = _highlighted(spark, folder, q.Match("text", "thtion"), spec)
        return hits.select("doc_id", F.posexplode("highlight.text").alias("place", "fragment"))


_register_scanner("sentences", r"[\s\S]{1,60}[^.!?]*[.!?]*\s*", boundary_scanner="sentence")
_register_scanner("chars", r"[\s\S]{1,60}[^.,!? \t\n]{0,20}", boundary_scanner="chars")
_register_scanner("chars_near", r"[\s\S]{1,60}[^e]{0,7}", boundary_scanner="chars", boundary_chars="e", boundary_max_scan=7)


@query(
    "highlight_matched_fields",
    f"""SELECT page_id, {_marked_sql('url', "lower(x) IN ('example', 'feed')", '<em class="hlt1">')} AS marked FROM pages
        WHERE list_has_any({tokens_sql('html')}, ['example', 'feed'])
          AND list_has_any({tokens_sql('url')}, ['example', 'feed'])""",
)
def highlight_matched_fields(spark, folder):
    """Addresses marked by the words asked of the markup, with the styled tags."""
    collection = prepared(spark, folder, pages(spark, folder), "pages")
    spec = Highlight()
    spec.add("url", fragments=0, matched_fields=["html"], tags_schema="styled")
    request = SearchRequest(q.Match("html", "example feed"), export=True, highlight=spec)
    hits = search(collection, request).hits.select("page_id", F.col("highlight.url")[0].alias("marked"))
    return hits.filter(F.col("marked").isNotNull())


@query(
    "values_first_and_all",
    """SELECT conv_id, first(role ORDER BY turn) AS first_role, string_agg(role, ',' ORDER BY turn) AS all_roles,
              min(turn) AS first_turn FROM conversations GROUP BY conv_id""",
)
def values_first_and_all(spark, folder):
    """The first and all values of a multi-valued field, and of one with a single value."""
    turns = table(spark, folder, "conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"), F.min("turn").alias("turn")
    )
    docs = turns.select("conv_id", F.col("turns.role").alias("roles"), "turn")
    roles, turn = docs.schema["roles"].dataType, docs.schema["turn"].dataType
    return docs.select(
        "conv_id",
        first_value(F.col("roles"), roles).alias("first_role"),
        F.array_join(as_array(F.col("roles"), roles), ",").alias("all_roles"),
        F.array_max(as_array(F.col("turn"), turn)).alias("first_turn"),
    )

