"""Registration of queries and access to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.index import TextIndex, prepare
from ..plans.search import Collection
from ..session import shared_folder

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the same in SQL."""

    def add(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> Collection:
    return Collection(table(spark, folder, "documents"), "doc_id", {"text": "standard"})


_PREPARED: dict[tuple[str, str, str], Collection] = {}


def prepared(spark: SparkSession, folder: str, collection: Collection, label: str) -> Collection:
    """The analysed and indexed form of a table, written once per application and folder."""
    application = spark.sparkContext.applicationId
    key = (application, folder, label)
    if key not in _PREPARED:
        few_files = len(collection.docs.inputFiles()) < spark.sparkContext.defaultParallelism
        place = folder.strip("/").replace("/", "_")
        path = f"{shared_folder(spark)}/prepared-{application}-{place}-{label}"
        _PREPARED[key] = prepare(collection, path, spread=few_files)
    return _PREPARED[key]


def indexed_documents(spark: SparkSession, folder: str) -> Collection:
    return prepared(spark, folder, documents(spark, folder), "documents")


def document_index(spark: SparkSession, folder: str) -> TextIndex:
    return indexed_documents(spark, folder).index


# -- pieces of SQL ---------------------------------------------------------------------

def tokens_sql(column: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({column}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def bm25_sql(tf: str, df: str) -> str:
    """BM25 given columns ``n``, ``avgdl`` and ``dl``."""
    return f"2.2 * ln(1 + (n - {df} + 0.5) / ({df} + 0.5)) * {tf} / ({tf} + 1.2 * (0.25 + 0.75 * dl / avgdl))"


def term_scores_sql(terms: list[str], table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs ending in ``sc(key, term, tf, dl, s)``: the score of each term in each row holding it."""
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"""
    toks AS (SELECT *, {tokens_sql(text)} AS t FROM {table}),
    size AS (SELECT count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS avgdl FROM toks),
    words AS (SELECT {key}, len(t) AS dl, unnest(t) AS term FROM toks),
    tf AS (SELECT {key}, term, max(dl) AS dl, count(*) AS tf FROM words WHERE term IN ({listed}) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    sc AS (SELECT {key}, term, tf, dl, {bm25_sql('tf', 'df')} AS s FROM tf JOIN df USING (term), size)"""
