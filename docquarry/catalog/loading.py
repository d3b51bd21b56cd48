"""Ingest: replace by id, snapshots, continuous loads and standing queries."""

import uuid

from pyspark.sql import functions as F

from ..operators import queries as q
from ..plans.index import refresh_index
from ..sources.documents import read_json_documents, upsert, with_ids
from ..streaming.followed import FollowedIndex
from ..streaming.ingest import append_changes, standing_query, standing_scores
from .base import document_index, indexed_documents, query, shared_folder, table, term_scores_sql, tokens_sql

# A change set derived from the orders: every finished order is repriced, twice, and
# each urgent order gets a copy under a new id.
_CHANGES = """changes AS (
    SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, 'P' AS o_orderstatus, 1 AS seq FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_totalprice * 3, 'Q', 2 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
    UNION ALL
    SELECT -o_orderkey - 1, o_totalprice, 'N', 1 FROM orders WHERE o_orderpriority = '1-URGENT')"""

_UPSERTED = f"""WITH {_CHANGES},
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS r FROM changes)
               WHERE r = 1)
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM latest"""


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def _changes(spark, folder):
    orders = table(spark, folder, "orders")
    done = F.col("o_orderstatus") == "F"

    def change(rows, key, factor, status, seq):
        return rows.select(
            key.alias("o_orderkey"),
            (F.col("o_totalprice") * factor).alias("o_totalprice"),
            F.lit(status).alias("o_orderstatus"),
            F.lit(seq).alias("seq"),
        )

    key = F.col("o_orderkey")
    return (
        change(orders.filter(done), key, 2, "P", 1)
        .unionByName(change(orders.filter(done & (F.col("o_orderpriority") == "5-LOW")), key, 3, "Q", 2))
        .unionByName(change(orders.filter(F.col("o_orderpriority") == "1-URGENT"), -key - 1, 1, "N", 1))
    )


def _place(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _written(df, name):
    """The rows as a table of Parquet files."""
    path = _place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("upsert_last_wins", _UPSERTED)
def upsert_last_wins(spark, folder):
    return upsert(_orders(spark, folder), _changes(spark, folder), "o_orderkey", "seq")


@query("store_upsert", _UPSERTED)
def store_upsert(spark, folder):
    """The same over written tables: a base and a load of changes, merged when read."""
    base, changes = _written(_orders(spark, folder), "base"), _written(_changes(spark, folder), "changes")
    return upsert(base, changes, "o_orderkey", "seq").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("store_uncommitted_hidden", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def store_uncommitted_hidden(spark, folder):
    """A load written beside the base does not show until a reader merges it."""
    base = _written(_orders(spark, folder), "base")
    _written(_changes(spark, folder), "changes")
    return base


@query("store_clear", "SELECT count(*) AS deleted, 0 AS left FROM orders".replace("left", '"left"'))
def store_clear(spark, folder):
    """A table is cleared by writing no rows over it."""
    base = _written(_orders(spark, folder), "base")
    path = _place(spark, "cleared")
    base.write.parquet(path)
    deleted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("deleted")).first()[0]
    base.limit(0).write.mode("overwrite").parquet(path)
    left = spark.read.schema(base.schema).parquet(path)
    return left.agg(F.lit(deleted).cast("long").alias("deleted"), F.count(F.lit(1)).cast("int").alias("left"))


@query("store_compact", _UPSERTED)
def store_compact(spark, folder):
    """Base and changes written as one new table."""
    merged = upsert(_orders(spark, folder), _changes(spark, folder), "o_orderkey", "seq")
    return _written(merged.select("o_orderkey", "o_totalprice", "o_orderstatus"), "merged")


@query(
    "json_documents",
    """SELECT coalesce(lang, 'none') AS _id, doc_id, "text", n_chars FROM documents""",
)
def json_documents(spark, folder):
    """All documents written as JSON and read back by the library's reader; the id is the name of the folder."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "n_chars", F.coalesce("lang", F.lit("none")).alias("key"))
    path = _place(spark, "json")
    docs.write.partitionBy("key").json(path)
    schema = docs.select("doc_id", "text", "n_chars").schema
    return read_json_documents(spark, path, schema, lines=True, id_from="folder").select("_id", "doc_id", "text", "n_chars")


@query("generated_ids", "SELECT count(*) AS n, count(*) AS distinct_ids FROM documents")
def generated_ids(spark, folder):
    docs = with_ids(table(spark, folder, "documents").select("text"))
    return docs.agg(F.count("_id").alias("n"), F.countDistinct("_id").alias("distinct_ids"))


@query(
    "refresh_postings",
    f"""WITH changed AS (SELECT doc_id, CASE WHEN lang = 'de' THEN upper(lang) || ' ' || source || ' ' || source
                                            ELSE text END AS text FROM documents),
        words AS (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM changed)
        SELECT doc_id AS _id, term, count(*) AS tf FROM words GROUP BY ALL""",
)
def refresh_postings(spark, folder):
    """All German documents get a new text; only their postings are made again."""
    docs = table(spark, folder, "documents").filter(F.col("lang") == "de")
    changed = docs.withColumn("text", F.concat_ws(" ", F.upper("lang"), "source", "source"))
    index = refresh_index(document_index(spark, folder), changed, "doc_id", {"text": "standard"})
    return index.postings.select("_id", "term", F.col("tf").cast("long").alias("tf"))


# -- streams ----------------------------------------------------------------------------

def _stream(spark, folder, name):
    # The pattern finds the table as one file and as a folder of files.
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    return reader.option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}.parque[t]")


def _run(writer, spark):
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()


@query(
    "stream_upsert",
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
       UNION ALL SELECT o_orderkey, o_totalprice / 2, 'S' FROM orders WHERE o_orderstatus = 'F'""",
)
def stream_upsert(spark, folder):
    """Orders overwritten by a stream of repriced ones: the stream appends, the reader merges."""
    stream = _stream(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", (F.col("o_totalprice") / 2).alias("o_totalprice"), F.lit("S").alias("o_orderstatus")
    )
    path = _place(spark, "stream")
    _run(append_changes(stream, f"{path}/changes", f"{path}/checkpoint"), spark)
    return upsert(_orders(spark, folder), spark.read.schema(stream.schema).parquet(f"{path}/changes"), "o_orderkey")


@query(
    "standing_query",
    "SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase' AND value >= 100 AND user_id <> 13",
)
def standing(spark, folder):
    wanted = q.Bool.of(
        must=[q.Term("event_type", "purchase")],
        filter=[q.Range("value", gte=100)],
        must_not=[q.Term("user_id", 13)],
    )
    found = standing_query(_stream(spark, folder, "events"), wanted).select("event_id", "event_type", "value")
    return _delivered(spark, found, "standing")


@query(
    "standing_scores",
    f"""WITH {term_scores_sql(['thtion', 'ention'])}
        SELECT doc_id, round(sum(s), 6) AS score FROM sc GROUP BY doc_id""",
)
def standing_with_scores(spark, folder):
    """A stream of documents, scored against the statistics of the stored index."""
    found = standing_scores(
        _stream(spark, folder, "documents"),
        q.Match("text", "thtion ention"),
        {"text": "standard"},
        document_index(spark, folder),
    )
    return _delivered(spark, found.select("doc_id", F.round("_score", 6).alias("score")), "scores")


def _delivered(spark, stream, name):
    """What the stream has written so far, read from its file sink."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _run(stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").option(
        "path", f"{path}/out"), spark)
    return spark.read.parquet(f"{path}/out")


_FOLLOWED = """changed AS (
        SELECT doc_id, CASE WHEN lang = 'de' AND doc_id % 2 = 0 THEN 'second ' || source
                            WHEN lang = 'de' THEN upper(lang) || ' ' || source || ' ' || source
                            ELSE text END AS text FROM documents WHERE lang IS NULL OR lang <> 'fr' OR doc_id % 2 <> 0
        UNION ALL SELECT -doc_id - 1, text FROM documents WHERE lang = 'fr')"""


@query(
    "stream_index",
    f"""WITH {_FOLLOWED},
        words AS (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM changed),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        size AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS sum_dl FROM words)
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf, any_value(n_docs) AS n_docs, any_value(sum_dl) AS sum_dl
        FROM counts, size GROUP BY term""",
)
def stream_index(spark, folder):
    """The index follows a stream that is stopped and started again: German texts change, half of them twice,
    French ones get a copy under a new id, and then half of the originals go."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    german, french, even = F.col("lang") == "de", F.col("lang") == "fr", F.col("doc_id") % 2 == 0
    gone, stays = F.lit(True).alias("gone"), F.lit(False).alias("gone")
    first = docs.where(german).select("doc_id", F.concat_ws(" ", F.upper("lang"), "source", "source").alias("text"), stays)
    first = first.unionByName(docs.where(french).select((-F.col("doc_id") - 1).alias("doc_id"), "text", stays))
    second = docs.where(german & even).select("doc_id", F.concat(F.lit("second "), "source").alias("text"), stays)
    second = second.unionByName(docs.where(french & even).select("doc_id", "text", gone))

    place = _place(spark, "followed")
    index = FollowedIndex(indexed_documents(spark, folder), f"{place}/changes", deleted_col="gone")
    for load in (first, second):
        load.write.mode("append").parquet(f"{place}/loads")
        _run(index.follow(spark.readStream.schema(load.schema).parquet(f"{place}/loads"), f"{place}/checkpoint"), spark)
    kept = index.current().index
    tf = kept.postings.groupBy("term").agg(F.sum("tf").alias("tf"))
    sizes = kept.field_stats.agg(F.first(F.struct("n_docs", "sum_dl"))).scalar()
    rows = kept.term_stats.select("term", "df").join(tf, "term", "full")
    return rows.select("term", "df", "tf", sizes["n_docs"].alias("n_docs"), sizes["sum_dl"].alias("sum_dl"))
