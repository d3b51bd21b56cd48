"""Audit of filters that overlap: what each removes, misses and costs, in every order of the filters."""

from __future__ import annotations

from itertools import combinations, permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import term_matrix
from .common import materialise, query, table

FILTERS = "ABCDE"
# Fixed values of the filters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes that go on with a character of UTF-8


def _text_facts(text: bytes) -> tuple[int, int, bool]:
    """Code points, capitals, and whether any of the marks occurs."""
    return (
        len(text.translate(None, _CONTINUED)),
        len(text) - len(text.translate(None, _CAPITALS)),
        len(text.translate(None, _MARKS)) < len(text),
    )


_FACTS = [("chars", pa.int64(), "long"), ("capitals", pa.int64(), "long"), ("marked", pa.bool_(), "boolean")]


def text_flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", shard_bytes: int = term_matrix.SHARD_BYTES) -> DataFrame:
    """Per document: doc_id, part, digest, words, distinct_words, and ``A`` to ``E``, whether it fails each filter.

    A: under 50 words; B: too few distinct words; C: too many capitals; D: any of the marks; E: another row
    with a smaller id has the same text.  Rows of one id are not copies of each other.  A null text is empty; a
    null id is smaller than none and none is smaller than it; a null part is the empty string.  Every row gives one row.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    encoded = term_matrix.encode(given, "text", _text_facts, _FACTS, shard_bytes)

    def measured(shard: term_matrix.Shard) -> pa.Table:
        rows = shard.rows.drop_columns(["shard"])
        return rows.append_column("words", pa.array(shard.row_sums())).append_column("distinct_words", pa.array(shard.nonzeros()))

    schema = f"k0 {id_type}, k1 string, digest binary, chars long, capitals long, marked boolean, words long, distinct_words long"
    rows = term_matrix.over_shards(encoded, measured, schema).withColumnsRenamed({"k0": "doc_id", "k1": "part"})
    # Plain tables on both sides, so that the join can split a text which a third of all rows has.
    rows = materialise(rows, "text-facts")
    copied = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(materialise(copied.select("digest", "first"), "copied-texts"), "digest", "left")
    return rows.select(
        "doc_id", "part", "digest", "words", "distinct_words",
        (F.col("words") < LEAST_WORDS).alias("A"),
        (100 * F.col("distinct_words") < DISTINCT_PERCENT * F.col("words")).alias("B"),
        (100 * F.col("capitals") > CAPITAL_PERCENT * F.col("chars")).alias("C"),
        F.col("marked").alias("D"),
        F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"),
    )


def interactions(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, with counts of documents.

    ``flags`` has ``part``, ``good``, ``toxic`` and a boolean column for each filter.  Documents are first
    counted by what they fail, then each count meets the sets of filters that can stand before a filter, and
    only the sums of those are dealt to the orders.  Null flags are false.  No rows give no rows.
    """
    bits = {f: 1 << i for i, f in enumerate(filters)}
    mask = sum((F.when(F.col(f), b).otherwise(0) for f, b in bits.items()), F.lit(0))
    told = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    cells = flags.groupBy("part", mask.alias("mask"), told("good"), told("toxic")).agg(F.count(F.lit(1)).alias("n"))

    stands = [(sum(bits[g] for g in before), bits[f]) for f in filters for k in range(len(filters)) for before in combinations(filters.replace(f, ""), k)]
    places = F.array(*[F.struct(F.lit(b).alias("before"), F.lit(f).alias("own")) for b, f in stands])
    met = cells.withColumn("place", F.explode(places)).select("*", "place.before", "place.own")
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    orders = ["".join(p) for p in permutations(filters)]
    removed = fails & ~earlier

    def total(condition: Column, name: str, value: Column | str = "n") -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.sum(F.when(condition, value).otherwise(0)).cast("long").alias(name)

    sums = met.groupBy("part", "before", "own").agg(
        total(~fails & ~earlier, "kept"),
        total(removed, "removed"),
        total(fails & earlier, "redundant"),
        total(F.col("mask") == F.col("own"), "unique_fails"),
        total(removed & F.col("good"), "good_lost"),
        total(removed & F.col("toxic"), "toxic_lost"),
        # Of a document's failing filters each stands first in the same share of the orders.
        total(fails, "shapley", F.col("n") * F.expr(f"{len(orders)} div bit_count(mask)")),
    )
    steps = [(sum(bits[g] for g in o[:i]), bits[f], o, i + 1) for o in orders for i, f in enumerate(o)]
    listed = flags.sparkSession.createDataFrame(steps, "before int, own int, filter_order string, step int")
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sums.join(listed, ["before", "own"]).select("part", "filter_order", "step", *counts)


_SQL = r"""WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t FROM documents),
    counted AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM texts),
    marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
    flags AS (SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
        100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS c,
        regexp_matches(t, '[#$%&*|]') AS d, coalesce(counted.doc_id > min(counted.doc_id) OVER (PARTITION BY t), false) AS e,
        coalesce(good, false) AS good, coalesce(bad, false) AS bad
        FROM counted LEFT JOIN marks ON counted.doc_id = marks.doc_id),
    cells AS (SELECT part, good, bad, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
        || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS failing, count(*) AS n FROM flags GROUP BY ALL),
    letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order FROM letters v, letters w, letters x, letters y, letters z
        WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
    steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before
        FROM orders, range(1, 6) r(step)),
    met AS (SELECT part, filter_order, step, own, n, good, bad, failing, contains(failing, own) AS fails,
        length(translate(failing, before, '')) < length(failing) AS earlier FROM cells, steps),
    sums AS (SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS kept,
        coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS removed,
        coalesce(sum(n) FILTER (fails AND earlier), 0) AS redundant,
        coalesce(sum(n) FILTER (failing = own), 0) AS unique_fails,
        coalesce(sum(n) FILTER (fails AND NOT earlier AND good), 0) AS good_lost,
        coalesce(sum(n) FILTER (fails AND NOT earlier AND bad), 0) AS toxic_lost FROM met GROUP BY ALL)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
        CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
        CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM sums"""


@query("op13_filter_audit", _SQL)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    flags = text_flags(table(spark, folder, "documents"))
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return interactions(flags.join(materialise(labels, "labels"), "doc_id", "left"))
