"""Postings and corpus statistics of a collection, as ordinary Spark tables.

``postings``     bucket, field, term, _id, tf, positions, dl, impact
``term_stats``   bucket, field, term, df, best, levels
``field_stats``  field, n_docs, sum_dl
``documents``    _id of every document, those without words too

Saved postings and term statistics are partitioned by ``bucket``, a hash of field and term, so a query
reads the partitions of its own terms only.  ``impact`` is a posting's share of its term's
weight in BM25; the postings of a term are sorted by it, so the statistics of row groups
and pages bound it block by block.  ``best`` is a term's largest impact, and
``levels[i]`` counts its postings of at least ``(i + 1) / LEVELS`` of the largest possible impact.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scoring
from ..operators.joins import Requests, request_join
from ..operators.scope import Scope, stored_name, tokens_name
from ..session import small_splits
from .search import Collection

# A bucket holds about so many distinct terms, a file so many postings; there are at most MOST_BUCKETS buckets.
BUCKET_TERMS = 4_000
FILE_POSTINGS = 4_000_000
MOST_BUCKETS = 4096
# A task sorts about so many postings at most, some 150 MB of them, so it need not spill.
TASK_POSTINGS = 1_000_000
# A task that makes postings reads so much of the stored documents: its postings are some ten times that, and stay in memory.
SPLIT_BYTES = 16 << 20
# A partition of documents meets so many requests' postings at most.
TASK_PAIRS = 2_000_000
# A task that looks for the best documents of queries sorts so many rows at most.
TASK_GROUPS = 1_000_000
# Postings are made from documents of so many tokens at a time, one document at least, and handed on by so many rows.
BATCH_TOKENS = 1_000_000
BATCH_ROWS = 100_000
# Postings of one term go through the exchange in one row, at most so many.
BLOCK_POSTINGS = 10_000
# Of the stored tables, the large ones.
CODEC = "zstd"
# The number of terms is estimated from one of so many parts of their hashes.
HASH_PARTS = 16
#: Steps in which a term's impacts are counted.
LEVELS = 16


def bucket_of(buckets: int) -> Column:
    return (F.crc32(F.concat("field", F.lit("\0"), "term").cast("binary")) % buckets).cast("int")


@dataclass
class TextIndex:
    """``buckets``, ``id_col`` and ``lengths`` (mean lengths that impacts refer to, by field) are known of a saved index."""

    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    fields: list[str]
    documents: DataFrame
    buckets: int | None = None
    id_col: str | None = None
    lengths: dict[str, float] = field(default_factory=dict)
    #: Estimated number of terms per field, to lay out an index that is to be saved.
    vocabulary: DataFrame | None = None
    #: Makes the postings as blocks, given the number of buckets and the mean lengths, for an index that is to be saved.
    blocks: Callable[[int, dict[str, float]], DataFrame] | None = None
    _unique: bool | None = None

    def covers(self, field: str) -> bool:
        return field in self.fields

    # -- reading by term ---------------------------------------------------------
    def _bucket(self, field: str, term: str) -> int:
        return zlib.crc32(f"{field}\0{term}".encode()) % self.buckets

    def of_terms(self, table: DataFrame, terms: list[tuple[str, str]]) -> DataFrame:
        """Rows of ``postings`` or ``term_stats`` for some (field, term), from their partitions alone."""
        if self.buckets is not None:
            table = table.filter(F.col("bucket").isin(*sorted({self._bucket(f, t) for f, t in terms})))
        by_field: dict[str, list[str]] = {}
        for f, t in terms:
            by_field.setdefault(f, []).append(t)
        tests = [(F.col("field") == f) & F.col("term").isin(*sorted(ts)) for f, ts in sorted(by_field.items())]
        return table.filter(scoring.any_of(tests))

    def postings_of(self, terms: list[tuple[str, str]]) -> DataFrame:
        return self.of_terms(self.postings, terms)

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        """Request rows of (field, term) with the partition their postings are in."""
        return rows if self.buckets is None else rows.withColumn("bucket", bucket_of(self.buckets))

    def postings_for(self, requests: Requests, keys: list[str] = (), columns: list[str] | None = None) -> DataFrame:
        """Inner join of settled request rows of (field, term) with their postings.

        The buckets in use, a bounded set of numbers, prune partitions before the join.
        """
        postings = self.postings
        if self.buckets is not None:
            used = [r[0] for r in requests.rows.select("bucket").distinct().collect()]
            postings = postings.filter(F.col("bucket").isin(*sorted(used)))
            keys = ["bucket", *[k for k in keys if k != "bucket"]]
        keys = [*keys, "field", "term"]
        if columns is not None:
            postings = postings.select(*keys, *[c for c in columns if c not in keys])
        return request_join(requests, postings, keys, "_id")

    # -- reading by document -------------------------------------------------------
    @property
    def keys(self) -> list[str]:
        """What names a term in the tables."""
        return ["field", "term"] if self.buckets is None else ["bucket", "field", "term"]

    def unique_ids(self) -> bool:
        """Whether every id names one document; counted once."""
        if self._unique is None:
            self._unique = self.documents.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        return self._unique

    def by_document(self, rows: DataFrame, pairs: int | None) -> DataFrame:
        """Rows of postings with those of a document in one partition, enough of them for ``pairs`` rows to come."""
        return rows.repartition(self._parts(rows, pairs or 0, TASK_PAIRS), "_id")

    def few_parts(self, hits: DataFrame, queries: int) -> DataFrame:
        """Rows, one per query and document, in no more partitions than they may need: of each, every query's best are shuffled."""
        docs = self.field_stats.agg(F.sum("n_docs")).first()[0]
        return hits.coalesce(self._parts(hits, queries * (docs or 0), TASK_GROUPS))

    @staticmethod
    def _parts(rows: DataFrame, total: int, each: int) -> int:
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return max(least, -(-total // each))

    def _stats_of(self, names: dict[tuple, str]) -> DataFrame:
        return self.of_terms(self.term_stats, sorted({(stored_name(key[0], key[2]), key[3][1]) for key in names}))

    # Rows for one query: the tables filtered to its fields and terms, folded into a struct.
    def field_row(self, names: dict[tuple, str]) -> DataFrame:
        folded = []
        for (path, kind, field), name in names.items():
            field = stored_name(path, field)
            value = F.col("n_docs") if kind == "n_docs" else F.try_divide("sum_dl", "n_docs")
            folded.append(F.max(F.when(F.col("field") == field, value)).cast("double").alias(name))
        return self.field_stats.agg(F.struct(*folded).alias("s"))

    def term_row(self, names: dict[tuple, str]) -> DataFrame:
        folded = []
        for (path, _, field, (_, term)), name in names.items():
            field = stored_name(path, field)
            df = F.max(F.when((F.col("field") == field) & (F.col("term") == term), F.col("df")))
            folded.append(F.coalesce(df, F.lit(0)).alias(name))
        return self._stats_of(names).agg(F.struct(*folded).alias("s"))

    # -- storage -------------------------------------------------------------
    def save(self, path: str, files: int | None = None, id_col: str | None = None) -> "TextIndex":
        """Write the tables and read them back.

        The number of buckets comes from the (estimated) vocabulary.  A salt from the document's id divides a
        bucket into files of about ``FILE_POSTINGS`` postings, as many as a term found in
        most documents needs.  Hashing needs no sampling pass, which would analyse every text twice.
        """
        spark = self.postings.sparkSession
        n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.documents.write.mode("overwrite").parquet(f"{path}/documents")
        self.field_stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/field_stats")
        field_stats = spark.read.parquet(f"{path}/field_stats")
        tokens, docs = field_stats.agg(F.sum("sum_dl"), F.max("n_docs")).first()
        terms = self.vocabulary.agg(F.sum("n_terms")).first()[0]
        buckets = max(1, min(MOST_BUCKETS, -(-(terms or 0) // BUCKET_TERMS)))
        salts = max(1, -(-max((tokens or 0) // buckets, docs or 0) // FILE_POSTINGS))
        layout = field_stats.select("field", F.try_divide("sum_dl", "n_docs").alias("avgdl"))
        layout = layout.withColumns({"buckets": F.lit(buckets), "positions": F.lit("positions" in self.postings.columns)})
        layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")

        means = {r["field"]: r["avgdl"] for r in layout.collect()}
        only = self.fields[0] if len(self.fields) == 1 else None
        # What can be told again behind the exchange does not go through it.
        told = {"field": F.lit(only)} if only is not None else {}
        salt = F.pmod(F.xxhash64(F.get("ids", F.lit(0))), F.lit(salts))
        blocks = self.blocks(buckets, means).drop(*told)
        blocks = blocks.repartition(max(n, -(-(tokens or 0) // TASK_POSTINGS)), "bucket", salt)
        laid = with_impact(_of_blocks(blocks).withColumns(told), layout.select("field", "avgdl"))
        names = ["field", "term"] if only is None else ["term"]
        clustered = laid.sortWithinPartitions("bucket", *names, F.desc("impact")).select(*self.postings.columns, "impact", "bucket")
        with small_splits(spark, SPLIT_BYTES):
            clustered.write.mode("overwrite").option("compression", CODEC).partitionBy("bucket").parquet(f"{path}/postings")
        # From the written postings, so the texts are not analysed again.
        counted = term_stats(spark.read.schema(clustered.schema).parquet(f"{path}/postings"))
        counted = counted.repartition(n, "bucket").sortWithinPartitions("bucket", "field", "term")
        counted.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/term_stats")
        return load_index(spark, path, self.fields, id_col)


def load_index(spark: SparkSession, path: str, fields: list[str], id_col: str | None = None) -> TextIndex:
    """A saved index; one row per field, its layout, is read at once."""
    layout = spark.read.parquet(f"{path}/layout").collect()
    documents = spark.read.parquet(f"{path}/documents")
    id_type = documents.schema["_id"].dataType.simpleString()
    places = "positions array<int>, " if layout and layout[0]["positions"] else ""
    # Partitioned tables without rows have no file to tell their columns.
    postings = f"field string, _id {id_type}, dl int, term string, tf int, {places}impact double, bucket int"
    counts = "field string, term string, df bigint, best double, levels array<bigint>, bucket int"
    return TextIndex(
        spark.read.schema(postings).parquet(f"{path}/postings"),
        spark.read.schema(counts).parquet(f"{path}/term_stats"),
        spark.read.parquet(f"{path}/field_stats"),
        list(fields),
        documents,
        layout[0]["buckets"] if layout else None,
        id_col,
        {r["field"]: r["avgdl"] for r in layout if r["avgdl"] is not None},
    )


def with_impact(postings: DataFrame, means: DataFrame) -> DataFrame:
    """Add ``impact``: BM25 for a weight of one; ``means`` has one row per field."""
    entry = F.struct("field", "avgdl")
    mean = means.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()
    return postings.withColumn("impact", scoring.bm25(F.lit(1.0), F.col("tf"), F.col("dl"), mean[F.col("field")]))


def build_index(
    docs: DataFrame, id_col: str, text_fields: dict[str, str], positions: bool = True, spread: bool = False
) -> TextIndex:
    """Postings and statistics of the text fields, lazily.

    ``spread`` first deals the documents out by id.  It pays only where they sit
    in fewer splits than there are cores; otherwise leave the scan's partitions.
    """
    stored = [tokens_name(name) for name in text_fields if tokens_name(name) in docs.columns]
    scope = Scope(docs.schema, text_fields, docs)
    tops = [nested_path(scope, name) or name for name in text_fields]
    docs = docs.select(id_col, *dict.fromkeys([*tops, *stored]))
    if spread:
        docs = docs.repartition(id_col)
    scope = Scope(docs.schema, text_fields, docs)
    parts, sizes, vocabulary, sources = [], [], [], {}
    for name in text_fields:
        path = nested_path(scope, name)
        if path is not None:
            # One row per child: its texts are counted like documents, and its postings name the parent.
            rows = docs.select(F.col(id_col).alias("_id"), F.explode(path).alias("_child"))
            f = scope.children(path, F.col("_child")).field(name)
        else:
            rows, f = docs.select(F.col(id_col).alias("_id"), *docs.columns), scope.field(name)
        if f is None:
            raise ValueError(f"no text field {name!r}")
        analysed = rows.select("_id", f.tokens.alias(tokens_name("text")))
        parts.append(_postings(analysed, name, positions))
        sources[name] = analysed
        size = F.size(tokens_name("text"))
        present = F.when(size > 0, size)
        sizes.append(
            analysed.agg(
                F.count(present).alias("n_docs"),
                F.coalesce(F.sum(present), F.lit(0)).alias("sum_dl"),
            ).select(F.lit(name).alias("field"), "n_docs", "sum_dl")
        )
        vocabulary.append(_vocabulary(analysed.select(F.explode(tokens_name("text")).alias("term")), name))
    postings = reduce(DataFrame.unionByName, parts)

    def blocks(buckets: int, means: dict[str, float]) -> DataFrame:
        return reduce(DataFrame.unionByName, [_blocks(rows, f, buckets, means.get(f)) for f, rows in sources.items()])

    return TextIndex(
        postings, term_stats(postings), reduce(DataFrame.unionByName, sizes), list(text_fields),
        docs.select(F.col(id_col).alias("_id")), vocabulary=reduce(DataFrame.unionByName, vocabulary), blocks=blocks,
    )


def _vocabulary(words: DataFrame, field: str) -> DataFrame:
    """The estimated number of terms: those whose hash is in one of ``HASH_PARTS`` parts are counted exactly.

    Every word is hashed and compared in compiled code; a sketch of all words costs several times that.
    """
    hashed = words.where("term is not null").select(F.xxhash64("term").alias("hash"))
    counted = hashed.where(F.pmod("hash", F.lit(HASH_PARTS)) == 0).agg((F.count_distinct("hash") * HASH_PARTS).alias("n_terms"))
    return counted.select(F.lit(field).alias("field"), "n_terms")


def nested_path(scope: Scope, name: str) -> str | None:
    """The array of children a field belongs to, if it does."""
    path = name.rpartition(".")[0]
    f = scope.field(path) if path else None
    return path if f is not None and f.is_array and isinstance(f.element_type, T.StructType) else None


def _postings(analysed: DataFrame, field: str, positions: bool) -> DataFrame:
    """One row per document and distinct term.

    Everything about a document comes from its own row, so this is a narrow step without a shuffle.
    Some documents at a time are handled as arrays, and their postings come out by term.
    """
    schema = T.StructType([
        T.StructField("_id", analysed.schema["_id"].dataType), T.StructField("dl", T.IntegerType()),
        T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ])
    make = _posting_batches(BATCH_TOKENS, BATCH_ROWS)
    rows = analysed.select("_id", tokens_name("text")).where(F.size(tokens_name("text")) > 0).mapInArrow(make, schema)
    return rows.select(F.lit(field).alias("field"), "_id", "dl", "term", "tf", *(["positions"] if positions else []))


def _blocks(analysed: DataFrame, field: str, buckets: int, mean: float | None) -> DataFrame:
    """The postings with those of a term, from some documents at a time, in one row.

    ``ids`` and ``dls`` have an entry for each posting; ``positions`` are those of all one after another, and ``ends``
    tells where each one's end, null if each has one.  Blocks come by bucket and term and their postings by impact, so
    the sort behind the exchange merges runs.
    """
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([
        T.StructField("bucket", T.IntegerType()), T.StructField("term", T.StringType()),
        T.StructField("ids", T.ArrayType(analysed.schema["_id"].dataType)), T.StructField("dls", ints),
        T.StructField("ends", ints), T.StructField("positions", ints),
    ])
    make = _posting_batches(BATCH_TOKENS, BATCH_ROWS, (field, buckets, mean or 1.0, BLOCK_POSTINGS))
    rows = analysed.select("_id", tokens_name("text")).where(F.size(tokens_name("text")) > 0).mapInArrow(make, schema)
    return rows.select(F.lit(field).alias("field"), "*")


def _of_blocks(blocks: DataFrame) -> DataFrame:
    """One row per posting of ``blocks``."""
    own = [c for c in ("field", "bucket", "term") if c in blocks.columns]
    rows = blocks.select(*own, F.posexplode("ids").alias("_i", "_id"), "dls", "ends", "positions")
    start = F.when(F.col("_i") == 0, F.lit(0)).otherwise(F.coalesce(F.get("ends", F.col("_i") - 1), F.col("_i")))
    tf = F.coalesce(F.get("ends", F.col("_i")), F.col("_i") + 1) - start
    return rows.select(
        *own, "_id", F.get("dls", F.col("_i")).alias("dl"), tf.alias("tf"), F.slice("positions", start + 1, tf).alias("positions")
    )


def _posting_batches(
    tokens_at_once: int, rows_at_once: int, laid: tuple[str, int, float, int] | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes the postings of batches of (_id, tokens); as blocks, if ``laid`` names the field, the number of
    buckets, the mean length and the most postings of a block.

    The functions are local, so they are sent whole and executors need not have this package.
    """
    b, k1 = scoring.B, scoring.K1

    def blocks(ids: pa.Array, dl: np.ndarray, term: np.ndarray, tf: np.ndarray, places: pa.Array, words: pa.Array, bucket: np.ndarray) -> pa.RecordBatch:
        at = np.arange(len(term))
        change = np.diff(term, prepend=-1) != 0
        begin = at - np.maximum.accumulate(np.where(change, at, 0))
        starts = np.flatnonzero(begin % laid[3] == 0)
        bounds = np.append(starts, len(term)).astype(np.int32)
        ends = np.cumsum(tf)
        total = np.append(0, ends)[bounds].astype(np.int32)
        each = np.diff(bounds)
        inside = (ends - np.repeat(total[:-1], each)).astype(np.int32)
        single = np.diff(total) == each
        own = np.append(0, np.cumsum(np.where(single, 0, each))).astype(np.int32)
        shown = term[starts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[shown]), words.take(pa.array(shown)), pa.ListArray.from_arrays(bounds, ids),
                pa.ListArray.from_arrays(bounds, pa.array(dl)),
                pa.ListArray.from_arrays(pa.array(own), pa.array(inside[~np.repeat(single, each)]), mask=pa.array(single)),
                pa.ListArray.from_arrays(total, places),
            ],
            ["bucket", "term", "ids", "dls", "ends", "positions"],
        )

    def postings(docs: pa.RecordBatch) -> pa.RecordBatch:
        # By term and about by impact, so that little is left to sort where they meet others.
        dl = pc.list_value_length(docs.column(1)).to_numpy(zero_copy_only=False).astype(np.int32)
        words = docs.column(1).flatten().dictionary_encode()
        order = pc.sort_indices(words.dictionary).to_numpy()
        if laid is not None:
            above = zlib.crc32(f"{laid[0]}\0".encode())
            named = words.dictionary.cast(pa.string()).cast(pa.binary()).take(pa.array(order)).to_pylist()
            bucket = np.array([zlib.crc32(word, above) % laid[1] for word in named], np.int32)
            by = np.argsort(bucket, kind="stable")
            order, bucket = order[by], bucket[by]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # A token's number stays in the low half, so equal terms keep the order of the text.
        known = np.flatnonzero(words.is_valid().to_numpy(zero_copy_only=False))
        key = np.sort((rank[words.indices.drop_null().to_numpy()] << 32) | known)
        token, term = key & 0xFFFFFFFF, key >> 32
        doc = np.repeat(np.arange(len(dl)), dl)[token]
        first = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        bounds = np.append(first, len(key)).astype(np.int32)
        places = (token - (np.cumsum(dl, dtype=np.int64) - dl)[doc]).astype(np.int32)
        own, tf = doc[first], np.diff(bounds)
        if laid is not None:
            impact = (k1 + 1) * tf / (tf + k1 * (1 - b + b * dl[own] / laid[2]))
            by = np.lexsort((-impact, term[first]))
            own = own[by]
            placed = pa.ListArray.from_arrays(pa.array(bounds), pa.array(places)).take(pa.array(by)).flatten()
            named = words.dictionary.cast(pa.string()).take(pa.array(order))
            return blocks(docs.column(0).take(pa.array(own)), dl[own], term[first[by]], tf[by], placed, named, bucket)
        weak = 1 / (1 + tf / (1 - b + b * dl[own] / max(dl.mean(), 1)))
        by = np.argsort((term[first] << 20) | (weak * (1 << 20)).astype(np.int64), kind="stable")
        own = own[by]
        return pa.RecordBatch.from_arrays(
            [
                docs.column(0).take(pa.array(own)), pa.array(dl[own]),
                words.dictionary.take(pa.array(order[term[first[by]]])).cast(pa.string()), pa.array(tf[by]),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(places)).take(pa.array(by)),
            ],
            ["_id", "dl", "term", "tf", "positions"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(ends, done + tokens_at_once, side="right")))
                found = postings(batch.slice(start, end - start))
                for at in range(0, found.num_rows, rows_at_once):
                    yield found.slice(at, rows_at_once)
                start = end

    return run


def term_stats(postings: DataFrame) -> DataFrame:
    """Document counts; of laid-out postings also the largest impact and the counts by level."""
    count = F.count(F.lit(1)).alias("df")
    if "impact" not in postings.columns:
        return postings.groupBy("field", "term").agg(count)
    # The largest possible impact is K1 + 1.
    levels = [F.count_if(F.col("impact") >= (scoring.K1 + 1) * (i + 1) / LEVELS) for i in range(LEVELS)]
    return postings.groupBy("bucket", "field", "term").agg(count, F.max("impact").alias("best"), F.array(*levels).alias("levels"))


def laid_out(index: TextIndex, postings: DataFrame) -> DataFrame:
    """New postings with the impact and the bucket they have in a saved index."""
    means = F.create_map(*[F.lit(x) for item in index.lengths.items() for x in item]) if index.lengths else F.lit(None).cast("map<string,double>")
    impact = scoring.bm25(F.lit(1.0), F.col("tf"), F.col("dl"), F.coalesce(means[F.col("field")], F.col("dl").cast("double")))
    return index.with_bucket(postings.withColumn("impact", impact))


def refresh_index(index: TextIndex, changed: DataFrame, id_col: str, text_fields: dict[str, str]) -> TextIndex:
    """Index after documents changed: their old postings out, their new ones in."""
    fresh = build_index(changed, id_col, text_fields, "positions" in index.postings.columns)
    gone = changed.select(F.col(id_col).alias("_id"))
    added = fresh.postings if index.buckets is None else laid_out(index, fresh.postings)
    postings = index.postings.join(gone, "_id", "left_anti").unionByName(added)
    per_doc = postings.groupBy("field", "_id").agg(F.max("dl").alias("dl"))
    sizes = per_doc.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("sum_dl"))
    documents = index.documents.join(gone, "_id", "left_anti").unionByName(fresh.documents)
    return TextIndex(
        postings, term_stats(postings), sizes, index.fields, documents, index.buckets, index.id_col, index.lengths
    )


def _with_child_tokens(scope: Scope, path: str, name: str) -> Column:
    """The children with the tokens of one of their texts beside it."""
    leaf = tokens_name(name[len(path) + 1:])
    return F.transform(path, lambda x: F.when(x.isNotNull(), x.withField(leaf, scope.children(path, x).field(name).tokens)))


def with_stored_tokens(docs: DataFrame, text_fields: dict[str, str]) -> DataFrame:
    """Documents with the tokens of their texts beside them."""
    scope = Scope(docs.schema, text_fields, docs)
    for name in text_fields:
        parent = nested_path(scope, name)
        if parent is None:
            docs = docs.withColumn(tokens_name(name), scope.field(name).tokens)
        else:
            docs = docs.withColumn(parent, _with_child_tokens(scope, parent, name))
    return docs


def prepare(collection: Collection, path: str, files: int | None = None, spread: bool = False) -> Collection:
    """Ingest-time analysis: write the documents with their tokens, and the index.

    Queries over the returned collection read stored tokens and counts instead
    of splitting every text again.
    """
    spark = collection.docs.sparkSession
    docs = collection.docs
    if spread:
        docs = docs.repartition(files or spark.sparkContext.defaultParallelism, collection.id_col)
    docs = with_stored_tokens(docs, collection.text_fields)
    docs.write.mode("overwrite").option("compression", CODEC).parquet(f"{path}/docs")
    docs = spark.read.parquet(f"{path}/docs")
    index = build_index(docs, collection.id_col, collection.text_fields).save(path, files, collection.id_col)
    return Collection(docs, collection.id_col, collection.text_fields, index)
