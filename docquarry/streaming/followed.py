"""An index that follows a stream of changed documents.

Every micro-batch adds its own tables beside a prepared collection, each below ``batch=N``:

``versions``       _id, seq, deleted of each changed document
``docs``           the new versions with their tokens
``postings``       their postings, partitioned by bucket like those of the base
``term_changes``   bucket, field, term with what the batch adds to document counts and levels, or takes off
``field_changes``  field with what it adds to the number of documents and their length, or takes off
``commits``        one row, written last

Statistics are not counted again: the old versions of the changed documents are taken off and
the new ones added.  A batch looks at earlier ones only and overwrites what an interrupted try
left, so a restart repeats it with the same result; readers see committed batches only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.joins import Requests, settle
from ..plans.index import LEVELS, TextIndex, build_index, laid_out, term_stats, with_stored_tokens
from ..plans.search import Collection
from ..sources.documents import last_wins


class FollowedIndex:
    """A prepared collection and the changes a stream has added to it, kept in the folder ``path``.

    ``seq_col`` orders the changes of a document: of several the greatest counts, in whatever order
    they arrive; without it the latest batch counts.  Changes whose ``deleted_col`` is true remove
    their document.  Changes without an id are left out; missing columns are NULL.
    """

    def __init__(self, base: Collection, path: str, seq_col: str | None = None, deleted_col: str | None = None):
        if base.index is None or base.index.buckets is None:
            raise ValueError("only a prepared collection can be followed")
        self.base, self.path, self.seq_col, self.deleted_col = base, path, seq_col, deleted_col
        self.id_col = base.id_col
        plain = [f for f in base.docs.schema if f.name in base.source_columns]
        self.source = T.StructType(plain)

    # -- writing ---------------------------------------------------------------
    def follow(self, changes: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer that adds each micro-batch; the caller chooses the trigger and starts it."""
        return changes.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint)

    def add(self, changes: DataFrame, batch: int) -> None:
        spark, index = changes.sparkSession, self.base.index
        before = self._versions(spark, batch - 1)
        latest = last_wins(changes.where(F.col(self.id_col).isNotNull()), self.id_col, self.seq_col)
        seq = F.col(self.seq_col) if self.seq_col else F.lit(None)
        deleted = F.coalesce(F.col(self.deleted_col).cast("boolean"), F.lit(False)) if self.deleted_col else F.lit(False)
        incoming = latest.withColumns({"_seq": seq.cast("long"), "_deleted": deleted})
        known = before.select(F.col("_id").alias("_known"), F.col("seq").alias("_before"))
        incoming = incoming.join(known, incoming[self.id_col] == F.col("_known"), "left")
        # A late change does not undo a newer one.
        incoming = incoming.where("_before is null or _seq >= _before").drop("_known", "_before")
        incoming = incoming.select(
            *[(F.col(f"`{f.name}`") if f.name in changes.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.source],
            "_seq", "_deleted",
        )
        incoming = incoming.checkpoint(eager=True)
        versions = incoming.select(F.col(self.id_col).alias("_id"), F.col("_seq").alias("seq"), F.col("_deleted").alias("deleted"))
        self._write(versions, "versions", batch)

        fresh = with_stored_tokens(incoming.where("not _deleted").drop("_seq", "_deleted"), self.base.text_fields)
        self._write(fresh.select(*self.base.docs.columns), "docs", batch)
        fresh = self._read(spark, "docs", self.base.docs.schema).where(F.col("batch") == batch).drop("batch")
        ids = settle(versions.select("_id"))
        old = self._documents(spark, batch - 1, ids)

        new_index, old_index = self._index_of(fresh), self._index_of(old)
        postings = laid_out(index, new_index.postings)
        postings = postings.repartition("bucket").sortWithinPartitions("bucket", "field", "term", F.desc("impact"))
        self._write(postings, "postings", batch, "bucket")
        added = term_stats(self._postings(spark).where(F.col("batch") == batch).drop("batch"))
        gone = term_stats(laid_out(index, old_index.postings)).withColumns(
            {"df": -F.col("df"), "best": F.lit(None).cast("double"), "levels": F.transform("levels", lambda n: -n)}
        )
        self._write(added.unionByName(gone).repartition("bucket"), "term_changes", batch, "bucket")
        less = old_index.field_stats.select("field", (-F.col("n_docs")).alias("n_docs"), (-F.col("sum_dl")).alias("sum_dl"))
        self._write(new_index.field_stats.unionByName(less).coalesce(1), "field_changes", batch)
        self._write(spark.range(1).select(F.lit(batch).alias("last")), "commits", batch)

    def _index_of(self, docs: DataFrame) -> TextIndex:
        return build_index(docs, self.id_col, self.base.text_fields, "positions" in self.base.index.postings.columns)

    def _write(self, rows: DataFrame, name: str, batch: int, *by: str) -> None:
        rows.write.mode("overwrite").partitionBy(*by).parquet(f"{self.path}/{name}/batch={batch}")

    # -- reading ---------------------------------------------------------------
    def _read(self, spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
        """A table of all batches; without a batch it has no rows."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*[f for f in schema if f.name != "batch"], T.StructField("batch", T.IntegerType())])
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _versions(self, spark: SparkSession, last: int) -> DataFrame:
        """(_id, batch, seq, deleted) of each changed document as of a batch."""
        kind = self.base.docs.schema[self.id_col].dataType.simpleString()
        rows = self._read(spark, "versions", f"_id {kind}, seq long, deleted boolean").where(F.col("batch") <= last)
        newest = rows.groupBy("_id").agg(F.max_by(F.struct("batch", "seq", "deleted"), "batch").alias("at"))
        return newest.select("_id", "at.*")

    def _postings(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "postings", self.base.index.postings.schema)

    def _documents(self, spark: SparkSession, last: int, only: Requests | None = None) -> DataFrame:
        """The documents as of a batch; those of some ids only, if given."""
        versions = self._versions(spark, last)
        changed = self._read(spark, "docs", self.base.docs.schema).where(F.col("batch") <= last)
        base = self.base.docs
        if only is not None:
            wanted = only.hinted().select(F.col("_id").alias(self.id_col))
            base, changed = base.join(wanted, self.id_col, "left_semi"), changed.join(wanted, self.id_col, "left_semi")
        versions = settle(versions.select(F.col("_id").alias(self.id_col), "batch", "deleted"))
        kept = base.join(versions.hinted().select(self.id_col), self.id_col, "left_anti")
        newest = changed.join(versions.hinted().where("not deleted").select(self.id_col, "batch"), [self.id_col, "batch"], "left_semi")
        return kept.select(*self.base.docs.columns).unionByName(newest.select(*self.base.docs.columns))

    def last_batch(self, spark: SparkSession) -> int:
        """The last batch that is complete, -1 before the first."""
        found = self._read(spark, "commits", "last int").agg(F.max("batch")).first()[0]
        return -1 if found is None else found

    def current(self) -> Collection:
        """The collection with every committed change, to be searched like any prepared one.

        ``plans.index.prepare`` of its documents makes a new base when the changes have grown large.
        """
        spark, index = self.base.docs.sparkSession, self.base.index
        last = self.last_batch(spark)
        versions = settle(self._versions(spark, last))
        gone = versions.hinted().select("_id")
        newest = versions.hinted().where("not deleted").select("_id", "batch")
        added = self._postings(spark).where(F.col("batch") <= last).join(newest, ["_id", "batch"], "left_semi").drop("batch")
        postings = index.postings.join(gone, "_id", "left_anti").unionByName(added)

        changes = self._read(spark, "term_changes", index.term_stats.schema).where(F.col("batch") <= last).drop("batch")
        levels = F.array(*[F.sum(F.get("levels", F.lit(i))) for i in range(LEVELS)]).alias("levels")
        # The largest impact stays a bound when its document goes.
        terms = index.term_stats.unionByName(changes).groupBy("bucket", "field", "term")
        terms = terms.agg(F.sum("df").alias("df"), F.max("best").alias("best"), levels).where("df > 0")
        sizes = self._read(spark, "field_changes", index.field_stats.schema).where(F.col("batch") <= last).drop("batch")
        sizes = index.field_stats.unionByName(sizes).groupBy("field")
        sizes = sizes.agg(F.sum("n_docs").alias("n_docs"), F.sum("sum_dl").alias("sum_dl"))
        documents = index.documents.join(gone, "_id", "left_anti").unionByName(newest.select("_id"))
        followed = TextIndex(postings, terms, sizes, index.fields, documents, index.buckets, index.id_col, index.lengths)
        return Collection(self._documents(spark, last), self.id_col, self.base.text_fields, followed)
