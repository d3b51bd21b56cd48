"""Reading documents into DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool = False, id_from: str = "file"
) -> DataFrame:
    """JSON documents, one object per file, or one per line if ``lines``.

    ``_id`` is the name of the file without its ending, or what stands behind ``key=`` in the name of its
    folder (``id_from="folder"``).  Without a schema Spark infers it, which reads the files once more.
    """
    if id_from not in ("file", "folder"):
        raise ValueError(f"ids come from 'file' or 'folder', not {id_from!r}")
    reader = spark.read.option("multiLine", not lines)
    docs = (reader.schema(schema) if schema is not None else reader).json(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 if id_from == "file" else -2)
    name = F.regexp_replace(name, r"\.[^.]*$" if id_from == "file" else "^[^=]*=", "")
    return docs.select(name.alias("_id"), "*")


def with_ids(docs: DataFrame, id_col: str = "_id") -> DataFrame:
    """Documents whose id is missing get a generated one.

    Ids of another type than string are kept as they are and have to be complete.
    """
    if id_col not in docs.columns:
        return docs.select(F.expr("uuid()").alias(id_col), "*")
    if not isinstance(docs.schema[id_col].dataType, T.StringType):
        return docs
    return docs.withColumn(id_col, F.coalesce(F.col(id_col), F.expr("uuid()")))


def last_wins(changes: DataFrame, id_col: str, seq_col: str | None) -> DataFrame:
    """The latest version of each document; without an order column one of them, see ``upsert``.

    ``max_by`` keeps one row per id already on the map side, so an id that was
    written very often does not gather in one task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in changes.columns])
    values = [F.col(f"`{name}`") for name, kind in changes.dtypes if "map<" not in kind and "variant" not in kind]
    # A struct is never NULL, so a missing number counts as the lowest.
    order = F.struct(F.col(seq_col) if seq_col is not None else F.xxhash64(*values))
    latest = changes.groupBy(F.col(id_col).alias("_key")).agg(F.max_by(row, order).alias("_row"))
    return latest.select("_row.*")


def upsert(current: DataFrame, changes: DataFrame, id_col: str = "_id", seq_col: str | None = None) -> DataFrame:
    """``current`` with changed documents replaced and new ones added.

    Of several changes of one id the last by ``seq_col`` counts.  Without an order column
    it is the one with the greatest hash of its values: any, but one and always the same.
    Fields known to only one side are NULL on the other.
    """
    changes = last_wins(changes, id_col, seq_col)
    if seq_col is not None and seq_col not in current.columns:
        changes = changes.drop(seq_col)
    untouched = current.join(changes.select(id_col), id_col, "left_anti")
    return untouched.unionByName(changes, allowMissingColumns=True)
