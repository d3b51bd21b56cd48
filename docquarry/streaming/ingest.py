"""Structured Streaming: continuous loads and standing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..operators import queries as q
from ..operators.compile import matching, scored


def append_changes(changes: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append a stream of changed documents to a folder of Parquet files.

    Spark's file sink notes which files are complete, so a reader of the folder sees each change
    once.  The current documents are ``upsert(base, spark.read.parquet(path), id, seq)``.  The
    caller chooses the trigger and starts the writer; the source's ``maxFilesPerTrigger`` sets the
    batch size.
    """
    return changes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def standing_query(documents: DataFrame, query: q.Query, text_fields: dict[str, str] | None = None) -> DataFrame:
    """Documents of a stream that match; stateless, so any trigger and sink will do."""
    return matching(documents, query, text_fields)


def standing_scores(documents: DataFrame, query: q.Query, text_fields: dict[str, str], index) -> DataFrame:
    """Matching documents of a stream with relevance against the statistics of a static index."""
    return scored(documents, query, text_fields, index)
