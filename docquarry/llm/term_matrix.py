"""A sparse document-term matrix in shards: words get codes of one dictionary of the whole table."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise

#: A shard holds about so many bytes of text (one text at least); its words are one local dictionary.
SHARD_BYTES = 32 << 20
_PIECE = 1 << 20
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: bytes) -> Counter:
    """Counts of the maximal runs without ASCII white space; long texts are split a piece at a time."""
    if len(text) <= _PIECE:
        return Counter(text.split())  # bytes split at exactly \x20 and \x09 to \x0D
    counts, at = Counter(), 0
    while at < len(text):
        end = _BREAK.search(text, at + _PIECE)
        end = end.start() if end else len(text)
        counts.update(text[at:end].split())
        at = end
    return counts


@dataclass
class Shard:
    """Some rows of the matrix: row i has the terms ``terms[starts[i]:starts[i + 1]]``, so often as ``counts`` tells."""

    rows: pa.Table
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray

    def row_sums(self) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])[self.starts])

    def nonzeros(self) -> np.ndarray:
        return np.diff(self.starts)


def encode(docs: DataFrame, text_col: str, facts: Callable[[bytes], tuple], fact_types: list[tuple], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The texts by local dictionaries, written once: rows of documents and rows of the dictionaries' words.

    A document's row has the other columns of ``docs``, ``facts`` of its text, and its terms in order with their
    counts; a term's two halves are apart, as the high ones hardly differ and so take little room.  A word's row has ``local`` and ``word``.
    Both name their shard.  Null texts are empty.
    """
    kept = [c for c in docs.columns if c != text_col]
    fields = [(f"k{i}", to_arrow_type(docs.schema[c].dataType)) for i, c in enumerate(kept)]
    fields += [("digest", pa.binary()), *[(n, t) for n, t, _ in fact_types], ("low", pa.binary()), ("high", pa.binary()), ("counts", pa.binary())]
    schema = pa.schema([("shard", pa.int64()), *fields, ("local", pa.int32()), ("word", pa.binary())])
    spark_types = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    spark_types += ["digest binary", *[f"{n} {s}" for n, _, s in fact_types], "low binary, high binary, counts binary"]
    ddl = ", ".join(["shard long", *spark_types, "local int", "word binary"])

    def filled(columns: dict[str, object], n: int) -> pa.RecordBatch:
        arrays = [columns.get(f.name, None) for f in schema]
        arrays = [pa.nulls(n, f.type) if a is None else a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def words(shard: int, local: dict) -> Iterator[pa.RecordBatch]:
        listed = list(local)
        for at in range(0, len(listed), 50_000):
            some = listed[at : at + 50_000]
            yield filled({"shard": [shard] * len(some), "local": np.arange(at, at + len(some), dtype=np.int32), "word": some}, len(some))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = TaskContext.get().partitionId() << 32, 0
        local: defaultdict = defaultdict()
        local.default_factory = local.__len__
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            found, held = defaultdict(list), 0
            for text in batch.column(len(kept)).cast(pa.binary()).to_pylist():
                text = text or b""
                counted = words_of(text)
                found["shard"].append(shard)
                found["digest"].append(hashlib.sha256(text).digest())
                for (name, *_), value in zip(fact_types, facts(text)):
                    found[name].append(value)
                terms = np.fromiter(map(local.__getitem__, counted), np.uint32, len(counted))
                order = np.argsort(terms)
                terms = terms[order]
                found["low"].append(terms.astype(np.uint16).tobytes())
                found["high"].append((terms >> 16).astype(np.uint16).tobytes())
                found["counts"].append(np.fromiter(counted.values(), np.int32, len(counted))[order].tobytes())
                size, held = size + len(text), held + 1
                if size >= shard_bytes:
                    yield filled(found | {f"k{i}": _part(batch, i, held - len(found["shard"]), held) for i in range(len(kept))}, len(found["shard"]))
                    yield from words(shard, local)
                    shard, size, found = shard + 1, 0, defaultdict(list)
                    local.clear()
            if found:
                n = len(found["shard"])
                yield filled(found | {f"k{i}": _part(batch, i, held - n, held) for i in range(len(kept))}, n)
        yield from words(shard, local)

    return materialise(docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`")).mapInArrow(run, ddl), "term-rows")


def _part(batch: pa.RecordBatch, column: int, first: int, last: int) -> pa.Array:
    return batch.column(column).slice(first, last - first)


def dictionary(encoded: DataFrame) -> DataFrame:
    """(shard, local, word, term): the code of each local word in the dictionary of all shards.

    A term is the word's hash bucket (16 bits) and its rank among the bucket's words, so equal words get one
    code and different ones never do, without a table of words that tasks would have to hold.
    """
    words = encoded.where("local is not null").select("shard", "local", "word")
    words = words.withColumn("bucket", F.shiftrightunsigned(F.xxhash64("word"), 48))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word")).cast("long")
    return words.select("shard", "local", "word", F.shiftleft("bucket", 40).bitwiseOR(rank).alias("term"))


def over_shards(encoded: DataFrame, reduced: Callable[[Shard], pa.Table], schema: str) -> DataFrame:
    """Build each shard with the dictionary's codes and reduce it; a task holds one shard at a time."""
    rows = encoded.where("counts is not null").drop("local", "word")
    codes = dictionary(encoded).select("shard", "local", "term")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        terms_of = np.zeros(right.num_rows, np.int64)
        terms_of[right.column("local").to_numpy()] = right.column("term").to_numpy()
        runs = left.column("counts").to_pylist()
        starts = np.concatenate([[0], np.cumsum([len(r) // 4 for r in runs], dtype=np.int64)])
        low, high = (np.frombuffer(b"".join(left.column(c).to_pylist()), np.uint16) for c in ("low", "high"))
        terms = terms_of[low.astype(np.int64) | (high.astype(np.int64) << 16)]
        counts = np.frombuffer(b"".join(runs), np.int32)
        return reduced(Shard(left.drop_columns(["low", "high", "counts"]), starts, terms, counts))

    return rows.groupBy("shard").cogroup(codes.groupBy("shard")).applyInArrow(run, schema)
