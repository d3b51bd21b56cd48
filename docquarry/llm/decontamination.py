"""Benchmark decontamination: an FM-index per shard of documents, searched for the benchmark's phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table
from .fm_index import FMIndex
from .text_hash import NOT_ALPHANUMERIC, chunks, word_hashes


class Phrases:
    """The distinct windows of some items: word codes from 1, and the items each window is from."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        hashes, places = [], [0]
        for _, _, run in chunks([text for _, text in items]):
            words, starts = word_hashes(run, NOT_ALPHANUMERIC)
            hashes.append(words)
            places += (places[-1] + starts[1:]).tolist()
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.vocabulary, codes = np.unique(words, return_inverse=True)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        rows, owners = [np.zeros((0, width), np.int32)], [np.zeros(0, np.int64)]
        for item, (a, b) in enumerate(zip(places, places[1:])):
            own = codes[a:b].astype(np.int32) + 1
            if 0 < len(own) < width:
                own = np.concatenate([np.zeros(width - len(own), np.int32), own])
            if len(own):
                windows = np.lib.stride_tricks.sliding_window_view(own, width)
                rows.append(windows)
                owners.append(np.full(len(windows), item))
        self.windows, window = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        self.lengths = (self.windows > 0).sum(1)
        owners = np.concatenate(owners)
        by_window = np.argsort(window.ravel(), kind="stable")
        self.owners = owners[by_window]
        self.owner_ends = np.cumsum(np.bincount(window.ravel(), minlength=len(self.windows)))
        self.ids = [i for i, _ in items]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Code of each word hash; 0 for words that no item has."""
        out = np.zeros(len(words), np.int32)
        near = np.flatnonzero(self.maybe[(words & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, words[near]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == words[near]
        out[near[same]] = at[same] + 1
        return out

    def search(self, encoded: list[bytes]):
        """For a shard of texts: words per text, start of each text, hit words, (text, item) pairs."""
        words, starts = word_hashes(encoded, NOT_ALPHANUMERIC)
        hit = np.zeros(len(words) + 1, bool)
        pairs = np.zeros((0, 2), np.int64)
        if len(words) and len(self.windows):
            # The shard's sequence keeps one 0 for each run of foreign words and for each end of a text.
            codes = self.codes(words)
            inner = starts[1:-1]
            origin = np.insert(np.arange(len(words)), inner, -1)
            codes = np.insert(codes, inner, 0)
            keep = np.ones(len(codes), bool)
            keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
            sequence = np.concatenate([[0], codes[keep], [0]])
            origin = np.concatenate([[-1], origin[keep], [-1]])
            found, places = FMIndex(sequence, self.bits).search(self.windows, self.lengths)
            begin = origin[places]
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + self.lengths[found], -1)
            hit = np.cumsum(cover) > 0
            text = np.searchsorted(starts, begin, side="right") - 1
            pairs = np.unique(np.stack([text, found], 1), axis=0)
            sizes = np.diff(self.owner_ends, prepend=0)[pairs[:, 1]]
            item = self.owners[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                               + np.repeat((self.owner_ends - np.diff(self.owner_ends, prepend=0))[pairs[:, 1]], sizes)]
            pairs = np.unique(np.stack([np.repeat(pairs[:, 0], sizes), item], 1), axis=0)
        return starts, hit, pairs


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items with an id and a text, streamed to the driver in runs of bounded size."""
    run, size = [], 0
    for row in items.where("_item is not null and _text is not null").toLocalIterator():
        if run and size + len(row[1]) > block_bytes:
            yield run
            run, size = [], 0
        run.append((row[0], row[1]))
        size += len(row[1])
    yield run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND_SQL = "_doc_id {id}, _text string, n_words long, items array<string>, spans array<struct<start:long,end:long>>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_bytes: int = 2_000_000,
    block_bytes: int = 2_000_000,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, items (sorted ids), spans (merged word ranges), contaminated.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased.  A
    window is ``width`` consecutive words of an item, or the whole item if it has fewer.  Words
    inside any occurrence of a window are hit; a document is contaminated if a twentieth of its
    words or more is hit.

    Each task indexes its documents in shards of about ``shard_bytes`` (a longer document is a
    shard of its own) and searches every phrase at once.  The benchmark comes to the tasks in
    blocks of at most ``block_bytes`` (or one item), one pass over the documents for each.

    Null or empty text has no words and is not contaminated.  Items without id, text or words have
    no windows; rows that repeat an item's id are parts of one item.  Repeated documents are each
    returned; empty tables give no rows, or rows without hits.  Other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    state = docs.select(
        F.col(id_col).alias("_doc_id"),
        F.col(text_col).alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
    )
    items = benchmark.select(F.col(item_col).cast("string").alias("_item"), F.col(item_text_col).alias("_text"))
    for block in _blocks(items, block_bytes):
        phrases = spark.sparkContext.broadcast(Phrases(block, width))
        state = state.mapInArrow(_searcher(phrases, shard_bytes), _FOUND_SQL.format(id=id_type))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return state.select(
        F.col("_doc_id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        "spans",
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _searcher(phrases, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table_ in _shards(batches, shard_bytes):
            found = phrases.value
            texts = table_.column("_text").to_pylist()
            starts, hit, pairs = found.search([b"" if t is None else t.encode() for t in texts])
            edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            items, spans = table_.column("items").to_pylist(), table_.column("spans").to_pylist()
            for text, item in pairs.tolist():
                items[text] = [*items[text], found.ids[item]]
            # A run of hit words may go on from one text into the next.
            for a, b in zip(begin.tolist(), end.tolist()):
                while a < b:
                    text = int(np.searchsorted(starts, a, side="right")) - 1
                    cut = min(b, int(starts[text + 1]))
                    spans[text] = _merged([*spans[text], {"start": a - int(starts[text]), "end": cut - int(starts[text])}])
                    a = cut
            yield pa.RecordBatch.from_arrays(
                [
                    table_.column("_doc_id").combine_chunks(),
                    table_.column("_text").combine_chunks(),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, _SPANS),
                ],
                ["_doc_id", "_text", "n_words", "items", "spans"],
            )

    return run


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and span["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], span["end"])}
        else:
            out.append(span)
    return out


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.Table]:
    """Consecutive rows of about ``shard_bytes`` of text."""
    held, size = [], 0
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
        first = 0
        for row, length in enumerate(lengths.tolist()):
            if size and size + length > shard_bytes:
                held.append(batch.slice(first, row - first))
                yield pa.Table.from_batches(held)
                held, size, first = [], 0, row
            size += length
        held.append(batch.slice(first))
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
