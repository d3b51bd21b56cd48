"""MinHash near-duplicates: universal hash minima, bands, verification, star components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, query, table
from .components import connected_components
from .grouping import by_cell, cells, spanning_links
from .text_hash import chunks, mixed, shingle_sets



class Bands:
    """``bands`` bands of ``rows`` universal hashes.

    A pair of similarity s shares no band with probability (1 - s**rows)**bands: with 25 bands of
    5, that is 4e-7 at 0.85 and 4e-5 at 0.8.
    """

    def __init__(self, bands: int = 25, rows: int = 5):
        draw = np.random.Generator(np.random.PCG64(85))
        self.bands, self.rows = bands, rows
        self.factors = draw.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.addends = draw.integers(0, 2**64, bands * rows, dtype=np.uint64)

    @classmethod
    def for_percent(cls, percent: float, miss: float = 5e-5, hashes: int = 128) -> Bands:
        """Bands that miss a pair of this similarity with a probability of ``miss`` at most: the longest
        that ``hashes`` minima allow, single minima where none do."""
        s = min(max(percent / 100, 1e-3), 1 - 1e-9)
        for rows in (5, 4, 3, 2, 1):
            bands = max(1, math.ceil(math.log(miss) / math.log1p(-(s**rows))))
            if bands * rows <= hashes or rows == 1:
                return cls(bands, rows)

    def minima(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Least value of each hash over each run of values: one row per run."""
        out = np.empty((len(starts), len(self.factors)), np.uint64)
        for k, (a, b) in enumerate(zip(self.factors, self.addends)):
            hashed = values * a
            hashed += b
            hashed >>= np.uint64(32)
            out[:, k] = np.minimum.reduceat(hashed, starts)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key per band; the band's number is part of it."""
        key = np.arange(1, self.bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        key = np.repeat(key, len(minima), 0)
        for r in range(self.rows):
            key = mixed(key ^ minima[:, r :: self.rows])
        return key.view(np.int64)


_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64())),
     ("minima", pa.binary())]
)
_SIGNED_SQL = "doc_id long, n long, digest binary, keys array<long>, minima binary"


def signatures(docs: DataFrame, bands: Bands, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: number of distinct shingles, digest of its set, band keys, 16 bits of each minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A few hundred texts at a time are Python objects, not a whole batch.
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, last, encoded in chunks(texts):
                sets = list(shingle_sets(encoded, width=width))
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                keys, minima = np.zeros((len(sets), bands.bands), np.int64), [None] * len(sets)
                if len(full):
                    starts = np.cumsum(np.concatenate([[0], sizes[full][:-1]]))
                    found = bands.minima(np.concatenate([sets[i] for i in full]), starts)
                    keys[full] = bands.keys(found)
                    short = found.astype(np.uint16)
                    for row, i in enumerate(full.tolist()):
                        minima[i] = short[row].tobytes()
                offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands.bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(sizes, pa.int64()),
                        pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel(), pa.int64())),
                        pa.array(minima, pa.binary()),
                    ],
                    schema=_SIGNED,
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, _SIGNED_SQL
    )


def _similar_by_minima(least_share: float, least_ratio: float):
    """Linker of cells by signatures: equal minima in at least this share, sizes in this ratio."""

    def link(part: pa.Table):
        ids, sizes = part.column("m_doc_id").to_numpy(), part.column("m_n").to_numpy()
        stacked = np.frombuffer(b"".join(part.column("m_minima").to_pylist()), np.uint16).reshape(len(ids), -1)
        needed = least_share * stacked.shape[1]
        same_cell = part.column("low")[0] == part.column("high")[0]

        def passing(i: int) -> np.ndarray:
            ratio = np.minimum(sizes, sizes[i]) >= least_ratio * np.maximum(sizes, sizes[i])
            return ratio & ((stacked == stacked[i]).sum(1) >= needed)

        a, b = spanning_links(len(ids), part.column("m_high").to_numpy(), same_cell, passing)
        return ids[a], ids[b]

    return link


def _similar_by_sets(percent: int, width: int):
    """Linker of cells by whole sets: 100 * intersection >= percent * union."""

    def link(part: pa.Table):
        ids = part.column("m_doc_id").to_numpy()
        sets = [s for _, _, run in chunks(part.column("m_text").to_pylist()) for s in shingle_sets(run, width=width)]
        full = [len(s) > 0 for s in sets]  # an id may be repeated by a row without words
        ids, sets = ids[full], [s for s in sets if len(s)]
        high = part.column("m_high").to_numpy()[full]
        sizes = np.array([len(s) for s in sets])
        values, places = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        marked = np.zeros(len(values), np.int32)
        same_cell = part.column("low")[0] == part.column("high")[0]

        def passing(i: int) -> np.ndarray:
            own = places[starts[i] : starts[i] + sizes[i]]
            marked[own] = 1
            shared = np.add.reduceat(marked[places], starts)
            marked[own] = 0
            return 100 * shared >= percent * (sizes + sizes[i] - shared)

        a, b = spanning_links(len(ids), high, same_cell, passing)
        return ids[a], ids[b]

    return link


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    width: int = 5,
    bands: Bands | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell_members: int = 2048,
    cell_shingles: int = 2_000_000,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of ``width``-word shingles have a Jaccard similarity of
    at least ``percent`` / 100 (found with a probability of 0.99995 or more each, unless ``bands`` says
    otherwise); a component is what links connect, named by its smallest id, and
    the document of that id is kept.

    Equal sets are one class and only its smallest id goes on.  Documents sharing a band are
    compared by their minima (an allowance of more than five standard deviations), which gives
    groups; inside a group whole sets are compared.  Groups beyond a cell's size are dealt out to
    pairs of slots, so no task holds a whole group.  Pairs already connected are skipped and never
    become rows.

    Null or empty text, or text of white space only: no shingles, linked with nothing, kept.
    A null id: linked with nothing, component null, kept.  Rows that repeat an id are each judged by
    their own text, and each is returned.  No rows give no rows.  Other columns are not read.
    """
    if bands is None:
        bands = Bands() if percent >= 80 else Bands.for_percent(percent)
    signed = materialise(signatures(docs, bands, width, id_col, text_col), "minhash")
    usable = signed.where("n > 0 and doc_id is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    chosen = usable.join(
        classes.select("digest", F.col("class_id").alias("doc_id")), ["digest", "doc_id"], "left_semi"
    ).dropDuplicates(["digest"])

    keyed = chosen.select("doc_id", F.explode("keys").alias("bucket"))
    buckets = keyed.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("doc_id").alias("first"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("all")
    ).where("members > 1")
    # The same documents often meet in many bands; one bucket stands for all with the same members.
    buckets = buckets.groupBy("members", "first", "all").agg(F.min("bucket").alias("bucket"))
    meeting = keyed.join(buckets.select("bucket", "members"), "bucket").withColumn("one", F.lit(1))
    meeting = meeting.join(chosen.select("doc_id", "n", "minima"), "doc_id")
    share = max(0.0, percent / 100 - 5.5 * (percent / 100 * (1 - percent / 100) / (bands.bands * bands.rows)) ** 0.5)
    dealt = cells(meeting, "bucket", "one", "members", cell_members)
    alike = by_cell(dealt, _similar_by_minima(share, percent / 100), "a long, b long")
    groups = connected_components(alike).select(F.col("node").alias("doc_id"), F.col("component").alias("group_id"))

    sized = groups.join(chosen.select("doc_id", "digest", "n"), "doc_id")
    totals = sized.groupBy("group_id").agg(F.sum("n").alias("total"))
    sized = sized.join(totals, "group_id").select("doc_id", "group_id", "n", "total").dropDuplicates(["doc_id"])
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.where("text is not null").join(sized, "doc_id")
    linked = by_cell(cells(texts, "group_id", "n", "total", cell_shingles), _similar_by_sets(percent, width), "a long, b long")
    components = connected_components(linked)

    rows = signed.join(classes, "digest", "left").join(
        components.select(F.col("node").alias("class_id"), "component"), "class_id", "left"
    )
    component = F.coalesce("component", "class_id", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


@query("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), percent=85)
