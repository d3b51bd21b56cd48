"""Exact top-k inner products by a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, query, table

CELLS = 16
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 1024
#: Parts of the vectors that are searched apart.
LANES = 64
#: A task holds queries of about so many components at once, with their results.
GROUP_VALUES = 1 << 20


def whole_numbers(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(F.coalesce(fit, F.lit(False)), whole)


def _narrow(exact: np.ndarray) -> np.ndarray:
    """The same numbers in the least of the signed types that holds them all."""
    if exact.size:
        least, most = exact.min(), exact.max()
        for kind in (np.int8, np.int16, np.int32):
            if np.iinfo(kind).min <= least and most <= np.iinfo(kind).max:
                return exact.astype(kind)
    return exact


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Block:
    """Vectors of one dimension: exact integers, and per component one of ``CELLS`` cells of its range.

    The cells, one byte per component, are what is scanned; an exact row is read only for a candidate.
    """

    def __init__(self, ids: np.ndarray, exact: np.ndarray):
        self.ids, self.exact = ids, exact
        self.low = exact.min(0).astype(np.float64)
        self.step = np.maximum((exact.max(0) - self.low + 1) / CELLS, 1e-9)
        self.cells = np.minimum((exact - self.low) / self.step, CELLS - 1).astype(np.uint8)

    def pack(self) -> tuple:
        exact = _narrow(self.exact)
        return (
            len(self.ids), exact.itemsize, self.ids.tobytes(), exact.tobytes(), self.cells.tobytes(), self.low.tobytes(), self.step.tobytes()
        )

    @classmethod
    def unpack(cls, n: int, item: int, ids: bytes, exact: bytes, cells: bytes, low: bytes, step: bytes) -> Block:
        block = cls.__new__(cls)
        block.ids, block.exact = np.frombuffer(ids, np.int64), np.frombuffer(exact, f"i{item}").reshape(n, -1)
        block.cells = np.frombuffer(cells, np.uint8).reshape(n, -1)
        block.low, block.step = np.frombuffer(low), np.frombuffer(step)
        return block

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of every query (row) and vector (column).

        A cell is its middle plus or minus half its step, so both bounds are two matrix products.
        A relative allowance covers the rounding of the sums.
        """
        middle = self.low + (self.cells + 0.5) * self.step
        centre = queries @ middle.T
        spread = (np.abs(queries) @ (self.step / 2))[:, None] * (1 + 1e-9) + np.abs(queries) @ np.abs(middle).T * 1e-12 + 1e-6
        return centre - spread, centre + spread


class Best:
    """The k best so far of some queries: scores descending, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.exact, self.k = ids, vectors, k
        self.floats = vectors.astype(np.float64)
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]

    def scan(self, block: Block) -> None:
        """Meet one block: bounds from the cells, then exact vectors in order of their bounds."""
        low, high = block.bounds(self.floats)
        own = block.ids[None, :] == self.ids[:, None]
        low[own], high[own] = -np.inf, -np.inf
        k = min(self.k, len(block.ids))
        sure = -np.partition(-low, k - 1, axis=1)[:, k - 1] if k == self.k else np.full(len(low), -np.inf)
        for row in range(len(self.ids)):
            scores, ids = self.found[row]
            # The k-th result is at least the k-th lower bound here and the k-th score so far.
            floor = max(sure[row], scores[-1] if len(scores) == self.k else -np.inf)
            open_ = np.flatnonzero((high[row] >= floor) & ~own[row])
            open_ = open_[np.argsort(-high[row][open_], kind="stable")]
            at = 0
            while at < len(open_):
                # A bound below the k-th exact score ends the search: no later vector can enter.
                if len(scores) == self.k and high[row][open_[at]] < scores[-1]:
                    break
                some = open_[at : at + max(self.k, 32)]
                at += len(some)
                scores = np.concatenate([scores, block.exact[some].astype(np.int64) @ self.exact[row]])
                ids = np.concatenate([ids, block.ids[some]])
                order = np.lexsort((ids, -scores))[: self.k]
                scores, ids = scores[order], ids[order]
            self.found[row] = scores, ids

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _ in self.found]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.ids, sizes)),
                pa.array(np.concatenate([i for _, i in self.found]) if sizes else np.zeros(0, np.int64), pa.int64()),
                pa.array(np.concatenate([s for s, _ in self.found]) if sizes else np.zeros(0, np.int64), pa.int64()),
            ],
            ["query_id", "vec_id", "score"],
        )


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, vectors) of at most ``size`` rows of one dimension."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        dims = vectors.value_lengths().to_numpy()
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            own = _matrix(vectors.take(pa.array(rows)), dim) if dim else np.zeros((len(rows), 0), np.int64)
            held.setdefault(dim, []).append((ids[rows], own))
            while sum(len(x) for x, _ in held[dim]) >= size:
                all_ids, all_rows = (np.concatenate(x) for x in zip(*held[dim]))
                yield dim, all_ids[:size], all_rows[:size]
                held[dim] = [(all_ids[size:], all_rows[size:])]
    for dim, parts in held.items():
        all_ids, all_rows = (np.concatenate(x) for x in zip(*parts))
        if len(all_ids):
            yield dim, all_ids, all_rows


_PACKED = "dim int, n int, item int, ids binary, exact binary, cells binary, low binary, step binary"


def _packed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, vectors in _blocks(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), *_fields(Block(ids, vectors))],
                ["dim", "n", "item", "ids", "exact", "cells", "low", "step"],
            )

    return run


def _fields(block: Block) -> list[pa.Array]:
    n, item, *data = block.pack()
    return [pa.array([n], pa.int32()), pa.array([item], pa.int32()), *(pa.array([x], pa.binary()) for x in data)]


def _search(k: int):
    """Rows are blocks, sorted by dimension and group of queries; a group's queries come first, the vectors pass them by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, best = None, set(), []
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if (row["dim"], row["group"]) != last:
                    yield from (b.rows() for b in best)
                    last, held, best = (row["dim"], row["group"]), set(), []
                data = [row[c] for c in ("n", "item", "ids", "exact", "cells", "low", "step")]
                if row["vectors"]:
                    block = Block.unpack(*data)
                    for b in best:
                        b.scan(block)
                elif row["ids"] not in held:
                    # Two lanes in one partition bring the same queries.
                    held.add(row["ids"])
                    ids = np.frombuffer(row["ids"], np.int64)
                    best.append(Best(ids, np.frombuffer(row["exact"], f"i{row['item']}").reshape(len(ids), -1).astype(np.int64), k))
        yield from (b.rows() for b in best)

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k vectors of the greatest inner product of
    floor(scale * x), ties to the smaller id, never the query's own id.

    Vectors become blocks of rows: one byte per component says which of 16 cells it lies in, and the
    exact integers lie beside.  Each block of queries meets each block of vectors of its dimension
    once; the cells give bounds on all scores, and exact vectors are read in order of their bounds
    until the k-th result is certain.  A task holds a group of queries and their results, while the
    vector blocks of its lanes pass by one at a time, so it returns k rows per query, not k per block.

    Vectors that are null or hold a null or non-finite component, and rows without id, take no part.
    Vectors of different lengths do not meet.  Repeated rows are candidates each, and a repeated
    query is answered once.  With fewer than k candidates all are returned; no rows give no rows.
    Scores are exact while they fit 64 bits.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), whole_numbers(vector_col, scale).alias("v"))
        return rows.where("id is not null and v is not null")

    file = materialise(prepared(vectors).mapInArrow(_packed(BLOCK_VECTORS), _PACKED), "vectors")
    asked = prepared(queries).dropDuplicates(["id"]).mapInArrow(_packed(BLOCK_QUERIES), _PACKED)
    # Of queries the exact numbers are read only.
    asked = asked.withColumns({c: F.lit(None).cast("binary") for c in ("cells", "low", "step")})
    asked = materialise(asked, "queries")
    values = asked.agg(F.sum(F.col("n").cast("long") * F.greatest("dim", F.lit(1)))).first()[0]
    groups = max(1, -(-(values or 0) // GROUP_VALUES))
    # Blocks are rows of one table, so neither side is ever broadcast and no pair of blocks is shuffled: a vector block
    # goes to its lane once for each group of queries, a query block to each lane.
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    passing = file.withColumns({"vectors": F.lit(True), "lane": dealt(LANES)}).withColumn("group", every(groups))
    waiting = asked.withColumns({"vectors": F.lit(False), "group": dealt(groups)}).withColumn("lane", every(LANES))
    blocks = passing.unionByName(waiting).repartition("dim", "group", "lane")
    found = blocks.sortWithinPartitions("dim", "group", "vectors").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")


_SQL = """WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
    ranks AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
           vec_id, score FROM scored)
    SELECT query_id, "rank", vec_id, score FROM ranks WHERE "rank" <= 20"""


@query("op1_topk_search", _SQL)
def op1_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))
