"""Streaming groups and cells in tasks, and links inside one cell."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(members: DataFrame, group: str, weight: str, total: str, most: int) -> DataFrame:
    """Deal the members of each group out to cells, so that each pair meets in a cell of bounded size.

    ``total`` is the sum of ``weight`` over the group.  A group of at most ``most`` is one cell; a
    larger one is cut into slots by a hash of ``doc_id``, and each pair of slots is a cell.  Adds
    ``cell`` (group, low slot, high slot) and ``high`` (whether the member is of the high slot).
    """
    slots = F.greatest(F.lit(1), F.ceil(F.col(total) / F.lit(most))).cast("int")
    dealt = members.withColumn("_slots", slots).withColumn(
        "_slot", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.col("_slots")).cast("int")
    )
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
    return dealt.select(
        F.struct(
            F.col(group).alias("group"),
            F.least("_slot", "_other").alias("low"),
            F.greatest("_slot", "_other").alias("high"),
        ).alias("cell"),
        (F.col("_slot") > F.col("_other")).alias("high"),
        *[c for c in members.columns if c not in (group, weight, total)],
    )


def by_cell(dealt: DataFrame, linker: Callable, schema: str) -> DataFrame:
    """Apply ``linker`` to the rows of each cell, as Arrow tables; yields links ``a, b``.

    Rows arrive sorted by cell, so a task holds one cell at a time, and many small cells cost no
    Python call of Spark's each.
    """
    columns = [c for c in dealt.columns if c != "cell"]
    keyed = dealt.select(F.xxhash64("cell.group", "cell.low", "cell.high").alias("_cell"), "cell.*", *[
        F.col(c).alias(f"m_{c}") for c in columns
    ])
    sorted_rows = keyed.repartition("_cell").sortWithinPartitions("_cell", "group", "low", "high")
    keys = ["_cell", "group", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches, keys):
            links = linker(part)
            if links is not None and len(links[0]):
                yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], ["a", "b"])

    return sorted_rows.mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of sorted batches; a run may lie across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for x in numbers:
            change |= x[1:] != x[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(x[a] for x in numbers)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def spanning_links(n: int, high: np.ndarray, same_cell: bool, passing: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Links of passing pairs that connect the same members as all passing pairs would.

    ``passing(i)`` tells for one member which members pass with it.  Members already connected are
    not asked again, so a group around one member takes one step.  In a cell of two slots only
    pairs across the slots count.
    """
    component = np.arange(n)
    left, right = [], []
    for i in range(n):
        open_ = component != component[i]
        if not same_cell:
            open_ &= high != high[i]
        if not open_.any():
            if same_cell and not (component != component[0]).any():
                break
            continue
        found = np.flatnonzero(passing(i) & open_)
        if len(found):
            merged = np.unique(component[found])
            component[np.isin(component, merged)] = component[i]
            left += [i] * len(found)
            right += found.tolist()
    return np.array(left, np.int64), np.array(right, np.int64)
