"""Sorting, pages, keyset pages, hit totals and full export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import field_type
from ..session import shared_folder

STORAGE_ORDER = ("_doc", "_shard_doc")
PRESETS = ("date", "date_and_relevance", "relevance")


@dataclass(frozen=True)
class Sort:
    field: str
    descending: bool = False


def sort_preset(name: str, date_field: str) -> list[Sort]:
    """Named sort orders over a date field and the score, newest and best first."""
    if name == "date":
        return [Sort(date_field, True)]
    if name == "date_and_relevance":
        return [Sort(date_field, True), Sort("_score", True)]
    if name == "relevance":
        return [Sort("_score", True)]
    raise ValueError(f"unknown sort preset {name!r}; expected one of {PRESETS}")


def resolve_sort(df: DataFrame, sort: list[Sort] | None, id_col: str) -> list[Sort]:
    """Sort keys that exist, ending in the document id so that the order is total."""
    if not sort:
        sort = [Sort("_score", True)] if "_score" in df.columns else []
    keys: list[Sort] = []
    for s in sort:
        name = id_col if s.field in STORAGE_ORDER else s.field
        if name in [k.field for k in keys] or field_type(df.schema, name) is None:
            continue
        keys.append(Sort(name, s.descending))
    if id_col not in [k.field for k in keys]:
        keys.append(Sort(id_col))
    return keys


def _key(df: DataFrame, s: Sort) -> Column:
    """Multi-valued fields sort by their largest or smallest value."""
    if field_type(df.schema, s.field).typeName() == "array":
        return F.array_max(F.col(s.field)) if s.descending else F.array_min(F.col(s.field))
    return F.col(s.field)


def order_by(df: DataFrame, sort: list[Sort]) -> list[Column]:
    """Documents without the field come last in both directions."""
    return [
        _key(df, s).desc_nulls_last() if s.descending else _key(df, s).asc_nulls_last() for s in sort
    ]


def page(df: DataFrame, sort: list[Sort], start: int, rows: int, limit: int | None = None) -> DataFrame:
    """Rows ``start`` to ``start + rows`` of the sorted documents; negative rows give none."""
    if rows < 0:
        return df.limit(0)
    if limit is not None:
        rows = min(rows, max(0, limit))
    ordered = df.orderBy(*order_by(df, sort))
    return (ordered.offset(start) if start else ordered).limit(rows)


def first_rows(df: DataFrame, sort: list[Sort], limit: int) -> DataFrame:
    """The first ``limit`` sorted documents, however many that are, without gathering them in one task.

    A range sort is kept in a checkpoint; the counts of its partitions, one number each, say by their running
    sum where each partition begins, and so which rows lie before the cut.  The sort and the counts run at once.
    """
    if limit <= 0:
        return df.limit(0)
    shared_folder(df.sparkSession)
    ordered = df.orderBy(*order_by(df, sort)).checkpoint(eager=True)
    # A row's id is its partition's number and its place in it.
    placed = ordered.withColumn("_row_id", F.monotonically_increasing_id())
    placed = placed.withColumns({"_part": F.shiftright("_row_id", 33), "_at": F.col("_row_id").bitwiseAND((1 << 33) - 1)})
    # One row per partition: the driver knows their number anyway.
    counts = sorted(tuple(r) for r in placed.groupBy("_part").count().collect())
    begin, kept = 0, F.lit(True)
    for part, n in counts:
        if begin + n >= limit:
            # All partitions before this one are whole, and none after it is needed.
            kept = (F.col("_part") < part) | ((F.col("_part") == part) & (F.col("_at") < limit - begin))
            break
        begin += n
    return placed.filter(kept).drop("_row_id", "_part", "_at")


def after(df: DataFrame, sort: list[Sort], last: list) -> DataFrame:
    """Documents strictly after the sort values ``last``, in the given order.

    Each key compares in its own direction.  NULL sorts last, so after a value
    comes every greater value and then NULL; after NULL comes nothing.
    """
    if len(last) != len(sort):
        raise ValueError(f"{len(sort)} sort keys but {len(last)} values to continue from")
    condition, equal = F.lit(False), F.lit(True)
    for s, value in zip(sort, last):
        key = _key(df, s)
        if value is None:
            beyond, same = F.lit(False), key.isNull()
        else:
            literal = F.lit(value)
            beyond = (key < literal if s.descending else key > literal) | key.isNull()
            same = F.coalesce(key == literal, F.lit(False))
        condition = condition | (equal & F.coalesce(beyond, F.lit(False)))
        equal = equal & same
    result = df.filter(condition)
    if last and last[0] is not None:
        # Redundant, but a plain comparison is what a Parquet scan can skip by.
        first, key = sort[0], _key(df, sort[0])
        literal = F.lit(last[0])
        result = result.filter((key <= literal if first.descending else key >= literal) | key.isNull())
    return result


def keyset_page(df: DataFrame, sort: list[Sort], last: list | None, rows: int) -> DataFrame:
    """The next ``rows`` documents after ``last`` (the first ones if it is None)."""
    remaining = df if last is None else after(df, sort, last)
    return page(remaining, sort, 0, rows)


def count_hits(matched: DataFrame) -> DataFrame:
    """One row: the number of matching documents."""
    return matched.agg(F.count(F.lit(1)).alias("count"))


def total_hits(matched: DataFrame, track_up_to: int | None = None) -> DataFrame:
    """One row ``(value, relation)``; the value is at most the ceiling.

    A plain count sends one number per partition, where a limit would gather rows.
    """
    if track_up_to is None:
        return matched.agg(F.count(F.lit(1)).alias("value")).withColumn("relation", F.lit("EQUAL_TO"))
    return matched.agg(F.count(F.lit(1)).alias("n")).select(
        F.least(F.col("n"), F.lit(track_up_to).cast("long")).alias("value"),
        F.when(F.col("n") > track_up_to, F.lit("GREATER_THAN_OR_EQUAL_TO"))
        .otherwise(F.lit("EQUAL_TO"))
        .alias("relation"),
    )
