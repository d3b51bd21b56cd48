"""Completion: values of a field that start with what the user typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import as_array
from .topn import top_n_per_group

# Fixed value: number of suggestions if a request gives none.
DEFAULT_SUGGESTIONS = 5


def _in_categories(df: DataFrame, categories: dict[str, list] | None) -> DataFrame:
    for name, values in (categories or {}).items():
        dtype = df.schema[name].dataType
        column = F.col(name)
        if dtype.typeName() == "array":
            df = df.filter(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values])))
        else:
            df = df.filter(column.isin(*values))
    return df


def _options(df: DataFrame, field: str, weight: Column | None, payload: list[str], extra: list[str]) -> DataFrame:
    """One row per distinct suggestion: its best weight and the payload that came with it."""
    # max_by keeps a single row per group; the payload itself breaks ties.
    best = F.struct(F.col("_weight"), *[F.col(p) for p in payload])
    named = df.withColumn("_weight", F.lit(1).cast("long") if weight is None else weight)
    grouped = named.groupBy(*extra, F.col(field).alias("text")).agg(F.max(best).alias("_best"))
    return grouped.select(
        *extra, "text", F.col("_best._weight").alias("weight"), *[F.col(f"_best.{p}").alias(p) for p in payload]
    )


def suggest(
    docs: DataFrame,
    field: str,
    prefix: str,
    weight: str | Column | None = None,
    payload: list[str] | None = None,
    categories: dict[str, list] | None = None,
    size: int = DEFAULT_SUGGESTIONS,
) -> DataFrame:
    """``(text, weight, payload…)`` of the best ``size`` completions of ``prefix``."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    rows = _in_categories(docs, categories)
    rows = rows.withColumn(field, F.explode(as_array(F.col(field), docs.schema[field].dataType))) if docs.schema[
        field
    ].dataType.typeName() == "array" else rows
    rows = rows.filter(F.startswith(F.lower(F.col(field)), F.lit(prefix.lower())))
    options = _options(rows, field, weight, payload or [], [])
    return options.orderBy(F.col("weight").desc_nulls_last(), F.col("text").asc()).limit(size)


def suggest_batch(
    docs: DataFrame,
    field: str,
    prefixes: DataFrame,
    weight: str | Column | None = None,
    payload: list[str] | None = None,
    size: int = DEFAULT_SUGGESTIONS,
) -> DataFrame:
    """Completions for a table of ``(request_id, prefix)``.

    The values are reduced to one row each before they meet the prefixes.  They
    are joined on a fixed-length key, cut from both sides to the shortest prefix
    length of its group, so that the join stays an equi-join.
    """
    weight = F.col(weight) if isinstance(weight, str) else weight
    options = _options(docs.filter(F.col(field).isNotNull()), field, weight, payload or [], [])
    wanted = prefixes.select("request_id", F.lower("prefix").alias("_prefix"))
    wanted = wanted.withColumn("_len", F.length("_prefix"))
    lengths = wanted.select("_len").distinct()
    # One row per value and prefix length in use; that number is small and is
    # bounded by the longest value.
    keyed = options.withColumn("_len", F.explode(F.sequence(F.lit(0), F.length("text"))))
    keyed = keyed.join(lengths, "_len", "left_semi")
    keyed = keyed.withColumn("_prefix", F.substring(F.lower(F.col("text")), F.lit(1), F.col("_len")))
    # Only values under a wanted prefix stay, and of those the best of each prefix,
    # before they are spread to the requests that ask for it.
    keyed = keyed.join(wanted.select("_len", "_prefix").distinct(), ["_len", "_prefix"], "left_semi")
    order = [F.col("weight").desc_nulls_last(), F.col("text").asc()]
    best = top_n_per_group(keyed, ["_len", "_prefix"], order, size)
    return wanted.join(best, ["_len", "_prefix"]).drop("_len", "_prefix")


def count_suggestions(suggestions: DataFrame) -> DataFrame:
    return suggestions.agg(F.count(F.lit(1)).alias("count"))
