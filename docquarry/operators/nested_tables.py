"""Nested queries where the children are a table of their own, linked by a parent key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import queries as q
from .compile import DEFAULT_INNER_HITS, NESTED_SCORE_MODES, matching, scored
from .topn import top_n_per_group


def with_matching_child(
    parents: DataFrame, children: DataFrame, key: str, query: q.Query, text_fields: dict[str, str] | None = None
) -> DataFrame:
    """Parents with at least one matching child (semi join); a parent's children count once before the shuffle."""
    return parents.join(matching(children, query, text_fields).select(key).distinct(), key, "left_semi")


def without_matching_child(
    parents: DataFrame, children: DataFrame, key: str, query: q.Query, text_fields: dict[str, str] | None = None
) -> DataFrame:
    """Parents without any matching child (anti join)."""
    return parents.join(matching(children, query, text_fields).select(key).distinct(), key, "left_anti")


def score_by_children(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    query: q.Query,
    score_mode: str = "avg",
    text_fields: dict[str, str] | None = None,
) -> DataFrame:
    """Parents with a matching child, ``_score`` combined from those children.

    The children are reduced to one row per parent before the join, partly on
    the map side, so a parent with very many children stays harmless.
    """
    if score_mode not in NESTED_SCORE_MODES:
        raise ValueError(f"unknown score mode {score_mode!r}; expected one of {NESTED_SCORE_MODES}")
    hits = scored(children, query, text_fields)
    combine = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}.get(score_mode)
    score = F.lit(0.0) if combine is None else combine("_score")
    per_parent = hits.groupBy(key).agg(F.first(F.lit(0.0)).alias("_none") if combine is None else score.alias("_score"))
    if combine is None:
        per_parent = per_parent.withColumnRenamed("_none", "_score")
    return parents.join(per_parent, key)


def inner_hits(
    children: DataFrame,
    key: str,
    query: q.Query,
    order_id: list[str],
    size: int = DEFAULT_INNER_HITS,
    text_fields: dict[str, str] | None = None,
) -> DataFrame:
    """The best ``size`` matching children of each parent, one row per child."""
    hits = scored(children, query, text_fields)
    order = [F.col("_score").desc(), *[F.col(c).asc() for c in order_id]]
    return top_n_per_group(hits, [key], order, size)
