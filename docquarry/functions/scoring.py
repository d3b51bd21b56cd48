"""Relevance arithmetic: BM25, score modifiers and ways to combine scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def idf(n_docs: Column, doc_freq: Column) -> Column:
    """Inverse document frequency, always positive."""
    n, df = n_docs.cast("double"), doc_freq.cast("double")
    return F.ln(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25(weight: Column, freq: Column, length: Column, average_length: Column) -> Column:
    """BM25 of one term: ``weight`` is its idf (or a sum of idfs for a phrase)."""
    tf = freq.cast("double")
    norm = F.lit(1 - B) + F.lit(B) * length.cast("double") / average_length
    return F.lit(K1 + 1) * weight * tf / (tf + F.lit(K1) * norm)


MODIFIERS = {
    "none": lambda x: x,
    "log": lambda x: F.log10(x),
    "log1p": lambda x: F.log10(x + F.lit(1.0)),
    "log2p": lambda x: F.log10(x + F.lit(2.0)),
    "ln": lambda x: F.ln(x),
    "ln1p": lambda x: F.log1p(x),
    "ln2p": lambda x: F.ln(x + F.lit(2.0)),
    "square": lambda x: x * x,
    "sqrt": lambda x: F.sqrt(x),
    "reciprocal": lambda x: F.try_divide(F.lit(1.0), x),
}


def modifier(name: str, value: Column) -> Column:
    try:
        return MODIFIERS[name.lower()](value)
    except KeyError:
        raise ValueError(f"unknown modifier {name!r}; expected one of {sorted(MODIFIERS)}") from None


def combine(mode: str, score: Column, function: Column) -> Column:
    """Combine a query score with a function value."""
    if mode == "multiply":
        return score * function
    if mode == "replace":
        return function
    if mode == "sum":
        return score + function
    if mode == "avg":
        return (score + function) / F.lit(2.0)
    if mode == "max":
        return F.greatest(score, function)
    if mode == "min":
        return F.least(score, function)
    raise ValueError(f"unknown boost mode {mode!r}")


def total(columns: list[Column]) -> Column:
    """Sum of columns, ``0.0`` for none."""
    return reduce(lambda a, b: a + b, columns) if columns else F.lit(0.0)


def largest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns) if columns else F.lit(False)


def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns) if columns else F.lit(True)


def boosted(score: Column, boost: float) -> Column:
    """Multiply by a boost, leaving the expression alone when it changes nothing."""
    return score if boost == 1 else score * F.lit(float(boost))
