"""Phrases over an array of tokens: does one occur, and how often."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import bound


def phrase_matches(tokens: Column, terms: list[str], slop: int, prefix: bool = False) -> Column:
    if slop == 0:
        line = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
        return F.contains(line, F.lit(" " + " ".join(terms) + ("" if prefix else " ")))
    return phrase_frequency(tokens, terms, slop, prefix) > 0


def phrase_frequency(tokens: Column, terms: list[str], slop: int, prefix: bool = False) -> Column:
    """Number of occurrences; a sloppy one counts ``1 / (1 + distance)``."""
    if len(terms) == 1:
        return F.size(F.filter(tokens, lambda x: _is_term(x, terms, 0, prefix)))
    if slop == 0:
        return bound(tokens, lambda t: _exact_frequency(t, terms, prefix))
    places = F.array(
        *[
            F.struct(F.lit(term).alias("term"), _offsets(tokens, terms, j, prefix).alias("offsets"))
            for j, term in enumerate(terms)
        ]
    )
    return bound(places, lambda p: sloppy_frequency(p, F.lit(slop)))


def _is_term(token: Column, terms: list[str], j: int, prefix: bool) -> Column:
    if prefix and j == len(terms) - 1:
        return F.startswith(token, F.lit(terms[j]))
    return token == F.lit(terms[j])


def _exact_frequency(tokens: Column, terms: list[str], prefix: bool) -> Column:
    last_start = F.size(tokens) - F.lit(len(terms))

    def starts_here(i: Column) -> Column:
        test = _is_term(F.get(tokens, i), terms, 0, prefix)
        for j in range(1, len(terms)):
            test = test & _is_term(F.get(tokens, i + F.lit(j)), terms, j, prefix)
        return test

    starts = F.filter(F.sequence(F.lit(0), F.greatest(last_start, F.lit(0))), starts_here)
    return F.when(last_start >= 0, F.size(starts)).otherwise(F.lit(0))


def _offsets(tokens: Column, terms: list[str], j: int, prefix: bool) -> Column:
    """Offsets ``p - j`` of the term ``j`` at positions ``p``; ``array<int>``."""
    at = F.transform(tokens, lambda x, i: F.when(_is_term(x, terms, j, prefix), i - F.lit(j)))
    return F.array_compact(at)


def exact_frequency(places: Column) -> Column:
    """Number of offsets all terms share; ``places`` is ``array<struct<term, offsets>>``."""
    offsets = F.transform(places, lambda p: p["offsets"])
    first, rest = F.get(offsets, F.lit(0)), F.slice(offsets, F.lit(2), F.size(offsets))
    return F.size(F.aggregate(rest, first, lambda shared, o: F.array_intersect(shared, o)))


def sloppy_frequency(places: Column, slop: Column) -> Column:
    """Weight of the sets of offsets, one per term, that span at most ``slop``.

    Windows are taken from their smallest offset; on a tie the earlier term of
    the phrase comes first.  A window is skipped if the same term occurs again
    before any other term of the window starts, as the later occurrence gives
    the tighter window.
    """

    def window(own: Column, j: Column, start: Column) -> Column:
        def nearest(other: Column, i: Column) -> Column:
            def usable(o: Column) -> Column:
                after = (o > start) | ((o == start) & (i > j))
                # One position cannot serve two places of a repeated term.
                clash = (other["term"] == own["term"]) & (o + i == start + j)
                return after & ~clash

            return F.when(i != j, F.array_min(F.filter(other["offsets"], usable)))

        ahead = F.array_compact(F.transform(places, nearest))
        again = F.array_min(F.filter(own["offsets"], lambda o: o > start))
        return F.struct(
            (F.size(ahead) == F.size(places) - F.lit(1)).alias("complete"),
            (F.array_max(ahead) - start).alias("span"),
            (again.isNull() | (again > F.array_min(ahead))).alias("tight"),
        )

    def weight(w: Column) -> Column:
        counts = w["complete"] & w["tight"] & (w["span"] <= slop)
        return F.when(counts, F.lit(1.0) / (F.lit(1.0) + w["span"])).otherwise(F.lit(0.0))

    windows = F.flatten(
        F.transform(places, lambda own, j: F.transform(own["offsets"], lambda start: window(own, j, start)))
    )
    return F.aggregate(windows, F.lit(0.0), lambda acc, w: acc + weight(w))
