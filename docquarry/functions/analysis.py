"""Text analysis as native Spark expressions, plus its driver-side twin for query text.

Every document-side function returns a ``Column`` of built-in functions, so the
work stays in the JVM.  ``analyze`` runs only on the (short) query string.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes that make up a word.
WORD_CHARS = r"\p{L}\p{N}"
WORD = rf"[{WORD_CHARS}]+"
NON_WORD = rf"[^{WORD_CHARS}]+"
PIECE = rf"{WORD}|{NON_WORD}"

ANALYZERS = ("standard", "whitespace", "keyword")

MAX_LENGTH = 2**31 - 1
_WORD_PY = re.compile(r"[^\W_]+")


def tokens(col: Column, analyzer: str = "standard") -> Column:
    """Analysed form of a string column: ``array<string>`` in text order."""
    if analyzer == "standard":
        return F.array_remove(F.split(F.lower(col), NON_WORD), "")
    if analyzer == "whitespace":
        return F.array_remove(F.split(col, r"\s+"), "")
    if analyzer == "keyword":
        return F.when(col.isNotNull(), F.array(col))
    raise ValueError(f"unknown analyzer {analyzer!r}; expected one of {ANALYZERS}")


def multi_value_tokens(col: Column, analyzer: str = "standard") -> Column:
    """Analysed form of an ``array<string>`` column, its values read in order."""
    return F.flatten(F.transform(F.array_compact(col), lambda value: tokens(value, analyzer)))


def analyze(text: str, analyzer: str = "standard") -> list[str]:
    """Tokens of a query string, split the way ``tokens`` splits documents."""
    if analyzer == "standard":
        return _WORD_PY.findall(text.lower())
    if analyzer == "whitespace":
        return text.split()
    if analyzer == "keyword":
        return [text]
    raise ValueError(f"unknown analyzer {analyzer!r}; expected one of {ANALYZERS}")


def pieces(col: Column) -> Column:
    """Alternating word and non-word stretches; joined again they give the text back."""
    return F.regexp_extract_all(col, F.lit(PIECE), 0)


def wildcard_regex(pattern: str) -> str:
    """Anchored Java regex for a pattern with ``*`` (any run) and ``?`` (one character)."""
    out = []
    for char in pattern:
        out.append(".*" if char == "*" else "." if char == "?" else re.escape(char))
    return "^(?s:" + "".join(out) + ")$"


def anchored(regex: str) -> str:
    """A regex that has to match the whole value."""
    return f"^(?:{regex})$"


def minimum_should_match(spec: str | int | None, n_optional: int) -> int | None:
    """Number of optional clauses that must match.

    Accepts ``3``, ``-1``, ``75%``, ``-25%`` and conditional forms such as
    ``2<75%`` or ``2<-25% 9<-3``.  The result is clipped to ``0..n_optional``.
    """
    if spec is None or str(spec).strip() == "":
        return None
    text = str(spec).strip()
    if "<" in text:
        needed = n_optional
        for condition in re.sub(r"\s*<\s*", "<", text).split():
            bound, _, rest = condition.partition("<")
            if n_optional <= int(bound):
                return needed
            needed = minimum_should_match(rest, n_optional)
        return needed
    if text.endswith("%"):
        value = int(int(text[:-1]) * n_optional / 100.0)  # rounded towards zero
    else:
        value = int(text)
    if text.startswith("-"):
        value += n_optional
    return max(0, min(n_optional, value))


def auto_fuzziness(term: str) -> int:
    """Edit distance allowed for a term when fuzziness is ``auto``."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def edit_distance_within(word: Column, term: str, k: int, transpositions: bool) -> Column:
    """True if ``word`` is at most ``k`` (0..3) edits away from ``term``.

    With ``transpositions`` a swap of two neighbouring characters counts as one
    edit, and the two are not edited further.
    """
    if k == 0:
        return word == F.lit(term)
    near = F.abs(F.length(word) - F.lit(len(term))) <= k
    if not transpositions:
        return near & F.levenshtein(word, F.lit(term), k).between(0, k)
    # A swap is two plain edits at most, so the plain distance tells most words apart.
    close = F.levenshtein(word, F.lit(term), 2 * k).between(0, 2 * k)
    return near & close & (swapping_distance(word, term) <= k)


def swapping_distance(word: Column, term: str) -> Column:
    """Edit distance in which a swap of two neighbours counts as one edit, by dynamic programming.

    One aggregate over the word's characters keeps the last two rows of the table, so the expression has the
    same size for every term and distance.
    """
    m = len(term)
    letters = F.array(*[F.lit(c) for c in term])
    chars = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(word, i, F.lit(1)))
    places = F.sequence(F.lit(1), F.lit(m))
    row = "array<int>"

    def cell(state: Column, char: Column, done: Column, j: Column) -> Column:
        own = F.get(letters, j - F.lit(1))
        swap = (j > 1) & (char == F.get(letters, j - F.lit(2))) & (state["char"] == own)
        return F.least(
            F.get(state["last"], j) + F.lit(1),
            F.get(done, j - F.lit(1)) + F.lit(1),
            F.get(state["last"], j - F.lit(1)) + F.when(char == own, F.lit(0)).otherwise(F.lit(1)),
            F.when(swap, F.get(state["before"], j - F.lit(2)) + F.lit(1)),
        )

    def step(state: Column, char: Column) -> Column:
        first = F.array(F.get(state["last"], F.lit(0)) + F.lit(1)).cast(row)
        done = F.aggregate(places, first, lambda d, j: F.concat(d, F.array(cell(state, char, d, j))).cast(row))
        return F.struct(state["last"].alias("before"), done.alias("last"), char.alias("char"))

    start = F.struct(
        F.array(*[F.lit(2 * m + 1)] * (m + 1)).cast(row).alias("before"),
        F.array(*[F.lit(j) for j in range(m + 1)]).cast(row).alias("last"),
        F.lit("").alias("char"),
    )
    filled = F.when(F.length(word) > 0, F.aggregate(chars, start, step, lambda s: F.get(s["last"], F.lit(m))))
    return F.coalesce(filled, F.lit(m))
