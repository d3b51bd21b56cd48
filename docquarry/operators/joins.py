"""Equi-joins of a table of requests with a large one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder

SALTS = 16
# A request table is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 32 << 20


@dataclass
class Requests:
    """A checkpointed table of requests and whether its measured size allows a broadcast."""

    rows: DataFrame
    count: int
    small: bool

    def hinted(self, rows: DataFrame | None = None) -> DataFrame:
        """The table, or rows filtered from it, to join with a larger one."""
        rows = self.rows if rows is None else rows
        return F.broadcast(rows) if self.small else rows


def settle(rows: DataFrame) -> Requests:
    """Compute a request table once and measure it.

    It is used several times and is small next to the data it meets; Spark's
    estimate for it is usually far too high.  Only two numbers reach the driver.
    """
    shared_folder(rows.sparkSession)
    kept = rows.checkpoint(eager=True)
    # Arrays and structs count with the length of their text form.
    sized = [f.name for f in kept.schema if f.dataType.typeName() in ("string", "array", "struct", "map")]
    text = [F.coalesce(F.length(F.col(name).cast("string")), F.lit(0)) for name in sized]
    width = F.lit(16 * len(kept.columns))
    for length in text:
        width = width + 4 * length
    count, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return Requests(kept, count, size <= BROADCAST_BYTES)


def request_join(requests: Requests, large: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """Inner join in which one key may hold a large part of ``large``.

    A small request table is broadcast, which leaves ``large`` where it is.
    Otherwise rows of ``large`` with the same key are spread over ``SALTS``
    sub-keys by ``spread_by``, and each request is repeated for every sub-key.
    """
    if requests.small:
        return large.join(F.broadcast(requests.rows), keys)
    repeated = requests.rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    return repeated.join(spread, [*keys, "_salt"]).drop("_salt")


def prefix_matches(wanted: DataFrame, vocabulary: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Rows of ``vocabulary`` whose ``term`` starts with ``wanted.prefix`` (equal ``keys``).

    Terms are cut to the prefix lengths in use, which makes it an equi-join.
    """
    wanted = wanted.withColumn("_len", F.length("prefix"))
    # An array with one number per length in use, bounded by the longest prefix.
    lengths = wanted.agg(F.collect_set("_len").alias("n")).scalar()
    cut = vocabulary.withColumn("_len", F.explode(lengths)).filter(F.col("_len") <= F.length("term"))
    cut = cut.withColumn("prefix", F.substring(F.col("term"), F.lit(1), F.col("_len")))
    return cut.join(F.broadcast(wanted) if small else wanted, [*keys, "_len", "prefix"]).drop("_len")


def _word_pieces(word: Column, k: int) -> Column:
    """A word cut into k + 1 pieces: (length of the word, number of the piece, piece)."""
    n = F.length(word)
    return F.array(*[_piece(word, n, p, k, F.lit(0)) for p in range(k + 1)])


def _piece(text: Column, n: Column, p: int, k: int, shift: Column) -> Column:
    """What stands in ``text`` where piece ``p`` of a word of ``n`` letters stands, ``shift`` letters on."""
    start, end = F.floor(n * p / (k + 1)), F.floor(n * (p + 1) / (k + 1))
    inside = (start + shift >= 0) & (end + shift <= F.length(text))
    piece = F.substring(text, (start + shift + 1).cast("int"), (end - start).cast("int"))
    return F.when(inside, F.struct(n.alias("n"), F.lit(p).alias("p"), piece.alias("piece")))


def _term_pieces(term: Column, k: int, lengths: Column) -> Column:
    """All pieces through which a word of one of ``lengths`` letters can be at most k edits away.

    Their number depends on k alone, not on the length of the term.
    """
    near = F.sequence(F.length(term) - k, F.length(term) + k)
    shifts = F.sequence(F.lit(-k), F.lit(k))

    def of_length(n: Column) -> Column:
        return F.flatten(F.transform(shifts, lambda d: F.array(*[_piece(term, n, p, k, d) for p in range(k + 1)])))

    found = F.flatten(F.transform(F.array_intersect(near, lengths), of_length))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def fuzzy_matches(
    wanted: DataFrame, vocabulary: DataFrame, keys: list[str], ks: list[int], small: bool = False
) -> DataFrame:
    """Rows of ``vocabulary`` whose ``term`` is within ``wanted.k`` edits of ``wanted.word``.

    k edits leave one of k + 1 pieces of a word whole, at most k letters from its place.  Joining
    on the pieces finds every pair; the distance is then checked.
    """
    found = None
    for k in ks:
        part = _within(wanted.filter(F.col("k") == k), vocabulary, keys, k, small)
        found = part if found is None else found.unionByName(part)
    return found


def _within(wanted: DataFrame, vocabulary: DataFrame, keys: list[str], k: int, small: bool) -> DataFrame:
    # The lengths in use are one small array, bounded by the longest word.
    lengths = wanted.agg(F.collect_set(F.length("word")).alias("n")).scalar()
    left = wanted.withColumn("_piece", F.explode(_word_pieces(F.col("word"), k)))
    right = vocabulary.withColumn("_lengths", lengths)
    pieces = _term_pieces(F.col("term"), k, F.col("_lengths"))
    right = right.withColumn("_piece", F.explode_outer(pieces)).drop("_lengths")
    pairs = right.join(F.broadcast(left) if small else left, [*keys, "_piece"]).drop("_piece")
    near = pairs.filter(F.levenshtein(F.col("word"), F.col("term"), k) >= 0)
    return near.dropDuplicates([*wanted.columns, "term"])
