"""Text conditions answered from postings instead of the documents' texts.

While a query is compiled, its text parts ask for *slots*: the frequency and the positions of one term,
or of all terms of a class (near a word, under a prefix, like a pattern).  ``attach`` reads only the postings of
those slots, folds them to one row per document and joins that to the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import analysis
from .joins import settle

PROFILE = "_profile"
COUNTS = "_class_counts"


class PostingsView:
    """The slots one query needs, first recorded and then referred to as columns."""

    def __init__(self, index):
        self.index = index
        self._slots: dict[tuple, int] = {}
        self._with_positions: set[int] = set()
        self._lengths: dict[str, int] = {}
        self._counted: set[int] = set()
        self.recording = True

    def covers(self, field: str) -> bool:
        return self.index.covers(field)

    @property
    def needed(self) -> bool:
        return bool(self._slots)

    # -- what a query can ask for ----------------------------------------------------
    def _slot(self, field: str, key: tuple) -> int:
        return self._slots.setdefault((field, *key), len(self._slots))

    def frequency(self, field: str, key: tuple) -> Column:
        """Occurrences in the document, 0 for none."""
        slot = self._slot(field, key)
        return F.lit(0) if self.recording else F.coalesce(F.col(PROFILE)[f"tf{slot}"], F.lit(0))

    def positions(self, field: str, key: tuple) -> Column:
        """Positions in the document, in any order."""
        slot = self._slot(field, key)
        self._with_positions.add(slot)
        none = F.array().cast("array<int>")
        return none if self.recording else F.coalesce(F.col(PROFILE)[f"at{slot}"], none)

    def length(self, field: str) -> Column:
        """Number of tokens; known wherever the document has a slot of the field."""
        number = self._lengths.setdefault(field, len(self._lengths))
        return F.lit(1) if self.recording else F.col(PROFILE)[f"dl{number}"]

    def doc_freq(self, field: str, key: tuple) -> Column:
        """Documents that hold any term of a class."""
        slot = self._slot(field, key)
        self._counted.add(slot)
        return F.lit(1) if self.recording else F.col(COUNTS)[f"df{slot}"]

    # -- where the answers come from ---------------------------------------------------
    def attach(self, docs: DataFrame, required: bool, entries: DataFrame | None = None) -> DataFrame:
        """``docs`` with the profile of each; ``required``: only documents that have one."""
        self.recording = False
        if entries is None:
            entries = self.entries()
        profile = self._folded(entries)
        id_col = self.index.id_col
        rows = docs.join(profile, docs[id_col] == profile["_profile_id"], "inner" if required else "left")
        rows = rows.drop("_profile_id")
        if self._counted:
            counts = [F.count_if(F.col(PROFILE)[f"tf{s}"] > 0).alias(f"df{s}") for s in sorted(self._counted)]
            rows = rows.withColumn(COUNTS, profile.agg(F.struct(*counts).alias("c")).scalar())
        return rows

    def literal_terms(self) -> dict[tuple[str, str], int]:
        """Slot of each plain term, by (field, term)."""
        return {(field, key[0]): slot for (field, kind, *key), slot in self._slots.items() if kind == "term"}

    @property
    def only_literal(self) -> bool:
        return all(kind == "term" for _, kind, *_ in self._slots)

    def entries(self) -> DataFrame:
        """(slot, field, _id, tf, dl, positions): the postings of all slots, and of no other term."""
        parts = []
        literal = self.literal_terms()
        if literal:
            parts.append(self.literal_entries(literal))
        for (field, kind, *key), slot in self._slots.items():
            if kind != "term":
                parts.append(self._class_entries(field, kind, key, slot))
        return reduce(DataFrame.unionByName, parts)

    def literal_entries(self, literal: dict[tuple[str, str], int], extra: Column | None = None) -> DataFrame:
        """Postings of plain terms: their buckets are partitions, and their files are sorted by term."""
        rows = self.index.postings_of(list(literal))
        if extra is not None:
            rows = rows.filter(extra)
        slot = None
        for (field, term), number in literal.items():
            is_it = (F.col("field") == field) & (F.col("term") == term)
            slot = F.when(is_it, number) if slot is None else slot.when(is_it, number)
        return self._entry(rows.withColumn("slot", slot))

    def _class_entries(self, field: str, kind: str, key: list, slot: int) -> DataFrame:
        """Postings of all terms of a class, which the vocabulary tells."""
        vocabulary = self.index.term_stats.filter(F.col("field") == field)
        members = settle(vocabulary.filter(class_test(F.col("term"), kind, key)).select("bucket", "field", "term"))
        return self._entry(self.index.postings_for(members, ["bucket"]).withColumn("slot", F.lit(slot)))

    def _entry(self, rows: DataFrame) -> DataFrame:
        columns = ["slot", "field", "_id", "tf", "dl"]
        if self._with_positions:
            held = F.col("slot").isin(*sorted(self._with_positions))
            columns.append(F.when(held, F.col("positions")).alias("positions"))
        return rows.select(*columns)

    def _folded(self, entries: DataFrame) -> DataFrame:
        """One row per document; a class may have several terms in it."""
        folded = []
        for slot in self._slots.values():
            mine = F.col("slot") == slot
            folded.append(F.sum(F.when(mine, F.col("tf"))).cast("int").alias(f"tf{slot}"))
            if slot in self._with_positions:
                folded.append(F.flatten(F.collect_list(F.when(mine, F.col("positions")))).alias(f"at{slot}"))
        for field, number in self._lengths.items():
            folded.append(F.max(F.when(F.col("field") == field, F.col("dl"))).alias(f"dl{number}"))
        names = [f"tf{s}" for s in self._slots.values()] + [f"at{s}" for s in sorted(self._with_positions)]
        names += [f"dl{n}" for n in self._lengths.values()]
        grouped = entries.groupBy(F.col("_id").alias("_profile_id")).agg(*folded)
        return grouped.select("_profile_id", F.struct(*names).alias(PROFILE))


def class_test(term: Column, kind: str, key: list) -> Column:
    """Whether a term of the vocabulary belongs to a class."""
    if kind == "near":
        word, k, transpositions = key
        return analysis.edit_distance_within(term, word, k, transpositions)
    if kind == "prefix":
        return F.startswith(term, F.lit(key[0]))
    if kind == "like":
        return term.rlike(analysis.wildcard_regex(key[0]))
    raise ValueError(f"unknown class of terms {kind!r}")


