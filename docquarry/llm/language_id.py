"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_fold, query, table, unused

ORDERS = (1, 2, 3)
SLICES = 8
CHUNK_CHARS = 400_000
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter, made once per process."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def _runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first row, lower-cased texts) of runs of about CHUNK_CHARS characters; null is empty."""
    run, size, first = [], 0, 0
    for row, text in enumerate(texts):
        text = (text or "").lower()
        if run and size + len(text) > CHUNK_CHARS:
            yield first, run
            run, size, first = [], 0, row
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def ngram_buckets(texts: list[str], bits: int) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Where each text's characters begin, and per order the bucket of the n-gram at each character.

    Characters other than letters count as a space.  Two spaces stand before each text, so no
    n-gram of up to three characters has letters of two texts.  N-grams without a letter get the
    extra bucket 2**bits.
    """
    starts = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]])
    stream = np.frombuffer(("".join("  " + t for t in texts) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[stream]
    stream = np.where(letter, stream, np.uint32(32)).astype(np.uint64)

    def orders():
        n = len(stream) - 2
        gram, any_letter = stream[:n] + np.uint64(1), letter[:n].copy()
        for order in range(max(ORDERS)):
            if order:
                gram = gram * np.uint64(0x9E3779B97F4A7C15) + stream[order : n + order]
                any_letter |= letter[order : n + order]
            if order + 1 in ORDERS:
                spread = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                yield np.where(any_letter, (spread >> np.uint64(64 - bits)).astype(np.int64), 1 << bits)

    return starts, orders()


def _counts(bits: int):
    """Per task and language the counts of the n-gram buckets, in slices of their nonzero places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in _runs(batch.column("text").to_pylist()):
                own = langs[first : first + len(texts)]
                for lang in set(own):
                    chosen = [t for t, x in zip(texts, own) if x == lang]
                    docs[lang] = docs.get(lang, 0) + len(chosen)
                    total = sums.setdefault(lang, np.zeros((1 << bits) + 1, np.int64))
                    for buckets in ngram_buckets(chosen, bits)[1]:
                        total += np.bincount(buckets, minlength=len(total))
        rows = []
        for lang, total in sums.items():
            for number, part in enumerate(np.split(total[:-1], SLICES)):
                at = np.flatnonzero(part)
                rows.append((lang, number, docs[lang] if number == 0 else 0, at.astype("<i4").tobytes(), part[at].tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                ["lang", "slice", "docs", "places", "counts"],
            )

    return run


def _summed(bits: int):
    def run(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, docs = np.zeros((1 << bits) // SLICES, np.int64), 0
        for frame in frames:
            docs += int(frame["docs"].sum())
            for places, counts in zip(frame["places"], frame["counts"]):
                total[np.frombuffer(places, "<i4")] += np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"lang": [key[0]], "slice": [key[1]], "docs": [docs], "counts": [total.tobytes()]})

    return run


class NaiveBayes:
    """Log probabilities per language and bucket, with add-``alpha`` smoothing."""

    def __init__(self, langs: list[str], docs: np.ndarray, counts: np.ndarray, bits: int, alpha: float = 0.1):
        self.langs, self.bits = langs, bits
        self.prior = np.log(docs / docs.sum()) if langs else np.zeros(0)
        smoothed = counts + alpha
        table = np.log(smoothed / smoothed.sum(1, keepdims=True)) if langs else np.zeros((0, 1 << bits))
        self.table = np.concatenate([table, np.zeros((len(langs), 1))], 1)  # n-grams without a letter say nothing

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Log posterior of each text (row) and language (column), up to a constant per text."""
        out = np.empty((len(texts), len(self.langs)))
        for first, run in _runs(texts):
            starts, orders = ngram_buckets(run, self.bits)
            total = np.tile(self.prior, (len(run), 1))
            for buckets in orders:
                for k in range(len(self.langs)):
                    total[:, k] += np.add.reduceat(self.table[k][buckets], starts)
            out[first : first + len(run)] = total
        return out


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = 16) -> NaiveBayes:
    """Learn from every row with a text and a language.

    Only sums reach the driver: languages x buckets numbers.  With more than 128 languages there
    are fewer buckets, so that table keeps below 64 MB.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    many = rows.select("lang").distinct().count()
    while bits > 8 and many << bits > 1 << 23:
        bits -= 1
    parts = rows.mapInArrow(_counts(bits), "lang string, slice int, docs long, places binary, counts binary")
    summed = parts.groupBy("lang", "slice").applyInPandas(_summed(bits), "lang string, slice int, docs long, counts binary")
    found = summed.collect()
    langs = sorted({r["lang"] for r in found})
    docs = np.array([sum(r["docs"] for r in found if r["lang"] == x) for x in langs], float)
    counts = np.zeros((len(langs), 1 << bits))
    for r in found:
        part = np.frombuffer(r["counts"], np.int64)
        counts[langs.index(r["lang"]), r["slice"] * len(part) : (r["slice"] + 1) * len(part)] = part
    return NaiveBayes(langs, docs, counts, bits)


def predict(docs: DataFrame, model: NaiveBayes, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with lang_pred and score, the posterior probability.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if the model
    knows no language.  Columns of the same names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in ("lang_pred", "score")]
    text_name, letter_name = unused("_text", keep), unused("_letter", keep)
    fields = docs.select(*keep).schema.fields
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(text_name).to_pylist()
            known = np.array([bool(model.langs) and x for x in batch.column(letter_name).to_pylist()], bool)
            scores = model.scores(texts) if model.langs else np.zeros((len(texts), 1))
            best = scores.argmax(1)
            with np.errstate(over="ignore"):
                sure = 1 / np.exp(scores - scores.max(1, keepdims=True)).sum(1)
            names = [model.langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(np.where(known, sure, 0.0))],
                [*keep, "lang_pred", "score"],
            )

    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.select(*keep, F.col(text_col).alias(text_name), letter.alias(letter_name)).mapInArrow(run, schema)


@query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", in_fold("doc_id", 3, 1))
    model = fit(docs.where(~F.col("held_out")))
    return predict(docs.select("doc_id", "text", "held_out"), model, keep=["doc_id", "held_out"])
