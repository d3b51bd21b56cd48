"""Toxicity: cumulative-link ordinal regression of severity grades on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, query, table, unused

#: Letters with their combining marks, and digits.
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
SAMPLE_ROWS = 8192
VOCABULARY = 8192
#: How many standard deviations a feature's mean grade lies above the mean of all, at least.
DEVIATIONS = 4
#: Probability of more than the lowest grade from which a document counts as toxic.  One insult in a text
#: gives about 0.3, a text without any 0.003.
TOXIC = 0.2


def words_of(text: str | None) -> set[str]:
    """A text's features: its words, and the beginnings of four and five letters of longer ones.

    Insults are inflected and compounded; their stems are what repeats.
    """
    words = set(_WORD.findall(text.lower())) if text else set()
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


class CumulativeLink:
    """P(grade >= j) = sigmoid(w . x - threshold_j): one weight per word, thresholds in order.

    ``grades`` are the grades in ascending order; there is one threshold between neighbours.
    """

    def __init__(self, words: list[str], grades: list[int]):
        self.index = {w: k for k, w in enumerate(words)}
        self.grades = grades
        self.weights = np.zeros(len(words))
        self.thresholds = np.arange(max(0, len(grades) - 1), dtype=float)

    def rows(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The known words of each text: indices one after another, and each text's end."""
        found = [sorted(map(self.index.__getitem__, self.index.keys() & words_of(t))) for t in texts]
        return np.array([k for f in found for k in f], np.int64), np.cumsum([len(f) for f in found], dtype=np.int64)

    @staticmethod
    def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(values)])
        return total[ends] - total[np.concatenate([[0], ends[:-1]]).astype(np.int64)]

    def fit(self, index: np.ndarray, ends: np.ndarray, grade: np.ndarray, rounds: int = 300, penalty: float = 1e-4) -> None:
        """Full-batch Adam on the mean log likelihood; ``grade`` counts from 0.

        The first threshold is free and the others are sums of exponentials, which keeps them in order.
        """
        if len(self.grades) < 2:
            return
        steps = len(self.grades) - 1
        share = np.array([(grade >= j).mean() for j in range(1, steps + 1)]).clip(1e-3, 1 - 1e-3)
        start = -np.log(share / (1 - share))
        gaps = np.log(np.maximum(np.diff(start), 0.1))
        values = np.concatenate([self.weights, start[:1], gaps])
        first, second = np.zeros_like(values), np.zeros_like(values)
        size, n = len(self.weights), len(grade)
        for t in range(1, rounds + 1):
            w, cuts = values[:size], values[size] + np.concatenate([[0], np.cumsum(np.exp(values[size + 1 :]))])
            margin = self._sums(w[index], ends)
            above = 1 / (1 + np.exp(-np.clip(margin[:, None] - cuts, -40, 40)))
            above = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
            own, slope = np.arange(n), above * (1 - above)
            p = np.maximum(above[own, grade] - above[own, grade + 1], 1e-12)
            d_margin = (slope[own, grade] - slope[own, grade + 1]) / p
            d_cut = np.zeros((n, steps + 2))
            d_cut[own, grade] = -slope[own, grade] / p
            d_cut[own, grade + 1] = slope[own, grade + 1] / p
            d_cut = d_cut[:, 1:-1].sum(0) / n
            sizes = np.diff(ends, prepend=0)
            d_w = np.bincount(index, np.repeat(d_margin, sizes), size) / n - penalty * w
            later = np.cumsum(d_cut[::-1])[::-1]
            gradient = np.concatenate([d_w, later[:1], later[1:] * np.exp(values[size + 1 :])])
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            values = values + 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        self.weights = values[:size]
        self.thresholds = values[size] + np.concatenate([[0], np.cumsum(np.exp(values[size + 1 :]))])

    def above(self, texts) -> np.ndarray:
        """P(grade >= j) for each text (row) and each grade but the lowest (column)."""
        index, ends = self.rows(texts)
        margin = self._sums(self.weights[index], ends)
        return 1 / (1 + np.exp(-np.clip(margin[:, None] - self.thresholds, -40, 40)))

    def expected(self, above: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, float))
        return (self.grades[0] if self.grades else 0) + above @ steps


def _vocabulary(sample: DataFrame, size: int, least: int, deviations: float) -> list[str]:
    """The features of at least ``least`` sampled texts whose texts' mean grade lies most above the mean of all.

    Features of lower grades are left out: a long clean text has many, and they would outweigh its
    insults.  Counted by Spark over the whole sample; ``size`` features at most reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(words_of(text)) for text in batch.column("text").to_pylist()]
            grades = np.repeat(batch.column("grade").to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for f in found for w in f], pa.string()), pa.array(grades, pa.int32())], ["word", "grade"]
            )

    words = sample.mapInArrow(run, "word string, grade int").groupBy("word").agg(
        F.count("*").alias("n"), F.avg("grade").alias("mean")
    )
    middle, spread = sample.agg(F.avg("grade"), F.stddev_pop("grade")).first()
    gap = (F.col("mean") - middle) * F.sqrt("n")
    chosen = words.where((F.col("n") >= least) & (gap > deviations * spread)).orderBy(gap.desc(), "word")
    return [r[0] for r in chosen.select("word").limit(size).collect()]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    grade_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    vocabulary: int = VOCABULARY,
    least: int = 5,
    deviations: float = DEVIATIONS,
) -> CumulativeLink:
    """Fit on at most ``sample_rows`` labelled rows, those of the smallest id hashes.

    The bound holds for the rows that train; the model scores everything.  Labels without id or
    grade, or for a document without text, teach nothing; a repeated label counts as often.  With
    one grade every text has it; without labels every severity is 0.
    """
    chosen = labels.select(F.col(id_col).alias("_id"), F.col(grade_col).cast("int").alias("grade"))
    chosen = chosen.where("_id is not null and grade is not null").orderBy(F.xxhash64("_id"), "_id", "grade").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("text is not null")
    # At most ``sample_rows`` ids and grades: a few hundred kilobytes.
    sample = materialise(texts.join(F.broadcast(chosen), "_id").select("text", "grade"), "toxicity")
    grades = sorted(r[0] for r in sample.select("grade").distinct().collect())  # at most ``sample_rows``
    model = CumulativeLink(_vocabulary(sample, vocabulary, least, deviations) if len(grades) > 1 else [], grades)
    if len(grades) < 2:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, ends = model.rows(batch.column("text").to_pylist())
            words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), words], ["grade", "words"])

    rows = sample.mapInArrow(run, "grade int, words array<long>").toArrow()
    words = rows.column("words").combine_chunks()
    index = words.flatten().to_numpy()
    order = np.searchsorted(grades, rows.column("grade").to_numpy())
    model.fit(index, np.cumsum(words.value_lengths().to_numpy()), order)
    return model


def severity(docs: DataFrame, model: CumulativeLink, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with severity, the expected grade, grade, the most probable
    one, and p_toxic, the probability of more than the lowest grade.

    Whole texts count.  Of equally probable grades the lowest is taken.  Null or empty texts get what a text without known words gets.  Columns of
    the same names are replaced; repeated rows are scored each; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = ("severity", "grade", "p_toxic")
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    text_name = unused("_text", keep)
    fields = docs.select(*keep).schema.fields
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "severity double, grade int, p_toxic double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                above = model.above(batch.column(text_name).to_pylist())
                share = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1), axis=1)
                grade = np.array(model.grades or [0])[share.argmax(1)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(model.expected(above), pa.float64()), pa.array(grade, pa.int32()),
                     pa.array(above[:, 0] if above.shape[1] else np.zeros(len(above)))],
                    [*keep, *new],
                )

    return docs.select(*keep, F.col(text_col).alias(text_name)).mapInArrow(run, schema)


def graded(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 clean, 1 toxic in an otherwise good document, 2 toxic and of low quality."""
    toxic = F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic") == 0, 0)
    return labels.select("doc_id", toxic.alias("grade"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, graded(table(spark, folder, "labels")), "grade")
    return severity(docs, model, keep=["doc_id"]).withColumn("toxic", F.col("p_toxic") >= TOXIC)
