"""Log-bilinear language model, trained by noise-contrastive estimation and normalised exactly.

The model's classes are the most frequent words of the corpus, the end of a text, and one class for
all other words.  With contexts of two words the score of class w is

    s(w | u, v) = ((c1 * r_u) + (c2 * r_v)) . q_w + b_w = A1[u, w] + A2[v, w] + b_w,

so the normaliser of every context is one matrix product, exp(A1) diag(exp b) exp(A2)^T.  A word of
the other class shares that class's probability by its count in the corpus, add-one smoothed.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_fold, materialise, query, table

#: The end of a text; no word is empty.
END = b""
OTHER_ID, END_ID = 0, 1
CLASSES, DIMENSIONS, NOISE, BATCH = 1024, 16, 64, 1024
#: Words whose counts every task holds; the counts of all others are joined.
COMMON_WORDS = 100_000
PARTS = 16


def tokens(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased, then the end; null is empty."""
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c): how often each word occurs in all texts, the end once in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
                if len(counts) > 300_000:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class LogBilinear:
    """Parameters: context and target vectors, position weights and biases of all classes."""

    def __init__(self, words: list[bytes], counts: np.ndarray, other: int, dimensions: int = DIMENSIONS):
        draw = np.random.default_rng(11)
        self.index = {w: k + 2 for k, w in enumerate(words)} | {END: END_ID}
        size = len(words) + 2
        shares = np.concatenate([[other], counts]).astype(np.float64) + 1
        self.noise = shares / shares.sum()
        self.context = draw.normal(0, 0.1, (size, dimensions)).astype(np.float32)
        self.target = draw.normal(0, 0.1, (size, dimensions)).astype(np.float32)
        self.position = np.ones((2, dimensions), np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        self._tables = None

    def __getstate__(self):
        return self.__dict__ | {"_tables": None}

    def parameters(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.position, self.bias)])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for name in ("context", "target", "position", "bias"):
            old = getattr(self, name)
            setattr(self, name, values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        self._tables = None

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.index.get
        return np.array([get(w, OTHER_ID) for w in words], np.int32)

    # -- training --------------------------------------------------------------------------

    def trainer(self, rate: float = 0.3):
        """A function that takes (u, v, w) class ids and makes one Adagrad step on them."""
        sums = {n: np.full(getattr(self, n).shape, 1e-4, np.float32) for n in ("context", "target", "position", "bias")}
        draw = np.random.default_rng(17)
        log_noise = np.log(self.noise * NOISE).astype(np.float32)
        cumulative, last = np.cumsum(self.noise), len(self.bias) - 1

        def update(name: str, ids, gradient: np.ndarray) -> None:
            """One step on the rows ``ids``, which may repeat."""
            if ids is not None:
                order = np.argsort(ids)
                ids = ids[order]
                first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                gradient, ids = np.add.reduceat(gradient[order], first), ids[first]
            else:
                ids = slice(None)
            total = sums[name][ids] + gradient**2
            sums[name][ids] = total
            getattr(self, name)[ids] += np.float32(rate) * gradient / np.sqrt(total)

        def step(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
            noise = np.minimum(np.searchsorted(cumulative, draw.random(NOISE)), last)
            r_u, r_v, q_w, q_n = self.context[u], self.context[v], self.target[w], self.target[noise]
            hidden = self.position[0] * r_u + self.position[1] * r_v
            true = np.einsum("ij,ij->i", hidden, q_w) + (self.bias[w] - log_noise[w])
            false = hidden @ q_n.T + (self.bias[noise] - log_noise[noise])
            # Derivatives of the mean log likelihood; every noise word serves all places of the batch.
            up = 1 / (1 + np.exp(np.clip(true, -30, 30))) / np.float32(len(w))
            down = -1 / (1 + np.exp(-np.clip(false, -30, 30))) / np.float32(len(w))
            d_hidden = up[:, None] * q_w + down @ q_n
            update("position", None, np.stack([(d_hidden * r_u).sum(0), (d_hidden * r_v).sum(0)]))
            both = np.concatenate([u, v])
            update("context", both, np.concatenate([d_hidden * self.position[0], d_hidden * self.position[1]]))
            seen = np.concatenate([w, noise])
            update("target", seen, np.concatenate([up[:, None] * hidden, down.T @ hidden]))
            update("bias", seen, np.concatenate([up, down.sum(0)]))

        return step

    # -- scoring ---------------------------------------------------------------------------

    def _prepared(self):
        """A1, A2 and the log normaliser of every context, by one matrix product."""
        if self._tables is None:
            first = ((self.context * self.position[0]) @ self.target.T).astype(np.float32)
            second = ((self.context * self.position[1]) @ self.target.T).astype(np.float32)
            top_1, top_2, top_b = first.max(1, keepdims=True), second.max(1, keepdims=True), self.bias.max()
            mass = (np.exp(first - top_1) * np.exp(self.bias - top_b).astype(np.float32)) @ np.exp(second - top_2).T
            self._tables = first, second, np.log(mass) + top_1 + top_2.T + np.float32(top_b)
        return self._tables

    def log_probabilities(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log of P(class | two classes before) at each place; a text begins after two ends."""
        first, second, normaliser = self._prepared()
        u, v = contexts(ids, starts)
        return first[u, ids] + second[v, ids] + self.bias[ids] - normaliser[u, v]


def contexts(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each place; every text holds at least its end."""
    one, two = np.full(len(ids), END_ID, np.int32), np.full(len(ids), END_ID, np.int32)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[starts] = END_ID
    two[starts] = END_ID
    later = starts + 1
    two[later[later < len(ids)]] = END_ID
    return one, two


def _flat(texts: list[str | None], index) -> tuple[np.ndarray, np.ndarray]:
    listed = [tokens(t) for t in texts]
    sizes = np.array([len(t) for t in listed])
    return index([w for t in listed for w in t]), np.cumsum(sizes) - sizes


def train(texts: DataFrame, model: LogBilinear) -> LogBilinear:
    """One pass over all texts: every task starts from ``model`` and trains on its own texts, and the
    results are averaged, weighted by tokens.  Tasks send their parameters in slices, which are summed
    apart; only the averages reach the driver.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(shared.value)
        step, seen, held = own.trainer(), 0, []
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                ids, starts = _flat(batch.column(0).slice(first, 200).to_pylist(), own.ids)
                held.append((*contexts(ids, starts), ids))
                if sum(len(h[2]) for h in held) >= 4 * BATCH:
                    seen += _steps(step, held)
                    held = []
        if held:
            seen += _steps(step, held)
        if seen:
            parts = np.array_split(own.parameters().astype(np.float64) * seen, PARTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PARTS), pa.int32()), pa.array([seen] * PARTS, pa.int64()), pa.array([p.tobytes() for p in parts])],
                ["part", "seen", "total"],
            )

    def averaged(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = 0.0, 0
        for frame in frames:
            seen += int(frame["seen"].sum())
            for values in frame["total"]:
                total = total + np.frombuffer(values)
        yield pd.DataFrame({"part": [key[0]], "mean": [(total / seen).tobytes()]})

    sent = texts.mapInArrow(run, "part int, seen long, total binary")
    means = sent.groupBy("part").applyInPandas(averaged, "part int, mean binary").orderBy("part").collect()
    if means:
        model.load(np.concatenate([np.frombuffer(r["mean"]) for r in means]))
    return model


def _steps(step, held: list) -> int:
    u, v, w = (np.concatenate([h[k] for h in held]) for k in range(3))
    for a in range(0, len(w), BATCH):
        step(u[a : a + BATCH], v[a : a + BATCH], w[a : a + BATCH])
    return len(w)


class Fitted:
    """A trained model with the corpus's counts: ``counts`` (word, c), N, V and the commonest words."""

    def __init__(self, model: LogBilinear, counts: DataFrame, total: int, kinds: int, common: dict[bytes, int]):
        self.model, self.counts, self.total, self.kinds, self.common = model, counts, total, kinds, common
        self.known_total = sum(common.get(w, 0) for w in model.index)
        self.known_kinds = sum(w in common for w in model.index)


def _commonest(counts: DataFrame, most: int) -> dict[bytes, int]:
    """Words from some count up, ``most`` at most, by falling count.

    A histogram of the counts' logarithms, a few hundred rows at any size, says from which count.  A
    sorted limit would send ``most`` words of every partition to the driver.
    """
    size = F.floor(F.log2("c") * 8).alias("size")
    steps = counts.groupBy(size).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    taken, least = 0, None
    for step in sorted(steps, key=lambda r: -r["size"]):
        taken += step["n"]
        if taken > most:
            break
        least = step["least"]
    if least is None:
        return {}
    rows = counts.where(F.col("c") >= least).collect()
    return {bytes(r["word"]): r["c"] for r in sorted(rows, key=lambda r: (-r["c"], bytes(r["word"])))}


def fit(texts: DataFrame, classes: int = CLASSES, common_words: int = COMMON_WORDS) -> Fitted:
    """Count all words of the one-column table ``texts`` and train on all of them.

    The driver receives ``common_words`` of the most frequent words at most and the model's parameters,
    whose sizes do not depend on the corpus.
    """
    counts = materialise(word_counts(texts), "words")
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common = _commonest(counts, common_words)
    words = [w for w in common if w != END][: classes - 2]
    ends = texts.count() if END not in common else common[END]
    own = np.array([ends, *(common[w] for w in words)])
    model = LogBilinear(words, own, total - int(own.sum()))
    return Fitted(train(texts, model) if ends else model, counts, total, kinds, common | ({END: ends} if ends else {}))


def score(docs: DataFrame, fitted: Fitted, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) with n_tokens, n_known, train_tokens,
    base_score and score (both log10 of the whole text's probability).

    Each task scores whole texts with the counts of the common words; the rest are joined by word,
    each document's repeated words once.  Null text is empty: its end is scored.  Repeated rows are
    scored each; no rows give no rows.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    fields = docs.select(*keep).schema.fields
    names = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields))
    schema += ", row string, n_tokens long, n_known long, n_other long, base double, other double, model double, words array<binary>, times array<int>"
    shared = docs.sparkSession.sparkContext.broadcast((fitted.model, fitted.common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (model, common), part, number = shared.value, TaskContext.get().partitionId(), 0
        logs = {w: float(np.log10(c + 1)) for w, c in common.items()}
        for whole in batches:
            for first in range(0, whole.num_rows, 200):
                batch = whole.slice(first, 200)
                texts = batch.column("_text").to_pylist()
                ids, starts = _flat(texts, model.ids)
                sums = np.add.reduceat(model.log_probabilities(ids, starts), starts) / np.log(10)
                out = []
                for text, model_sum in zip(texts, sums.tolist()):
                    found = Counter(tokens(text))
                    here = found.keys() & logs.keys()
                    rare = list(found.keys() - here)
                    base = sum([logs[w] * found[w] for w in here])
                    inside = sum([logs[w] * found[w] for w in here & model.index.keys()])
                    outside = sum([n for w, n in found.items() if w not in model.index])
                    number += 1
                    out.append((f"{part}/{number}", sum(found.values()), sum([found[w] for w in here]), outside, base,
                                base - inside, model_sum, rare, [found[w] for w in rare]))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(),
                         pa.list_(pa.binary()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))],
                    [*names, "row", "n_tokens", "n_known", "n_other", "base", "other", "model", "words", "times"],
                )

    picked = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text_col).alias("_text"))
    scored = materialise(picked.mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    joined = rare.join(fitted.counts.select(F.col("word").alias("words"), "c").hint("shuffle_hash"), "words")
    sums = joined.groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more")
    )
    n, v = fitted.total, fitted.kinds
    n_other, v_other = n - fitted.known_total, v - fitted.known_kinds
    more = F.coalesce("more", F.lit(0.0))
    all_rows = scored.drop("words", "times").join(sums, "row", "left")
    return all_rows.select(
        *(F.col(x).alias(c) for x, c in zip(names, keep)),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("model") + F.col("other") + more - F.col("n_other") * float(np.log10(n_other + v_other + 1))).alias("score"),
    )


@query("op4_language_model")
def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", in_fold("doc_id", 7, 2))
    fitted = fit(docs.where(~F.col("held_out")).select("text"))
    return score(docs, fitted)
