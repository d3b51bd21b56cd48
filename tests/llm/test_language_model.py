import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from docquarry.llm.language_model import END_ID, LogBilinear, contexts, fit, op4_language_model, score


def plain_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def base(train, text):
    counts = Counter(w for t in train for w in plain_tokens(t))
    n, v = sum(counts.values()), len(counts)
    own = plain_tokens(text)
    return len(own), sum(w in counts for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)


def test_query(spark, folder, documents):
    rows = {r["doc_id"]: r for r in op4_language_model(spark, folder).collect()}
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in documents}
    train = [d["text"] for d in documents if not held[d["doc_id"]]]
    counts = Counter(w for t in train for w in plain_tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert set(rows) == set(held)
    for d in documents:
        r, own = rows[d["doc_id"]], plain_tokens(d["text"])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d["doc_id"]], len(own), n)
        assert r["n_known"] == sum(w in counts for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
    gain = [(r["score"] - r["base_score"]) / r["n_tokens"] for r in rows.values() if r["held_out"]]
    assert np.mean(gain) > 0.01


def test_small_common_list_gives_the_same_base_and_probabilities_sum_to_one(spark, make):
    texts = ["a b c a b c a b", "the cat sat on the mat", "rare words here", "A B c zzz", None, "", "cat " * 500]
    docs = make(texts).select("doc_id", "text")
    for classes, common in ((6, 3), (6, 100), (50, 100)):
        fitted = fit(docs.select("text"), classes=classes, common_words=max(common, classes))
        probe = texts + ["new words a", "b"]
        got = {r["doc_id"]: r for r in score(make(probe), fitted).collect()}
        for i, text in enumerate(probe):
            r = got[i]
            expected = base(texts, text)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[:3]
            assert r["base_score"] == pytest.approx(expected[3], rel=1e-9)
        # After "a", the probabilities of the end, of every known word and of all unknown ones sum to 1.
        counts = Counter(w for t in texts for w in plain_tokens(t))
        words = [w for w in counts if w] + ["unseen"]
        singles = {r["text"]: r["score"] for r in score(spark.createDataFrame([(f"a {w}",) for w in words], "text string"), fitted, keep=["text"]).collect()}
        ids, starts = fitted.model.ids([b"a", b""]), np.array([0])
        end_after_a = np.exp(fitted.model.log_probabilities(ids, starts))[1]
        total = 0.0
        for w in words:
            own = fitted.model.ids([b"a", w.encode(), b""])
            parts = fitted.model.log_probabilities(own, np.array([0]))
            # The whole text's score less its first word and its end leaves the word after "a".
            total += 10 ** (singles[f"a {w}"] - (parts[0] + parts[2]) / np.log(10) - first_share(fitted, "a"))
        assert total + end_after_a == pytest.approx(1, abs=1e-4)


def first_share(fitted, word):
    """log10 of a word's share of its class: 0 unless the class is that of all other words."""
    if word.encode() in fitted.model.index:
        return 0.0
    n, v = fitted.total - fitted.known_total, fitted.kinds - fitted.known_kinds
    return math.log10((fitted.common.get(word.encode(), 0) + 1) / (n + v + 1))


def test_training_learns_contexts():
    rng = np.random.default_rng(1)
    # A cycle of classes with noise: the class before tells the next.
    ids = [2]
    for _ in range(40_000):
        ids.append(2 + (ids[-1] - 1) % 6 if rng.random() < 0.8 else int(rng.integers(2, 8)))
    ids = np.array(ids, np.int32)
    model = LogBilinear([b"%d" % k for k in range(6)], np.array([1, *[7000] * 6]), 1)
    start = np.array([0])
    before = model.log_probabilities(ids, start).mean()
    step, (u, v) = model.trainer(), contexts(ids, start)
    for _ in range(4):
        for a in range(0, len(ids), 512):
            step(u[a : a + 512], v[a : a + 512], ids[a : a + 512])
    model._tables = None
    after = model.log_probabilities(ids, start).mean()
    assert after > before + 0.5
    every = np.array([[END_ID, 3, w] for w in range(8)], np.int32).ravel()
    p = np.exp(model.log_probabilities(every, np.arange(0, 24, 3)))[2::3]
    assert p.sum() == pytest.approx(1, abs=1e-5)


def test_cases(spark, make):
    empty = fit(make([]).select("text"))
    rows = score(make([None, "a b"]), empty).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    fitted = fit(make(["a b c"]).select("text"))
    assert score(make([]), fitted).count() == 0
    clash = spark.createDataFrame([("x y", 1, 2, 3), ("x y", 1, 2, 3)], "text string, row int, c int, words int")
    got = score(clash, fitted)
    assert got.columns[:3] == ["row", "c", "words"] and got.count() == 2
