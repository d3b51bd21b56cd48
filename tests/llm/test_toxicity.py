import random

import numpy as np
import pyarrow.parquet as pq
from docquarry.llm.toxicity import CumulativeLink, fit, op2_toxicity, severity, words_of


def test_query(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")  # fewer labels hold each insult too rarely
    rows = {r["doc_id"]: r for r in op2_toxicity(spark, folder).collect()}
    assert set(rows) == {r["doc_id"] for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id"]).to_pylist()}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    right = [rows[i]["toxic"] == bool(t) for i, t in labels.items() if i in rows]
    assert np.mean(right) > 0.95
    assert all(0 <= r["severity"] <= 2 for r in rows.values())


def made(n, seed):
    """Texts whose grade is the number of rude words, up to 3, among many plain ones."""
    rng = random.Random(seed)
    plain, rude = [f"w{i}" for i in range(300)], [f"rude{i}" for i in range(12)]
    rows = []
    for i in range(n):
        grade = rng.choice([0, 0, 0, 1, 2, 3])
        words = rng.sample(plain, 40) + rng.sample(rude, grade)
        rng.shuffle(words)
        rows.append((i, " ".join(words), grade))
    return rows


def test_ordered_grades_on_held_out_rows(spark):
    train = spark.createDataFrame(made(1500, 1), "doc_id long, text string, grade int")
    model = fit(train.select("doc_id", "text"), train.select("doc_id", "grade"), "grade")
    assert model.grades == [0, 1, 2, 3] and len(model.thresholds) == 3
    assert (np.diff(model.thresholds) > 0).all()
    test = made(400, 2)
    got = {r["doc_id"]: r for r in severity(spark.createDataFrame(test, "doc_id long, text string, truth int"), model).collect()}
    assert np.mean([got[i]["grade"] == g for i, _, g in test]) > 0.85
    assert np.mean([abs(got[i]["severity"] - g) for i, _, g in test]) < 0.35
    # Severity only depends on words, each counted once, and is the sum of probabilities of grades.
    weights = np.zeros(1) + sum(model.weights[model.index[w]] for w in words_of(test[0][1]) if w in model.index)
    assert np.isclose(got[0]["severity"], (1 / (1 + np.exp(model.thresholds - weights))).sum())


def test_gradient_leads_to_a_maximum():
    rng = np.random.default_rng(0)
    model = CumulativeLink(["a", "b", "c"], [0, 1, 2])
    index = np.concatenate([np.flatnonzero(rng.random(3) < 0.5) for _ in range(1)] * 1)
    docs = [np.flatnonzero(rng.random(3) < 0.5) for _ in range(400)]
    index, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    truth = np.array([1.5, -1.0, 0.2])
    margin = np.array([truth[d].sum() for d in docs]) + rng.logistic(size=400)
    grade = (margin[:, None] > np.array([0.3, 1.4])).sum(1)

    def loss(w, cuts):
        m = np.array([w[d].sum() for d in docs])
        above = np.concatenate([np.ones((400, 1)), 1 / (1 + np.exp(cuts - m[:, None])), np.zeros((400, 1))], 1)
        own = np.arange(400)
        return -np.log(above[own, grade] - above[own, grade + 1]).mean() + 0.5 * 1e-4 * (w**2).sum()

    model.fit(index, ends, grade, rounds=2000)
    best = loss(model.weights, model.thresholds)
    for k in range(5):
        for step in (-0.02, 0.02):
            w, cuts = model.weights.copy(), model.thresholds.copy()
            (w if k < 3 else cuts)[k if k < 3 else k - 3] += step
            assert loss(w, cuts) > best


def test_cases(spark, make):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (1, 0), (9, 1)], "doc_id long, toxic int")
    texts = ["bad words", "good words", "good", None, "", "bad " * 100_000]
    model = fit(make(texts), labels, "toxic", least=1, deviations=0)
    rows = severity(make(texts).withColumnRenamed("source", "grade"), model).orderBy("doc_id").collect()
    assert len(rows) == 6 and rows[0]["p_toxic"] > 0.5 > rows[1]["p_toxic"]
    assert rows[3]["severity"] == rows[4]["severity"]
    assert severity(make([]), model).count() == 0
    none = fit(make(texts), labels.limit(0), "toxic")
    assert {r["severity"] for r in severity(make(texts), none).collect()} == {0.0}
    one = fit(make(texts), labels.where("toxic = 1"), "toxic")
    assert {(r["severity"], r["grade"], r["p_toxic"]) for r in severity(make(texts), one).collect()} == {(1.0, 1, 0.0)}


def test_columns_of_inner_names_and_many_grades(spark):
    from docquarry.llm.toxicity import fit, severity, words_of

    texts = [f"plain text {i}" + " awful" * (i % 3) for i in range(1500)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, _text string, __text string")
    labels = spark.createDataFrame([(i, i) for i in range(1500)], "doc_id long, grade int")
    model = fit(docs, labels, "grade")
    assert len(model.grades) == 1500
    scored = severity(docs, model)
    assert scored.columns == ["doc_id", "text", "_text", "__text", "severity", "grade", "p_toxic"]
    assert {(r["_text"], r["__text"]) for r in scored.collect()} == {("x", "y")}
    assert "कि" in words_of("कि, का")
