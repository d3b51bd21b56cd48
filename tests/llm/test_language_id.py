import zlib

from docquarry.llm.language_id import fit, op3_language_id, predict
import numpy as np


def test_query_on_held_out_documents(spark, folder, documents):
    got = {r["doc_id"]: r for r in op3_language_id(spark, folder).collect()}
    assert set(got) == {d["doc_id"] for d in documents}
    right = []
    for d in documents:
        row = got[d["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["lang_pred"] in ("en", "de", "fr", "es", "und")
        if row["held_out"] and d["lang"]:
            right.append(row["lang_pred"] == d["lang"])
    assert len(right) > 40 and np.mean(right) > 0.97


def plain_naive_bayes(labelled, text):
    """The same model without hashing, one n-gram at a time."""
    def grams(t):
        t = "  " + "".join(c if c.isalpha() else " " for c in t.lower()) + "  "
        return [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - 2) if t[i : i + n].strip()]

    langs = sorted({x for _, x in labelled})
    kinds = {g for t, _ in labelled for g in grams(t)}
    out = []
    for lang in langs:
        own = [g for t, x in labelled if x == lang for g in grams(t)]
        count = {g: own.count(g) for g in kinds}
        total = len(own) + 0.1 * (1 << 16)
        prior = np.log(sum(x == lang for _, x in labelled) / len(labelled))
        out.append(prior + sum(np.log((count.get(g, 0) + 0.1) / total) for g in grams(text)))
    return langs, out


def test_same_as_plain_model(spark, make):
    labelled = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("el perro y el gato", "es"), ("the end", "en")]
    train = spark.createDataFrame(labelled, "text string, lang string")
    model = fit(train)
    for text in ("the dog", "Der Gato!", "x", "the   end\n\n12"):
        langs, expected = plain_naive_bayes(labelled, text)
        assert langs == model.langs
        assert np.allclose(model.scores([text])[0], expected)
    # A long text is scored whole, and texts in one batch do not touch each other.
    texts = ["der hund " * 100_000, "the", "", "gato " * 50_000]
    apart = np.concatenate([model.scores([t]) for t in texts])
    assert np.allclose(model.scores(texts), apart)


def test_cases(spark, make):
    train = spark.createDataFrame([("the and", "en"), ("und der", "de"), (None, "fr"), ("le", None)], "text string, lang string")
    model = fit(train)
    assert model.langs == ["de", "en"]
    texts = [None, "", " 12 ?!", "the", "the", "Ω", "日本"]
    got = predict(make(texts).withColumn("score", F_lit("clash")), model, keep=["doc_id"]).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got][:5] == ["und", "und", "und", "en", "en"]
    assert [r["score"] for r in got][:3] == [0, 0, 0]
    assert got[5]["lang_pred"] in model.langs
    kept = predict(make(texts), model)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    assert predict(make([]), model).count() == 0
    nothing = fit(train.limit(0))
    assert {r["lang_pred"] for r in predict(make(["the"]), nothing).collect()} == {"und"}


def F_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_columns_of_inner_names(spark):
    from docquarry.llm.language_id import fit, predict

    docs = spark.createDataFrame([("ab ab", "x", "u", "v"), ("zz zz", "y", "u", "v")], "text string, lang string, _text string, _letter string")
    got = predict(docs, fit(docs)).collect()
    assert [(r["lang"], r["lang_pred"], r["_text"], r["_letter"]) for r in got] == [("x", "x", "u", "v"), ("y", "y", "u", "v")]
