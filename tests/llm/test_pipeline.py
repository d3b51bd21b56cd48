"""The pipeline's stages against brute-force versions, each on its predecessor's rows."""

import random

import corpus_pipeline
import pyarrow.parquet as pq
import pytest

from docquarry.llm.packing import public_tokenizer
from test_decontamination import brute as brute_decontamination
from test_line_dedup import brute_similar as brute_lines
from test_near_dedup import brute as brute_near
from test_packing import checked
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    assert df.columns == COLUMNS
    rows = df.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_same_as_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before, kept = texts(docs.select(*COLUMNS)), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            kept[name] = texts(docs)

    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    gone = before.keys() - kept["toxicity"].keys()
    assert gone and {labels[i] for i in gone if i in labels} <= {0, 1}
    wrong = [i for i, t in labels.items() if i in before and (i in gone) != bool(t)]
    assert len(wrong) <= 0.08 * len(labels)  # few labels at this size
    assert all(kept["toxicity"][i] == before[i] for i in kept["toxicity"])

    removed = {(d, n) for d, n, *_, keep in brute_lines(sorted(kept["toxicity"].items()))[0] if not keep}
    expected = {}
    for i, text in kept["toxicity"].items():
        lines = text.split("\n")
        left = "\n".join(line for n, line in enumerate(lines) if (i, n) not in removed)
        if len(left) == len(text) or any(c.isalnum() for c in left):
            expected[i] = left
    assert kept["line_dedup"] == expected and removed

    groups = brute_near(sorted(expected.items()), 80)
    assert set(kept["near_dedup"]) == {i for i, _, _, keep in groups if keep}

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    judged = brute_decontamination(sorted(kept["near_dedup"].items()), items)
    assert set(kept["decontamination"]) == {r[0] for r in judged if not r[5]}

    checked(docs.collect(), kept["decontamination"], Tokenizer.from_file(public_tokenizer("word_bpe_49k.json")), 2048)


@pytest.fixture()
def small(spark, tmp_path):
    def write(rows):
        folder = str(tmp_path / "tables")
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, grade int").write.parquet(
            f"{folder}/documents.parquet")
        labels = [(i, 1, int(i is not None and i >= 100)) for i, *_ in rows]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        passage = " ".join(f"bench{i}" for i in range(20))
        spark.createDataFrame([(1, passage), (None, "x"), (2, None)], "item_id long, text string").write.parquet(
            f"{folder}/benchmark.parquet")
        return folder, passage

    return write


def row(i, text):
    return (i, text, "en", None, None if text is None else len(text), 3)


def test_decisions_take_effect(spark, small):
    line = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"term{i}" for i in range(70))
    passage = " ".join(f"bench{i}" for i in range(20))
    # Words of their own, so that no two clean lines are near each other.
    rng = random.Random(7)
    clean = {i: " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 9))) for _ in range(40)) for i in range(20)}
    rows = [row(i, t) for i, t in clean.items()]
    rows += [row(30, f"{line}\n{clean[0]}x y z"), row(31, f"{other}\nsomething else stands here {line}"), row(32, line), row(33, line.upper() + "!")]
    rows += [row(40, other + " with an end"), row(41, passage + " few words more"), row(42, passage + " long" * 900)]
    rows += [row(50, None), row(51, ""), row(None, "a row without an id stays"), row(None, "a row without an id stays")]
    rows += [row(100 + i, f"you idiot {i} are worthless{i % 3} scum") for i in range(12)]
    folder, _ = small(rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), name)
        assert docs.columns == COLUMNS
        ids.append({r[0] for r in docs.select("doc_id").collect()})
    toxic, lines, near, clear = ids
    assert {*clean, 30, 31, 32, 33, 40, 41, 42, 50, 51, None} == toxic
    assert lines == toxic - {32, 33, 40}  # the line of 40 is near the first of 31
    assert near >= {*clean, 31, 41, 42, 50, 51, None}
    assert clear == near - {41}
    assert docs.where("doc_id is null").count() == 2
    assert corpus_pipeline.run(spark, folder).where("doc_id = 42").count() >= 1


def test_empty_tables(spark, small):
    folder, _ = small([])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_contaminated_rows_go_by_their_own_text(spark, tmp_path):
    from corpus_pipeline import drop_contaminated

    bad = " ".join(f"bench{i}" for i in range(60))
    spark.createDataFrame([("b", bad)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(
        [(None, bad, "en", "s", 1), (1, bad, "en", "s", 1), (1, "clean words here", "en", "s", 1), (None, "clean", "en", "s", 1), (2, None, "en", "s", None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = drop_contaminated(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect()) == [("1", "clean words here"), ("2", "None"), ("None", "clean")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k int"


def test_near_copies_by_their_own_row(spark):
    base = [f"w{i}" for i in range(60)]
    text = " ".join(base)
    near = " ".join([*base[:59], "other"])
    own, another = " ".join(f"own{i}" for i in range(40)), " ".join(f"more{i}" for i in range(40))
    docs = spark.createDataFrame(
        [row(1, text), row(5, near), row(5, own), row(7, another), row(7, another), row(8, another), row(9, text), row(None, text)], SCHEMA)
    docs = docs.select(*COLUMNS)
    left = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert left == sorted([(1, text), (5, own), (7, another), (7, another), (0, text)])
    twice = spark.createDataFrame([row(3, text), row(3, near), row(4, text)], SCHEMA).select(*COLUMNS)
    left = corpus_pipeline.drop_near_copies(spark, twice, "").collect()
    assert len(left) == 1 and left[0]["doc_id"] == 3
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0
