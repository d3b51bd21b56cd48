"""Postings go through one exchange as blocks of a term; what is written is as if each had gone alone."""

import random
import zlib

import pyarrow as pa
import pytest

from docquarry.plans import index as module
from docquarry.plans.index import build_index, prepare, term_stats
from docquarry.plans.search import Collection

FIELDS = {"title": "standard", "body": "standard"}


def batch_of(rows):
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([w for _, w in rows])], ["_id", "t"])


@pytest.mark.parametrize("tokens, most", [(1, 1), (5, 2), (17, 100), (1000, 3), (1000, 100)])
def test_blocks_hold_the_postings(tokens, most):
    draw = random.Random(1)
    rows = [(7, ["b", "a", "b"]), (7, ["é"]), (3, ["a", "", "b", "a"]), (None, ["a", "b"]), (5, ["b", None, "b"])]
    rows += [(100 + i, [draw.choice("abcdefgh") for _ in range(draw.randint(1, 9))]) for i in range(50)]
    alone = module._posting_batches(tokens, 2)(iter([batch_of(rows)]))
    expected = [(r["_id"], r["dl"], r["term"], r["tf"], r["positions"]) for part in alone for r in part.to_pylist()]
    found = []
    for part in module._posting_batches(tokens, 3, ("text", 5, 4.0, most))(iter([batch_of(rows)])):
        for r in part.to_pylist():
            assert r["bucket"] == zlib.crc32(f"text\0{r['term']}".encode()) % 5
            assert 1 <= len(r["ids"]) == len(r["dls"]) <= most
            ends = r["ends"] or list(range(1, len(r["ids"]) + 1))
            for i, dl, start, end in zip(r["ids"], r["dls"], [0, *ends], ends):
                found.append((i, dl, r["term"], end - start, r["positions"][start:end]))
            assert ends[-1] == len(r["positions"])
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_blocks_come_by_bucket_term_and_impact():
    rows = [(i, ["a"] * (i % 4 + 1) + ["b", "c", f"w{i % 5}"] * (i % 3)) for i in range(60)]
    (part,) = module._posting_batches(10_000, 10_000, ("text", 3, 4.0, 7))(iter([batch_of(rows)]))
    blocks = part.to_pylist()
    names = [(r["bucket"], r["term"]) for r in blocks]
    assert names == sorted(names) and len(names) > len(set(names)) > 5
    impacts = {}
    for r in blocks:
        ends = r["ends"] or list(range(1, len(r["ids"]) + 1))
        tfs = [end - start for start, end in zip([0, *ends], ends)]
        impacts.setdefault(r["term"], []).extend(tf / (tf + 1.2 * (0.25 + 0.75 * dl / 4.0)) for tf, dl in zip(tfs, r["dls"]))
    assert all(x == sorted(x, reverse=True) for x in impacts.values())


@pytest.mark.parametrize("fields", [["body"], ["title", "body"]])
def test_saved_postings_and_counts(spark, tmp_path, monkeypatch, fields):
    monkeypatch.setattr(module, "BLOCK_POSTINGS", 3)
    monkeypatch.setattr(module, "BUCKET_TERMS", 4)
    rows = [(str(i % 40) if i % 7 else None, f"t{i % 3}" if i % 2 else None, " ".join(f"w{(i * k) % 11}" for k in range(i % 9))) for i in range(90)]
    docs = spark.createDataFrame(rows, "id string, title string, body string")
    text = {f: FIELDS[f] for f in fields}
    shuffled = []
    plain = type(docs).repartition
    monkeypatch.setattr(type(docs), "repartition", lambda self, *by: shuffled.append(self.columns) or plain(self, *by))
    made = prepare(Collection(docs, "id", text), str(tmp_path), files=2).index
    # Postings go through their exchange as blocks.
    assert ["ids" in c for c in shuffled if "term" in c] == [True, False]
    fresh = build_index(docs, "id", text)
    own = fresh.postings.columns
    assert made.postings.columns == [*own, "impact", "bucket"]
    assert sorted(map(str, made.postings.select(own).collect())) == sorted(map(str, fresh.postings.collect()))
    counts = term_stats(made.postings)
    assert made.term_stats.count() > 10 and made.buckets > 1
    assert sorted(map(str, made.term_stats.select(counts.columns).collect())) == sorted(map(str, counts.collect()))
