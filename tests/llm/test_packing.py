import random
import zlib

import numpy as np
import pytest
from docquarry.llm.packing import Encoder, op5_packing, pack, public_tokenizer, sequences
from tokenizers import Tokenizer

PATH = public_tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def checked(rows, texts, tokenizer, length):
    """Every id lies in one piece, sequences have no gaps, and only the last is short."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    full = {}
    for r in rows:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(full) == list(range(len(full)))
    for number, parts in full.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or (number == len(full) - 1 and at <= length)


def test_query(spark, folder, documents, tokenizer):
    rows = op5_packing(spark, folder).collect()
    checked(rows, {d["doc_id"]: d["text"] for d in documents}, tokenizer, 2048)


def test_chunks_encode_as_whole_texts(tokenizer):
    texts = [
        "It's a DOG's  life here\x1cthere x", "café ́x", "a<|endoftext|>b <|startoftext|>", "a" * 3000,
        "Éclair, ÑANDÚ. straße; ŠĄŻĿŉſ! Ÿ? ǅ word.. .word a., ª º µ ÆØ, Ǆ. x² don't. It's, ĳĲ,", "éé e\u0301é, ÀÉ.",
        "İstanbul İ, ΟΔΟΣ ΟΔΟΣ, don't 'll 's", "퟿\n\t\r\n 12345 ##!? 漢字かな", "", " ", "x\x0bz\x0cy\x85w",
    ]
    got = Encoder(PATH).encode(texts, 1)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_cases_and_whole_sequences(spark, make, tokenizer):
    rng = random.Random(4)
    texts = [None, "", "same", "same", "long words " * 900, *("w " * rng.randint(1, 90) for _ in range(60))]
    pieces = pack(make(texts).repartition(5), PATH, length=64)
    rows = pieces.collect()
    checked(rows, dict(enumerate(texts)), tokenizer, 64)
    whole = {r[0]: len(r[1]) // 4 for r in sequences(pieces).collect()}
    assert set(whole.values()) - {64} == {n for n in [whole[max(whole)]] if n < 64}
    assert pack(make([]), PATH).count() == 0


def test_null_and_repeated_ids_and_more_columns(spark):
    docs = spark.createDataFrame([(None, "a", 1), (3, "b c", 2), (3, "b c", 2)], "doc_id int, text string, start int")
    rows = pack(docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 2), (3, 3), (3, 3)]
    assert sorted(r["offset"] for r in rows) in ([0, 2, 5], [0, 3, 5], [0, 3, 6])


def test_tokenizers_that_keep_white_space(spark, make):
    path = public_tokenizer("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = dict(enumerate(["two words\n\nand  more\tspaces", " lead", "", None, "don't stop", "Ünïcode  　 text"]))
    rows = pack(make(list(texts.values())), path).collect()
    checked(rows, texts, tokenizer, 2048)
