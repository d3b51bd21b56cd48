import hashlib
import random
import re

import numpy as np
import pyarrow.parquet as pq
from docquarry.llm.decontamination import contamination, op9_decontamination
from docquarry.llm.fm_index import FMIndex, suffix_order


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def rows(df):
    out = []
    for r in df.collect():
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        digest = hashlib.sha256(",".join(r["items"]).encode()).hexdigest()
        out.append((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), digest, r["contaminated"]))
    return sorted(out, key=repr)


def test_query_same_as_brute_force(spark, folder, documents):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    got = sorted((tuple(r) for r in op9_decontamination(spark, folder).collect()), key=repr)
    assert got == brute([(d["doc_id"], d["text"]) for d in documents], items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_suffix_order_and_search():
    rng = np.random.default_rng(3)
    for size, letters in ((50, 3), (400, 2), (300, 6)):
        inner = rng.integers(0, letters, size)
        sequence = np.concatenate([[0], inner, [0]])
        order = suffix_order(sequence)
        text = sequence.tolist()

        def key(i):
            end = text.index(0, i)
            return [*((1, c) for c in text[i:end]), (0, end)]

        assert order.tolist() == sorted(range(len(text)), key=key)
        index = FMIndex(sequence, 3, sample=5)
        phrases = rng.integers(1, max(2, letters), (30, 4))
        lengths = rng.integers(1, 5, 30)
        for k in range(30):
            phrases[k, : 4 - lengths[k]] = 0
        found, places = index.search(phrases, lengths)
        expected = {
            (k, i)
            for k in range(30)
            for i in range(len(text))
            if text[i : i + lengths[k]] == phrases[k, 4 - lengths[k] :].tolist()
        }
        assert set(zip(found.tolist(), places.tolist())) == expected and len(found) == len(expected)


def test_cases(spark, make):
    rng = random.Random(2)
    word = lambda: rng.choice("ab cd ef gh ij kl".split())
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(12)]
    items += [(3, "repeated id with other words"), (50, "short Item"), (51, None), (52, ""), (53, "...!"), (None, "ab cd")]
    items += [(60, "é" * 3 + " über"), (61, "a" * 500)]
    docs = [None, "", " .. ", "short", "x short-item y", "SHORT item", "short ITEM short item " + "zz " * 70, "ÉÉÉ éée éÉé über", "ééé, über"]
    for _ in range(25):
        parts = [t for _, t in items if t]
        docs.append(" ".join(rng.choice([rng.choice(parts), " ".join(word() for _ in range(30)), "foreign"]) for _ in range(4)))
    docs += [docs[-1], "short item"]  # a run that ends one text and begins the next
    docs.append("item")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(list(enumerate(docs)), items)
    for shard, block in ((10**7, 10**7), (400, 60)):
        got = contamination(make(docs).coalesce(1), bench, shard_bytes=shard, block_bytes=block)
        assert rows(got) == expected


def test_empty_tables_and_clashing_columns(spark, make):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(make([]), bench).count() == 0
    assert rows(contamination(make(["a b"]), bench.limit(0)))[0][1:4] == (2, 0, 0)
    docs = spark.createDataFrame([("k", "a b", 1, 2)], "doc_id string, text string, items int, spans int")
    assert rows(contamination(docs, bench))[0][:4] == ("k", 2, 2, 1)
