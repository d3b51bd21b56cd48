import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa

from docquarry.llm import term_matrix
from docquarry.llm.common import SQL
from docquarry.llm.filter_audit import interactions, op13_filter_audit, text_flags
from oracle import connect, differences

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def test_same_as_sql(spark, folder):
    assert differences(spark, connect(folder), "op13", op13_filter_audit, SQL["op13_filter_audit"], folder) == []


def odd_rows(rng):
    words = ["the", "The", "x", "é", "A", "a#b", "日本", " ", " ", "w|w", "😀", "\x00", "\x1c\x85"]
    texts = [None, "", " \n\t\x0b\x0c\r", "word " * 49, "word " * 50, " ".join(f"w{i}" for i in range(50)), "A" * 5 + "b" * 95, "A" * 6 + "b" * 94,
             "é" * 94 + "A" * 6, "long w" * 300_000, "x" * 3_000_000]
    texts += ["".join(rng.choice(words) + rng.choice(" \n\t") for _ in range(rng.randint(1, 120))) for _ in range(120)]
    rows = [(rng.choice([None, *range(200)]), rng.choice(texts), "en", rng.choice([None, "", "s0", "s1"]), 1) for _ in range(500)]
    return rows + [(7, "the same", "en", "s0", 1), (7, "the same", "en", "s0", 1), (8, "the same", "en", "s1", 1)]


def failing(rows):
    """The filters each row fails, in plain Python."""
    firsts = {}
    for i, text, *_ in rows:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    result = []
    for i, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        result.append("".join(f for f, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search("[#$%&*|]", text)), i is not None and i > firsts[text],
        )) if bad))
    return result


def expected(rows, labels):
    marks = {}
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (False, False))
        marks[i] = (good or quality == 1, bad or toxic == 1)
    docs = [(r[3] or "", f, *(marks.get(r[0], (False, False)) if r[0] is not None else (False, False))) for r, f in zip(rows, failing(rows))]
    table, shares = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            own = list(left)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                fails = [d for d in own if f in d[1]]
                table[part, order, step] = (len(left), len(gone), len(fails) - len(gone), sum(d[1] == f for d in own),
                                            sum(d[2] for d in gone), sum(d[3] for d in gone))
                shares[part, f] = shares.get((part, f), 0) + len(gone)
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in table.items()}


def test_odd_rows_same_as_brute_force_and_sql(spark, tmp_path):
    rng = random.Random(13)
    rows = odd_rows(rng)
    labels = [(rng.choice([None, *range(250)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)]
    for name, data, schema in (("documents", rows, DOCS), ("labels", labels, LABELS)):
        df = spark.createDataFrame(data, schema).coalesce(1)
        if name == "documents":
            df = df.selectExpr("*", "1 AS part", "2 AS words", "3 AS k0", "4 AS shard", "5 AS A", "6 AS good")
        df.write.parquet(f"{tmp_path}/raw-{name}")
        next(tmp_path.glob(f"raw-{name}/*.parquet")).rename(tmp_path / f"{name}.parquet")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in op13_filter_audit(spark, str(tmp_path)).collect()}
    assert got == expected(rows, labels)
    assert differences(spark, connect(str(tmp_path)), "op13", op13_filter_audit, SQL["op13_filter_audit"], str(tmp_path)) == []


def test_flags_in_small_shards_and_other_ids(spark):
    rows = [(f"id{i:03d}" if i is not None else None, *rest) for i, *rest in odd_rows(random.Random(5))]
    df = spark.createDataFrame(rows, DOCS.replace("doc_id long", "key string"))
    key = lambda r: repr(r)
    expected_rows = sorted(((r[0], r[3] or "", f) for r, f in zip(rows, failing(rows))), key=key)
    for size in (1, 2000, 32 << 20):
        flags = text_flags(df, "key", shard_bytes=size).collect()
        assert sorted(((r["doc_id"], r["part"], "".join(f for f in "ABCDE" if r[f])) for r in flags), key=key) == expected_rows


def test_dictionary_is_one_for_all_shards(spark):
    texts = [("a b a c",), ("c d",), (None,), ("b b b",), ("",)]
    docs = spark.createDataFrame(texts, "text string").coalesce(1).selectExpr("monotonically_increasing_id() AS id", "text")
    encoded = term_matrix.encode(docs, "text", lambda text: (), [], shard_bytes=3)
    known = {}
    for r in term_matrix.dictionary(encoded).collect():
        assert known.setdefault(bytes(r["word"]), r["term"]) == r["term"]
    assert len(known) == len(set(known.values())) == 4

    def listed(shard):
        ids = shard.rows.column("k0").to_pylist()
        rows = [dict(zip(shard.terms[a:b].tolist(), shard.counts[a:b].tolist())) for a, b in zip(shard.starts, shard.starts[1:])]
        return pa.table({"id": ids, "row": [repr(sorted(r.items())) for r in rows], "n": shard.row_sums().astype(np.int64)})

    got = {r["id"]: (r["row"], r["n"]) for r in term_matrix.over_shards(encoded, listed, "id long, row string, n long").collect()}
    coded = lambda **c: repr(sorted((known[w.encode()], n) for w, n in c.items()))
    assert list(got.values()).count(("[]", 0)) == 2
    assert {got[i] for i in got} == {(coded(a=2, b=1, c=1), 4), (coded(c=1, d=1), 2), ("[]", 0), (coded(b=3), 3)}


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    flags = text_flags(docs)
    assert flags.count() == 0
    joined = flags.join(labels.selectExpr("doc_id", "quality = 1 AS good", "toxic = 1 AS toxic"), "doc_id", "left")
    assert interactions(joined).count() == 0


def test_words_of_long_texts():
    text = ("ab " * 700_000 + "x" * 1_500_000 + "\n\x0bend").encode()
    counted = term_matrix.words_of(text)
    assert counted == {b"ab": 700_000, b"x" * 1_500_000: 1, b"end": 1}
