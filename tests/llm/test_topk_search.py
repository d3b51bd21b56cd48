import numpy as np
import pyarrow.parquet as pq
from docquarry.llm import topk_search
from docquarry.llm.common import SQL
from docquarry.llm.topk_search import op1_topk_search, top_k
from oracle import connect, differences


def brute(vectors, queries, k):
    usable = [(i, [int(np.floor(float(x) * 64)) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in usable:
        if q in queries:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q and len(v) == len(qv))
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_query(spark, folder):
    rows = pq.read_table(f"{folder}/embeddings.parquet").to_pylist()
    vectors = [(r["vec_id"], r["embedding"]) for r in rows]
    got = {tuple(r) for r in op1_topk_search(spark, folder).collect()}
    assert got == brute(vectors, {i for i, _ in vectors if i % 20 == 0}, 20)


def test_same_as_sql(spark, folder):
    assert differences(spark, connect(folder), "op1", op1_topk_search, SQL["op1_topk_search"], folder) == []


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(topk_search, "BLOCK_QUERIES", 5)
    rng = np.random.default_rng(0)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.normal(0, 1, 8).astype("float32").tolist()) for i in range(90)]
    rows += [(100 + i, [0.5] * 8) for i in range(40)]  # ties
    rows += [(200, None), (201, [nan] * 8), (202, [inf] + [0.0] * 7), (203, [None] + [1.0] * 7), (None, [1.0] * 8)]
    rows += [(204, [1e6] * 8), (205, [-1e6] * 8), (206, [1.0, 2.0]), (207, [2.0, 3.0]), (208, []), (209, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int")
    asked = {*range(0, 90, 7), 100, 101, 139, 200, 201, 204, 205, 206, 209}
    got = top_k(df.repartition(3), df.where(df.vec_id.isin(list(asked))), k=6).collect()
    assert {tuple(r) for r in got} == brute(rows, asked, 6) and len(got) == len(set(got))
    assert top_k(df.limit(0), df).count() == 0 and top_k(df, df.limit(0)).count() == 0
    # A repeated row is a candidate twice; a repeated query is answered once.
    twice = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [3.0]), (2, [3.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in top_k(twice, twice, k=2).collect()) == [
        (1, 1, 2, 12288), (1, 2, 2, 12288), (2, 1, 1, 12288), (2, 2, 1, 12288)]


def test_no_side_is_broadcast_and_groups_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 10 ** (i % 5), 4).astype("float32").tolist()) for i in range(300)]
    rows += [(1000 + i, rng.normal(0, 1, 6).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = df.where("vec_id % 3 = 0")
    plain = top_k(df, asked, k=5)
    plan = plain._jdf.queryExecution().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    expected = {tuple(r) for r in plain.collect()}
    assert expected == brute([tuple(r) for r in df.collect()], {i for i, _ in rows if i % 3 == 0}, 5)
    for name, size in (("BLOCK_VECTORS", 16), ("BLOCK_QUERIES", 7), ("GROUP_VALUES", 90), ("LANES", 3)):
        monkeypatch.setattr(topk_search, name, size)
    got = top_k(df, asked, k=5).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
