import random
import re

from docquarry.llm.components import connected_components
from docquarry.llm.near_dedup import Bands, near_duplicates, op8_near_dedup


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, percent):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def mutated(text, share, rng):
    return " ".join(w if rng.random() > share else f"x{rng.random()}" for w in text.split(" "))


def test_query_same_as_brute_force(spark, folder, documents):
    found = {tuple(r) for r in op8_near_dedup(spark, folder).collect()}
    assert found == brute([(d["doc_id"], d["text"]) for d in documents], 85)


def test_chains_copies_and_small_cells(spark, make, documents):
    rng = random.Random(5)
    base = documents[0]["text"]
    texts, last = [base] * 30, base
    for _ in range(40):
        last = mutated(last, 0.01, rng)
        texts.append(last)
    texts += [mutated(base, rng.random() * 0.05, rng) for _ in range(120)]
    texts += [None, "", " \t\n", "one", "ONE", "one two three four", "one two three four five", base * 40, base * 40 + " end"]
    rng.shuffle(texts)
    expected = brute(list(enumerate(texts)), 85)
    for members, size in ((2048, 10**6), (16, 3000)):
        got = near_duplicates(make(texts), 85, cell_members=members, cell_shingles=size)
        assert {tuple(r) for r in got.collect()} == expected


def test_empty_table_null_and_repeated_ids_and_more_columns(spark, make):
    assert near_duplicates(make([])).count() == 0
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 2), (7, "a b c d e f", 3), (7, "a b c d e f", 3), (9, "a b c d e f", 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = sorted((tuple(r) for r in near_duplicates(table).collect()), key=repr)
    assert got == sorted([(None, 2, None, True)] * 2 + [(7, 2, 7, True)] * 2 + [(9, 2, 7, False)], key=repr)


def test_other_names_and_bands(spark):
    table = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "key int, body string")
    got = near_duplicates(table, id_col="key", text_col="body", bands=Bands(8, 2), width=3)
    assert {tuple(r) for r in got.collect()} == {(1, 2, 1, True), (2, 2, 1, False)}


def test_components_of_long_paths_and_hubs(spark):
    rng = random.Random(1)
    path = list(range(200))
    rng.shuffle(path)
    links = list(zip(path, path[1:])) + [(500, i) for i in range(501, 900)] + [(3000, 3000), (None, 4)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(200)} | {i: 500 for i in range(500, 900)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_follow_the_similarity_asked_for(spark, make):
    rng = random.Random(4)
    docs = []
    for _ in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(104)]
        docs += [" ".join(words), " ".join([*words[:72], *(f"v{rng.randrange(10**6)}" for _ in range(32))])]
    parts = [(shingles(docs[i]), shingles(docs[i + 1])) for i in range(0, len(docs), 2)]
    assert all(0.5 <= len(a & b) / len(a | b) < 0.6 for a, b in parts)
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(make(docs), percent=50).collect()}
    assert all(found[i + 1] == i for i in range(0, len(docs), 2))
