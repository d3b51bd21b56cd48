import random
import re

import numpy as np
import pytest
import regex
import xxhash
from docquarry.llm import line_dedup
from docquarry.llm.line_dedup import line_groups, op10_line_dedup, repeated_lines, without_lines


def normal(line):
    return re.sub(r"[\x00-\x2f:-@\[-`{-\x7f]+", " ", line.lower()).strip(" ")


def fingerprint(norm):
    words = norm.split(" ")
    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in words], np.uint64)
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    return sum(1 << b for b in range(64) if 2 * int(bits[:, b].sum()) > len(words))


def levenshtein(x, y):
    row = np.arange(len(y) + 1)
    codes, places = np.array([ord(c) for c in y]), np.arange(len(y) + 1)
    for i, c in enumerate(x, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))
        new = np.concatenate([[i], new])
        row = np.minimum.accumulate(new - places) + places
    return int(row[-1])


def brute(docs, percent=80, distance=3, min_words=5):
    where = {}
    for doc, text in docs:
        for number, line in enumerate((text or "").split("\n") if text is not None else []):
            norm = normal(line)
            if norm and len(norm.split(" ")) >= min_words:
                where.setdefault(norm, []).append((doc, number))
    norms = list(where)
    prints = np.array([fingerprint(n) for n in norms], np.uint64)
    root = list(range(len(norms)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(norms)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= distance) + i + 1:
            x, y = norms[i], norms[j]
            longest = max(len(x), len(y))
            if 100 * min(len(x), len(y)) >= percent * longest and levenshtein(x, y) <= longest * (100 - percent) // 100:
                root[find(j)] = find(i)
    groups = {}
    for i, norm in enumerate(norms):
        groups.setdefault(find(i), []).extend(where[norm])
    return {(*at, *min(g), at == min(g)) for g in groups.values() if len(g) > 1 for at in g}, len(norms)


def sketch(norm, width):
    """Minima of a line's runs under each permutation, one by one."""
    runs = {norm[i : i + width] for i in range(len(norm) - width + 1)}
    hashes = np.array([xxhash.xxh64_intdigest(r.encode(), 42) for r in runs], np.uint64)
    found = []
    for j, mask in enumerate(line_dedup._MASKS):
        by = np.uint64(64 * j // line_dedup.MINIMA)
        turned = (hashes << by) | (hashes >> (np.uint64(64) - by)) if by else hashes
        found.append(int((turned ^ np.uint64(mask % 2**64)).view(np.int64).min()) if len(hashes) else None)
    return found


def brute_similar(docs, percent=80):
    """As ``repeated_lines`` states it: equal lines, and pairs that share a band (or all but one character) and are similar."""
    where = {}
    for doc, text in docs:
        for number, line in enumerate(text.split("\n") if text is not None else []):
            norm = regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")
            if norm:
                where.setdefault(norm, []).append((doc, number))
    norms, buckets, minima = list(where), {}, {}
    for i, norm in enumerate(norms):
        widths = [3] * (len(norm) < line_dedup.LONG) + [5] * (100 * len(norm) >= percent * line_dedup.LONG)
        for width in widths:
            m = minima[i, width] = sketch(norm, width)
            for j in range(line_dedup.BANDS) if m[0] is not None else ():
                key = (width, j, *[m[(j + step) % line_dedup.MINIMA] for step in line_dedup.STEPS])
                buckets.setdefault(key, set()).add(i)
        if len(norm) <= line_dedup.TINY:
            for key in {norm, *(norm[:at] + norm[at + 1 :] for at in range(len(norm)))}:
                buckets.setdefault((3, key), set()).add(i)
    root = list(range(len(norms)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j, width in {(i, j, key[0]) for key, members in buckets.items() for i in members for j in members if i < j}:
        x, y = norms[i], norms[j]
        longest = max(len(x), len(y))
        low = lambda m: [None if v is None else v % 256 for v in m[:32]]
        agree = sum(a == b for a, b in zip(low(minima[i, width]), low(minima[j, width])))
        if 100 * min(len(x), len(y)) < percent * longest or (longest > line_dedup.TINY and agree < line_dedup.AGREE):
            continue
        if find(i) != find(j) and levenshtein(x, y) <= longest * (100 - percent) // 100:
            root[find(j)] = find(i)
    groups = {}
    for i, norm in enumerate(norms):
        groups.setdefault(find(i), []).extend(where[norm])
    return {(*at, *min(g), at == min(g)) for g in groups.values() if len(g) > 1 for at in g}, len(norms)


def rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_same_as_brute_force(spark, folder, documents):
    expected, _ = brute_similar([(d["doc_id"], d["text"]) for d in documents])
    assert expected and rows(op10_line_dedup(spark, folder)) == expected


def variants(rng, n):
    base = " ".join(f"w{rng.randint(0, 500)}" for _ in range(60)).split(" ")
    out = [" ".join(base)] * 3
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 99)}"
        out.append(rng.choice([" ".join(words), "  ".join(words).upper(), ", ".join(words) + "!"]))
    shuffled = list(base)
    rng.shuffle(shuffled)
    return out + [" ".join(shuffled)]  # the same words, and so the same fingerprint, in another order


def test_families_of_variants(spark, make):
    rng = random.Random(3)
    lines = variants(rng, 150) + variants(rng, 40) + [f"only {i} line with{i} some{i} words{i}" for i in range(20)]
    rng.shuffle(lines)
    docs = ["\n".join(lines[i : i + 3]) for i in range(0, len(lines), 3)]
    expected, distinct = brute(list(enumerate(docs)))
    assert 60 < distinct and rows(line_groups(make(docs))) == expected


def test_cases_and_removal(spark, make):
    long = "very long line of words " * 4000
    docs = [None, "", "\n\n", "a b c d e\nA, B: c d E!\n\nshort line", "a b c d e", long + "\nkept after all of this", long,
            "short line\nshort line", "x\na b  c d e\ny", "a b c d e\n \n"]
    expected, _ = brute(list(enumerate(docs)))
    groups = line_groups(make(docs))
    assert rows(groups) == expected
    cleaned = {r["doc_id"]: r["text"] for r in without_lines(make(docs), groups).collect()}
    assert cleaned == {0: None, 1: "", 2: "\n\n", 3: "a b c d e\n\nshort line", 5: long + "\nkept after all of this",
                       7: "short line\nshort line", 8: "x\ny"}
    assert line_groups(make([])).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e", 1), (None, "a b c d e", 1), (2, "a b c d e", 1), (2, "a b c d e", 1)],
                                "doc_id long, text string, k int")
    assert sorted(tuple(r) for r in line_groups(odd).collect()) == [(2, 0, 2, 0, True)] * 2
    assert without_lines(odd, line_groups(odd)).columns == odd.columns and without_lines(odd, line_groups(odd)).count() == 4


def test_no_python_in_the_plan(spark, make):
    plan = line_groups(make(["a b c d e", "a b c d e"]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("words", [5, 64, 65])
def test_fingerprint_same_as_plain(spark, words):
    from docquarry.llm.line_dedup import fingerprints, occurrences

    text = "\n".join(" ".join(f"q{i}z{k}" for k in range(words)) for i in range(5))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]): r["print"] % 2**64 for r in fingerprints(occurrences(df, 1, "doc_id", "text")).collect()}
    assert got == {(1, i): fingerprint(normal(line)) for i, line in enumerate(text.split("\n"))}


def test_lines_that_differ_in_unicode_marks_only_are_equal(spark, make):
    plain = 'he said "no" to it - and so on, with many words'
    docs = [plain, "he said \u201cno\u201d to it \u2014 and so on\u2026 with many words", plain.replace(" ", "\u00a0"),
            plain.replace(" ", "\u3000"), plain.replace(",", "\uff0c")]
    assert rows(line_groups(make(docs))) == {(i, 0, 0, 0, i == 0) for i in range(5)}


def test_query_and_pipeline_group_equal_lines_of_any_length(spark, make, tmp_path):
    from corpus_pipeline import drop_repeated_lines

    long = "\u8fd9\u662f\u4e00\u6bb5\u6ca1\u6709\u7a7a\u683c\u7684\u6587\u5b57" * 30
    docs = make(["Read more", "x y\nread MORE!", long, long + "\nz", "\n \n\u3000\n7", "7."])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    expected = {(0, 0, 0, 0, True), (1, 1, 0, 0, False), (2, 0, 2, 0, True), (3, 0, 2, 0, False), (4, 3, 4, 3, True), (5, 0, 4, 3, False)}
    assert rows(op10_line_dedup(spark, str(tmp_path))) == expected
    left = {r["doc_id"]: r["text"] for r in drop_repeated_lines(spark, docs, "").collect()}
    assert left == {0: "Read more", 1: "x y", 2: long, 3: "z", 4: "\n \n\u3000\n7"}


def test_recall_against_edit_similarity_alone(spark, make):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choices(letters, k=rng.randint(2, 9)))
    docs = []
    for size in (3, 6, 10, 20, 50, 200):
        for kind in range(40):
            line = [word() for _ in range(size)]
            docs.append(" ".join(line))
            if kind % 2 and size > 3:
                line[rng.randrange(size)] = word()
                docs.append(" ".join(line))
            else:
                chars = list(" ".join(line))
                for at in rng.sample(range(len(chars)), max(1, len(chars) // 20)):
                    chars[at] = rng.choice(letters)
                docs.append("".join(chars))
    found = {(d, g) for d, _, g, *_ in rows(repeated_lines(make(docs)))}
    share = {}
    for first in range(0, len(docs), 2):
        x, y = normal(docs[first]), normal(docs[first + 1])
        if levenshtein(x, y) <= max(len(x), len(y)) // 5:
            share.setdefault(first // 80, []).append((first + 1, first) in found)
    assert len(share) == 6 and min(np.mean(s) for s in share.values()) >= 0.9
    assert all(d // 2 == g // 2 for d, g in found)


def test_short_lines_with_one_edit(spark, make):
    docs = ["abcd", "abcde", "abxde", "zzz", "zzy", "quick fox", "quack fox"]
    assert rows(repeated_lines(make(docs))) == {(0, 0, 0, 0, True), (1, 0, 0, 0, False), (2, 0, 0, 0, False), (5, 0, 5, 0, True), (6, 0, 5, 0, False)}


def test_marks_belong_to_their_letters(spark, make):
    docs = ["कि", "का", "कि!"]
    assert rows(repeated_lines(make(docs))) == {(0, 0, 0, 0, True), (2, 0, 0, 0, False)}


def test_odd_input_of_the_query(spark, make):
    schema = "doc_id string, text string, line_no int, version string, k int"
    long = "many words in one very long line " * 4000
    odd = [("b", "one line\nother line", 1, "v", 1), ("a", "one line", 1, "v", 1), ("a", "one line", 2, "w", 2), (None, "one line", 1, "v", 1),
           ("c", None, 1, "v", 1), ("c", "", 1, "v", 1), ("c", long, 1, "v", 1), ("d", long + "!", None, None, None)]
    docs = spark.createDataFrame(odd, schema)
    got = sorted(tuple(r) for r in repeated_lines(docs).collect())
    assert got == [("a", 0, "a", 0, True)] * 2 + [("b", 0, "a", 0, False), ("c", 0, "c", 0, True), ("d", 0, "c", 0, False)]
    assert repeated_lines(docs.limit(0)).count() == 0


def test_rows_of_one_id_lose_their_own_lines_only(spark, make):
    docs = spark.createDataFrame(
        [(1, "shared line of words"), (5, "x y z own\nvery precious second line"), (5, "quite another text\nshared line of words")],
        "doc_id long, text string")
    left = without_lines(docs, line_dedup.repeated_line_places(docs))
    assert {r["text"] for r in left.collect()} == {"shared line of words", "x y z own\nvery precious second line", "quite another text"}
    same = spark.createDataFrame([(5, "alpha beta gamma"), (5, "alpha beta gamma")], "doc_id long, text string")
    assert without_lines(same, line_dedup.repeated_line_places(same)).count() == 2


def test_runs_are_cut_by_compiled_code(spark, make):
    lines = line_dedup.occurrences(make(["a b c d e", "xy", "many words " * 30]), 1, "doc_id", "text")
    found = line_dedup.sketches(lines, 80)
    assert "lambda at" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["doc_id"], r["width"]): r["bands"] for r in found.collect()}
    assert got.keys() == {(0, 3), (1, 3), (2, 5)} and got[1, 3] is None and len(got[0, 3]) == line_dedup.BANDS


def test_shuffle_files_go_with_their_step(spark, make, tmp_path, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name), []
    spark.conf.set(name, "false")
    plain = line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda *a: seen.append(spark.conf.get(name)) or plain(*a))
    try:
        assert repeated_lines(make(["same line", "same line"])).count() == 2
        assert seen and set(seen) == {"true"} and spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)
