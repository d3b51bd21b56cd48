import random

import regex
from docquarry.llm.common import SQL
from docquarry.llm.license_scan import TEMPLATES, known_templates, op6_license_scan, scan_licenses
from oracle import connect, differences


def shingles(text):
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, templates=TEMPLATES, percent=80):
    out = set()
    for doc, text in docs:
        own = shingles(text)
        for name, template in templates.items():
            wanted = shingles(template)
            if wanted and 100 * len(own & wanted) >= percent * len(wanted):
                out.add((doc, name, len(own & wanted), len(wanted)))
    return out


def rows(df):
    return {(r["doc_id"], r["template_id"], r["matched"], r["total"]) for r in df.collect()}


def test_same_as_sql_and_brute_force(spark, folder, documents):
    assert rows(op6_license_scan(spark, folder)) == brute([(d["doc_id"], d["text"]) for d in documents])
    larger = folder.replace("sf0.001", "sf0.01")
    assert differences(spark, connect(larger), "op6", op6_license_scan, SQL["op6_license_scan"], larger) == []


def wrapped(text, rng):
    words = text.split(" ")
    at = sorted(rng.sample(range(1, len(words)), min(len(words) // 12, len(words) - 1)))
    return "\n".join(" ".join(words[a:b]) for a, b in zip([0, *at], [*at, len(words)]))


def test_embedded_wrapped_and_edited_notices(spark, make):
    rng = random.Random(9)
    filler = lambda n: " ".join(f"w{rng.randint(0, 900)}" for _ in range(n))
    docs = []
    for name, text in TEMPLATES.items():
        if len(text.split()) > 12:
            docs += [f"{filler(300)} {text} {filler(200)}", f"{filler(9)}\n# {wrapped(text, rng)}\n{filler(50)}", text.upper()]
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            docs.append(f"{filler(40)}\n{' '.join(words)}\n{filler(40)}")
        else:
            docs += [f"{filler(30)}\n{text}\n{filler(300)}", text]
    docs += [filler(2000), TEMPLATES["MIT-notice"][:150]]
    assert rows(scan_licenses(make(docs), known_templates(spark))) == brute(list(enumerate(docs)))


def test_cases(spark, make):
    own = spark.createDataFrame([("t", "one two three four five six", 1), ("short", "a b", 1), (None, "a b c d e", 1), ("none", None, 1)],
                                "template_id string, text string, line_no int")
    texts = [None, "", "one two", "x\none two three four five six", "one two three four five six " * 30_000, "one, TWO three; four\nfive six"]
    got = scan_licenses(make(texts), own).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["template_id"], r["line_no"], r["containment"]) for r in got][:2] == [(3, "t", 1, 1.0), (4, "t", 0, 1.0)]
    assert scan_licenses(make([]), own).count() == 0 and scan_licenses(make(texts), own.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, texts[3], 0), (1, texts[3], 0), (1, texts[3], 0), (1, "x", 0)], "doc_id long, text string, matched int")
    assert rows(scan_licenses(odd, own)) == {(1, "t", 2, 2)}


def test_no_python_in_the_plan(spark, make):
    plan = scan_licenses(make(["a b c d e f"]), known_templates(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_every_template_inline_and_wrapped_at_each_word(spark, make):
    rng = random.Random(4)
    filler = lambda n: " ".join(f"w{rng.randint(0, 900)}" for _ in range(n))
    docs = []
    for text in TEMPLATES.values():
        docs += [f"{filler(rng.randint(8, 40))} {text} {filler(rng.randint(8, 40))}" for _ in range(60)]
        docs += [f"{filler(20)} {text[:at]}\n{text[at + 1:]} {filler(20)}" for at, c in enumerate(text) if c == " "]
        docs.append("\n".join(text.split(" ")))
    expected = brute(list(enumerate(docs)))
    assert {d for d, *_ in expected} == set(range(len(docs))) and rows(scan_licenses(make(docs), known_templates(spark))) == expected
    first = scan_licenses(make(["a b\n\nc Released under\nthe MIT License."]), known_templates(spark)).collect()
    assert [(r["template_id"], r["line_no"]) for r in first] == [("MIT", 2)]
