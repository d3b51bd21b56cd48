import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq

from docquarry.llm import role_grammar as grammar
from docquarry.llm.chat_repair import op12_chat_repair, repair

TURNS = "conv_id long, turn long, role string, text string"
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def by_automaton(codes):
    """Least (cost, audit) by dynamic programming over (?:s?(ua)+)? as a finite automaton."""

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for q, (c, a) in list(states.items()):
                for r in "ua":
                    if r in STEPS[q]:
                        new = (c + 3, a + "I")
                        states[STEPS[q][r]] = min(states.get(STEPS[q][r], (10**9, "")), new)
        return states

    states = inserted({"": (0, "")})
    for code in codes:
        after = {}
        for q, (c, a) in states.items():
            ways = [(q, c + 4, a + "D")]
            if code != "-":
                extra = 3 if code.isupper() else 0
                for r in STEPS[q]:
                    if r == code.lower():
                        ways.append((STEPS[q][r], c + extra, a + "K"))
                    elif r != "s":
                        ways.append((STEPS[q][r], c + extra + 3, a + "R"))
            for to, cost, audit in ways:
                after[to] = min(after.get(to, (10**9, "")), (cost, audit))
        states = inserted(after)
    return min(states[q] for q in ("", "a") if q in states)


def by_enumeration(codes):
    """Least (cost, audit) of all edits with up to two insertions in each gap."""
    gaps = [""] + ["".join(p) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    best = (10**9, "")
    options = []
    for code in codes:
        own = [("", 4, "D")]
        if code != "-":
            extra = 3 if code.isupper() else 0
            own += [(code.lower(), extra, "K"), ("u", 3 + extra, "R"), ("a", 3 + extra, "R")]
        options.append(own)
    for rows in itertools.product(*options):
        for ins in itertools.product(gaps, repeat=len(codes) + 1):
            roles = ins[0] + "".join(r[0] + i for r, i in zip(rows, ins[1:]))
            if re.fullmatch("(s?(ua)+)?", roles):
                cost = sum(r[1] for r in rows) + 3 * sum(map(len, ins))
                audit = "I" * len(ins[0]) + "".join(r[2] + "I" * len(i) for r, i in zip(rows, ins[1:]))
                best = min(best, (cost, audit))
    return best


def cost_of(codes, audit):
    rows = iter(codes)
    total = 0
    for edit in audit:
        if edit == "I":
            total += 3
            continue
        truncated = next(rows).isupper()
        total += 4 if edit == "D" else (3 if edit == "R" else 0) + 3 * truncated
    return total


def test_all_short_sequences():
    for n in range(3):
        for codes in itertools.product("suaxSUAX-", repeat=n):
            codes = "".join(codes)
            audit = grammar.advance(grammar.START, codes, True)[0]
            assert (cost_of(codes, audit), audit) == by_enumeration(codes) == by_automaton(codes)
    for codes in ("uua", "sxs", "asU", "-a-"):
        assert grammar.advance(grammar.START, codes, True)[0] == by_enumeration(codes)[1]


def test_long_sequences_in_chunks():
    rng = random.Random(12)
    for trial in range(400):
        letters = rng.choice(["suaxSUAX-", "ua", "uua-", "x", "sua", "UA", "xu"])
        codes = "".join(rng.choice(letters) for _ in range(rng.randint(3, 60)))
        whole = grammar.advance(grammar.START, codes, True)[0]
        assert (cost_of(codes, whole), whole) == by_automaton(codes)
        frontier, audit, size = grammar.START, "", rng.randint(1, 9)
        for at in range(0, len(codes), size):
            edits, frontier = grammar.advance(frontier, codes[at : at + size], False)
            audit += edits
        assert audit + grammar.advance(frontier, "", True)[0] == whole


def expected(rows):
    """The contract, in plain Python, for rows (conv_id, turn, role, text)."""
    result = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if role is None else role), (" " if text is None else text)
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(turn, role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, codes = set(), [], []
        for _, role, text in kept:
            told = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not told else "duplicate" if (role, text) in seen else "" if told[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes.append("-" if fault in ("blank", "duplicate") else code.upper() if fault else code)
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = by_automaton("".join(codes))
        lines, left, turn_of = [], iter(kept), "user"
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(left)
            if edit == "D":
                continue
            role = role if edit == "K" else turn_of
            lines.append(f"{role}:{text}")
            if not role.startswith("s"):
                turn_of = "assistant" if turn_of == "user" else "user"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return result


def result(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_query_same_as_brute_force(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r.values()) for r in pq.read_table(f"{folder}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    assert result(op12_chat_repair(spark, folder)) == expected(rows)


def test_odd_rows_same_as_brute_force(spark, tmp_path):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "admin", "", " ", None, "User"]
    texts = [None, "", " \n\x0b", "Yes.", "No", "Ends. \t", "é!", "a:b\nc?", " ", "long " * 200_000 + "."]
    rows = [(c, rng.choice([None, *range(-2, 9)]), rng.choice(roles), rng.choice(texts[:-1])) for c in range(150) for _ in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "x."), (None, None, "user", "y"), (None, 1, "user", "x."), (900, 1, "user", texts[-1]), (900, 2, "assistant", texts[-1])]
    rows += [(901, t, rng.choice(roles[:3]), f"turn {t % 97}{rng.choice('.?,')}") for t in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS id", "2 AS n", "'z' AS edit", "'q' AS fault")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(op12_chat_repair(spark, str(tmp_path))) == expected(rows)


def test_repaired_turns(spark):
    rows = [("a", 3, "user", "Hi."), ("a", 1, "user", "Hello?"), ("a", 2, "user", "Hello?"), ("b", 1, "assistant", "Bye")]
    got = repair(spark.createDataFrame(rows, "k string, at int, who string, said string"), "k", "at", "who", "said").orderBy("k", "n")
    assert got.columns == ["k", "n", "edit", "turn", "role", "text", "fault", "clash"]
    assert [tuple(r) for r in got.collect()] == [
        ("a", 1, "K", 1, "user", "Hello?", "", False), ("a", 2, "D", 2, "user", "Hello?", "duplicate", True),
        ("a", 3, "R", 3, "assistant", "Hi.", "", True), ("b", 1, "D", 1, "assistant", "Bye", "truncated", False),
    ]
    assert repair(spark.createDataFrame([], TURNS)).count() == 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(op12_chat_repair(spark, str(tmp_path))) == {}


def test_long_conversation_is_held_in_part_only():
    """Edits become certain on the way, also in a very long conversation."""
    frontier, codes = grammar.START, "uauxUa-uasaau" * 5
    for _ in range(200):
        _, frontier = grammar.advance(frontier, codes, False)
        assert max(len(audit) for _, _, audit in frontier) < 40
