import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from textmill.llm import conversation_repair as R
from textmill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.1"
KIND = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (c, t)).encode()) % 20
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, letters) and its lines, from the last row to the first with whole strings."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def with_insertions(best):
        for _ in range(3):
            best = {
                b: min([best[b], *[(c + 2, "I" + x, (f"{name[follows[b]]}:", *y)) for c, x, y in [best[follows[b]]]]], key=lambda f: f[:2])
                for b in best
            }
        return best

    far = (10**9, "", ())
    best = with_insertions({"": (0, "", ()), "s": far, "u": far, "a": (0, "", ())})
    for role, text, fault in reversed(rows):
        now = {}
        for before, (c, x, y) in best.items():
            found = [(c + 3, "D" + x, y)]
            if fault not in ("blank", "duplicate"):
                more, after = int(fault == "truncated"), follows[before]
                if role[:1] == after or role[:1] == "s" and before == "":
                    c, x, y = best[role[:1]]
                    found.append((c + more, "K" + x, (f"{role}:{text}", *y)))
                c, x, y = best[after]
                found.append((c + 2 + more, "R" + x, (f"{name[after]}:{text}", *y)))
            now[before] = min(found, key=lambda f: f[:2])
        best = with_insertions(now)
    return best[""]


def brute(table):
    by, ids = defaultdict(list), {r[0] for r in table}
    for r in damage(table):
        by[r[0]].append(r[1:])
    out = []
    for c in ids:
        rows = sorted(by[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, marked = set(), defaultdict(int), []
        for _, role, text in rows:
            inner = text.rstrip(SPACES)
            fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((c, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def got(frame):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert got(QUERIES["op11_conversation_repair"](spark, SMALL)) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def random_rows(seed, conversations=60, most=14):
    draw = random.Random(seed)
    rows = []
    for c in range(conversations):
        for _ in range(draw.randrange(most)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "u", None])
            text = draw.choice(["Yes.", "No", " \t\n", "", "Hm?  ", "a! ", "Yes.", "x" * 400 + ".", "x" * 400 + "!", None, "…", "\x0b.\x0c"])
            rows.append((c or None, draw.choice([None, *range(-2, 12)]), role, text))
    return rows


@pytest.mark.parametrize("least", [1, 3, R.LEAST_BLOCK])
def test_random_conversations(spark, least):
    """Blocks of any size give the same edits, over null ids, turns, roles and texts and repeated rows."""
    rows = random_rows(5)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND + ", cost int, audit string").repartition(5)
    assert got(R.report(frame, least)) == brute(rows)


def test_one_conversation_holds_all_rows(spark):
    draw = random.Random(2)
    rows = [(7, t, draw.choice(["user", "assistant", "system"]), draw.choice(["One.", "Two", f"Three {t}.", "", f"Four {t}"])) for t in range(700)]
    rows += [(7, 900, "user", "the same.")] * 300 + [(8, 1, "user", "Hello.")]
    frame = spark.createDataFrame(rows, KIND).repartition(7)
    assert got(R.report(frame, 16)) == brute(rows)


def test_empty_and_lost_conversations(spark):
    assert got(R.report(spark.createDataFrame([], KIND))) == []
    lost = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, lost, "user", "Gone.")]
    assert got(R.report(spark.createDataFrame(rows, KIND))) == brute(rows) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_far_turns_and_long_texts(spark):
    rows = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b" * 2_000_000 + "."), (2, 2**62, "user", "x" * 300 + "y."), (2, 2**62, "user", "x" * 300 + "z.")]
    found = {r.conv_id: r for r in R.report(spark.createDataFrame(rows, KIND)).collect()}
    expected = {r[0]: r for r in brute([(c, t, role, text) for c, t, role, text in rows])}
    assert found[1].gaps == min(expected[1][1], 2**63 - 1)
    assert found[1].repaired_sha256 == expected[1][8] and found[2].audit == expected[2][7]


def test_repaired_rows(spark):
    """The operator's own output on rows without damage."""
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi?"), (2, 0, "user", " "), (3, 0, "user", "Why?")]
    ordered = R.in_order(spark.createDataFrame(rows, KIND))
    _, walked = R.edits(R.faults(ordered))
    found = R.repaired(ordered, walked).orderBy("conv_id", "at", "part").collect()
    assert [(r.conv_id, r.role, r.text) for r in found] == [
        (1, "system", "Be kind."), (1, "user", ""), (1, "assistant", "Hello."), (1, "user", "Hi?"), (1, "assistant", ""), (3, "user", "Why?"), (3, "assistant", "")
    ]
