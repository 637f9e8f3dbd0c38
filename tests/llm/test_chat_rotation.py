import pytest

from textmill.llm import chat_rotation as C


def brute(rows):
    """Whole dialogues as ``{(conversation, perspective): (text, learned parts)}``."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        for person in {r[2] or "unknown" for r in own}:
            text, parts = "", []
            for r in own:
                who = r[2] or "unknown"
                text += "<|assistant|>\n" if who == person else f"<|user|>{who}\n"
                first = len(text)
                text += (r[3] or "") + C.END
                if who == person:
                    parts.append((first, len(text)))
            out[conv, person] = (text, parts)
    return out


def whole(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: r.position):
        text, parts = out.get((r.conv_id, r.perspective), ("", []))
        assert len(text) + len(r.segment) == r.last and r.learned == (r.speaker == r.perspective)
        text += r.segment
        out[r.conv_id, r.perspective] = (text, parts + [(r.first, r.last)] * r.learned)
    return out


ROWS = [
    (1, 0, "ann", "hi"), (1, 1, "bob", "hello 😀"), (1, 2, "eve", None), (1, 3, "ann", ""), (2, 5, None, "x"), (2, None, "ann", "first"),
    (None, 1, "ann", "lost"), (None, 2, "bob", "y"), (3, 1, "a", "tie"), (3, 1, "a", "tie"), (3, 1, "b", "tie"), (3, -700, "b", "early"),
] + [(4, k * 3, "xyz"[k % 3], "w" * (k % 5)) for k in range(900)]


@pytest.mark.parametrize("stretch", [C.STRETCH, 1, 10])
def test_dialogues_equal_brute_force(spark, stretch):
    turns = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, position int").repartition(4)
    assert whole(C.rotated(turns, stretch)) == brute(ROWS)


def test_empty(spark):
    assert C.rotated(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
