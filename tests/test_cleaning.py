"""Cleaning against a character-by-character model and literal cases."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import charsets, cleaning, control, folding
from textmill.operators import documents

CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱"


HAND = dict(line.split(" ", 1) for line in tables.ASCII_SPELLINGS.strip().splitlines())
for first, names in (
    ("Α", tables.GREEK_FROM_0391), ("α", tables.GREEK_FROM_03B1), ("Ѐ", tables.CYRILLIC_FROM_0400), ("א", tables.HEBREW_FROM_05D0),
    ("ا", tables.ARABIC_FROM_0627), ("ف", tables.ARABIC_FROM_0641), ("ぁ", tables.KANA), ("ァ", tables.KANA),
):
    for k, name in enumerate(names.split()):
        HAND[chr(ord(first) + k)] = name.replace(".", "")
HAND["ー"] = "-"


def model_char(char):
    if char in "\t\n" or " " <= char <= "~":
        return char
    if ord(char) in charsets.ALLOWED_ABOVE_ASCII or char in dict(
        (one, many) for many, one in tables.EMOJI_SENTINELS
    ):
        return char
    if char in HAND:
        spelled = HAND[char]
    else:
        parts = unicodedata.normalize("NFKD", char)
        spelled = "".join(HAND.get(c, c) for c in parts if not unicodedata.combining(c))
        if any(ord(c) > 127 for c in spelled):
            spelled = ""
    spelled = spelled.replace("--", "-")
    return "".join(c for c in spelled if c in "\t\n" or " " <= c <= "~")


def model_clean(text, family="tiktoken"):
    text = text.replace("\r", "")
    for old, new in tables.SIGN_REPLACEMENTS:
        text = text.replace(old, new)
    for i, char in enumerate(CIRCLED, 1):
        text = text.replace(char, str(i))
    for old, new in tables.EMOJI_SENTINELS:
        text = text.replace(old, new)
    text = "".join(map(model_char, text))
    for old, new in ((" \n", "\n"), ("\t\n", "\n"), ("\n\n\n", "\n\n")):
        while old in text:
            text = text.replace(old, new)
    token = tables.CONTROL_TOKENS[family]
    return text.strip().replace("\t", token["tab"]).replace("\n", token["new_line"])


CASES = [
    ("« hi »", '"hi"'),
    ("☺️ ☺", "😊 😊"),
    ("❗️", "!"),
    ("①", "1"),
    ("🏳️‍🌈", "①"),
    ("🇫🇷", "⑩"),
    ("y — z -- w", "y - z -- w"),
    ("ñ ß í", "n ss i"),
    ("北", ""),
    ("Привет, Ψυχή!", "Privet, Psukhe!"),
    ("한국 값 뷁", "hangug gabs bwelg"),
    ("トーキョー", "to-kiyo-"),
    ("a\x01b\x7f", "ab"),
    ("a  \nb", "a<|new_line|>b"),
    ("a \t\nb", "a <|new_line|>b"),
    ("a\n\n\n\nb", "a<|new_line|><|new_line|>b"),
    ("\t\n", ""),
    ("", ""),
    ("a\r\nb", "a<|new_line|>b"),
    ("x\ty", "x<|tab|>y"),
    ("𝐀𝒷 ﬁ", "Ab fi"),
]


def random_texts(count, seed):
    pick = random.Random(seed)
    keys = [k for k, _ in tables.SIGN_REPLACEMENTS + tables.EMOJI_SENTINELS]
    atoms = (
        keys
        + list(CIRCLED)
        + list(" \t\n\r  \n\n--'\"")
        + list("abzAZ09,.")
        + list("éÉñßø…—“”½™北\x00\x1f\x7f\x85\xa0‍️🏳🏴🇫🇷☂❤🩷⚡𝐀ﬁ")
    )
    return ["".join(pick.choices(atoms, k=pick.randint(0, 60))) for _ in range(count)]


def test_literal_cases(texts):
    got = texts([c for c, _ in CASES], cleaning.clean_text(F.col("text")))
    assert got == [want for _, want in CASES]


def test_allowed_set_has_its_size():
    assert len(charsets.ALLOWED_ABOVE_ASCII) + 95 == 1358
    assert sum(p > 0xFFFF for p in charsets.ALLOWED_ABOVE_ASCII) == 1168


def test_random_texts_equal_model(texts):
    values = random_texts(600, seed=3)
    for family in ("tiktoken", "custom"):
        got = texts(values, cleaning.clean_text(F.col("text"), family))
        assert got == [model_clean(v, family) for v in values]


def test_documents_equal_model(docs):
    rows = docs.select("text", cleaning.clean_text(F.col("text")).alias("c")).collect()
    assert all(r.c == model_clean(r.text) for r in rows)


def test_every_fold_equals_model(texts):
    values = [chr(p) for p in range(0x80, 0x3100)] + [chr(p) for p in range(0xF900, 0xFFFE)]
    values = [v for v in values if not 0xD800 <= ord(v) <= 0xDFFF]
    chunks = ["x".join(values[i : i + 40]) for i in range(0, len(values), 40)]
    assert texts(chunks, cleaning.clean_text(F.col("text"))) == list(map(model_clean, chunks))


def test_cleaned_text_holds_only_allowed_characters(texts):
    got = texts(random_texts(300, seed=4), cleaning.clean_text(F.col("text"), "tiktoken"))
    passing = charsets.PASSING_ABOVE_ASCII
    assert all(" " <= c <= "~" or ord(c) in passing for t in got for c in t)


def test_long_runs_of_blanks_take_no_longer(texts):
    values = ["a" + " " * 300_000 + "b", "\t" * 300_000 + "x", "\n" * 300_000, '"' + "x" * 300_000]
    got = texts(values, cleaning.clean_text(F.col("text")))
    assert got[0] == values[0] and got[1] == "x" and got[2] == ""


def test_supplied_folds(texts):
    folds = folding.fold_table(lambda c: {"北": "Bei ", "京": "Jing "}.get(c, ""))
    assert texts(["北京 ß"], cleaning.clean_text(F.col("text"), folds=folds)) == ["Bei Jing"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("a <|tab|> b<|endoftext|>c", "a<|tab|>b<|endoftext|>c"),
        ("<|tab|><|tab|> x", "<|tab|><|tab|>x"),
        ("no token ñ", "no token n"),
        ("<|user\r|> é \n", "<|user|>é"),
        ("", ""),
        ("<|endoftext|>", "<|endoftext|>"),
    ],
)
def test_keep_control_tokens(texts, text, want):
    assert texts([text], cleaning.clean_text(F.col("text"), keep_control_tokens=True)) == [want]


def test_emoji_round_trip(texts):
    values = [many for many, _ in tables.EMOJI_SENTINELS] + ["a 🏳️ b 🏳️‍🌈🏳️‍⚧️"]
    got = texts(values, cleaning.decode_emoji(cleaning.encode_emoji(F.col("text"))))
    assert got == values


def test_unclean(texts):
    token = control.spelling()
    text = "".join(token.values()) + "①"
    whole, kept = texts(
        [text],
        cleaning.unclean_text(F.col("text")),
        cleaning.unclean_text(F.col("text"), keep_control_tokens=True),
    )
    assert whole == ["".join(tables.READABLE_CONTROL.values()) + "🏳️‍🌈"]
    assert kept == ["".join(token.values()) + "🏳️‍🌈"]


def test_strip_is_python_strip(texts):
    values = [f"{c}x {c}" for c in tables.WHITE_SPACE] + ["​x"]
    assert texts(values, cleaning.strip(F.col("text"))) == [v.strip() for v in values]
    assert all(c.isspace() for c in tables.WHITE_SPACE)
    assert len(tables.WHITE_SPACE) == sum(chr(p).isspace() for p in range(0x110000))


def test_unknown_family_is_refused():
    with pytest.raises(ValueError):
        control.spelling("other")


def test_min_size_and_null(spark):
    rows = [(0, "  ab  "), (1, "abc"), (2, ""), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    ids = lambda size: sorted(r.doc_id for r in documents.min_size(frame, size).collect())
    assert ids(0) == [0, 1, 2]
    assert ids(3) == [1]


def test_document_lookup(docs):
    one = documents.document_at(docs, 5).collect()
    assert len(one) == 1 and one[0].text.startswith("<|startoftext|>")
    plan = documents.document_at(docs, 5)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,5)" in plan
    drawn = {documents.random_document(docs, s).first().doc_id for s in range(4)}
    assert len(drawn) > 1
    again = {documents.random_document(docs.repartition(7), s).first().doc_id for s in range(4)}
    assert drawn == again


def test_large_fold_table(spark):
    """A table of tens of thousands of entries equals a model that goes character by character."""
    import random

    from textmill import tables
    from textmill.functions import charsets, cleaning, folding

    draw = random.Random(4)
    table = {chr(p): draw.choice(["", "a", "xy", "--", "é", "p\tq", "z "]) for p in range(0x3400, 0x3400 + 30_000)}
    table |= {"①": "no", "é": "no", "a": "no", "ab": "no", "«": "no"}
    folder = folding.table_folder(spark, table)
    texts = ["plain", "", None, "①é«a"] + ["".join(draw.choice(["a", " ", "\n", "ñ", chr(0x3400 + draw.randrange(31_000)), "①", "« ", "🏳️"]) for _ in range(60)) for _ in range(200)]

    def model(text):
        if text is None:
            return None
        text = text.replace("\r", "")
        for pairs in (tables.SIGN_REPLACEMENTS, [(c, str(i)) for i, c in enumerate(tables.CIRCLED_NUMBERS, 1)], tables.EMOJI_SENTINELS):
            for old, new in pairs:
                text = text.replace(old, new)
        out = ""
        for c in text:
            if c in "\t\n" or " " <= c <= "~" or ord(c) in charsets.PASSING_ABOVE_ASCII:
                out += c
            elif not c.isascii():
                out += "".join(x for x in table.get(c, "").replace("--", "-") if x in "\t\n" or " " <= x <= "~")
        for old, new in ((" \n", "\n"), ("\t\n", "\n"), ("\n\n\n", "\n\n")):
            while old in out:
                out = out.replace(old, new)
        token = tables.CONTROL_TOKENS["tiktoken"]
        return out.strip(" \t\n").replace("\t", token["tab"]).replace("\n", token["new_line"])

    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    cleaned = cleaning.clean_with_table(docs, folder)
    assert {r.i: r.text for r in cleaned.collect()} == {i: model(t) for i, t in enumerate(texts)}
    frame = spark.createDataFrame(list(table.items()), "character string, spelling string")
    again = cleaning.clean_with_table(docs, folding.table_folder(spark, frame))
    assert again.exceptAll(cleaned).isEmpty()
    small = cleaning.clean_with_table(docs, folding.table_folder(spark, {"北": "Bei"}))
    plan = lambda f: len(f._jdf.queryExecution().optimizedPlan().toString())
    assert abs(plan(cleaned) - plan(small)) < 200
