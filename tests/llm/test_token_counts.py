import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textmill.llm import token_counts as C

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    library = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        out.append((i, len((text or "").encode()), n, n > 512))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("most", [C.COMMON, 300, 0])
def test_whole_table_equals_library(spark, most):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got(C.count_tokens(docs, PATH, most=most)) == brute([(r.doc_id, r.text) for r in docs.collect()])


ODD = [
    (1, None), (2, ""), (3, "a"), (3, "a"), (None, "it's <|endoftext|> we'll<|endoftext|>"), (4, "  \n\n \t x \x85 \xa0\x1c y\x1f"),
    (5, "日本語 と 😀 ½ ² ª ſ ƀ"), (6, "word " * 60_000), (7, "x" * 20_000), (8, "don't DON'T '' ''s 's  's"), (9, "tab\there  12a3 ¼½ _-_"),
    (10, "a​ b c　d é é"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ODD], "doc_id long, text string, n_tokens int").repartition(3)
    assert got(C.count_tokens(docs, PATH)) == brute(ODD)
    assert got(C.count_tokens(docs, PATH, most=3)) == brute(ODD)
    assert C.count_tokens(docs.limit(0), PATH).count() == 0


def test_fast_pattern_cuts_as_the_library():
    cut = C.cutter(PATH)
    characters = [chr(c) for c in range(0x180)]
    for a in characters:
        text = f"x{a}{a} {a}y 1{a}'s\n{a}\n"
        library = [text[s:e] for _, (s, e) in cut.library.pre_tokenizer.pre_tokenize_str(text)]
        assert cut.cut(text)[0] == library, repr(a)
