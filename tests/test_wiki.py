import random
import re

import pytest
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import wiki


def model(text):
    for old, new in tables.WIKI_SPACING:
        text = text.replace(old, new)
    text = re.sub(r"(\d)\s*,\s*(\d)", r"\1,\2", text)
    out, opening = [], True
    for char in text:
        if char == '"':
            char, opening = ("«" if opening else "»"), not opening
        out.append(char)
    return "".join(out)


@pytest.mark.parametrize(
    "step, text, want",
    [
        (wiki.join_digit_commas, "1 , 2 , 3", "1,2 , 3"),
        (wiki.pair_quotes, 'say "x" and "y', "say «x» and «y"),
        (wiki.tighten_spacing, "a , b . ( c ) [ d ]", "a, b. (c) [d]"),
        (wiki.clean_wiki, "", ""),
    ],
)
def test_literal_cases(texts, step, text, want):
    assert texts([text], step(F.col("text"))) == [want]


def test_random_texts_equal_model(texts):
    pick = random.Random(5)
    atoms = list('  ,,.()[]""12٣३x\n\t') + [" ", "\x1c", "\xa0"]
    values = ["".join(pick.choices(atoms, k=pick.randint(0, 50))) for _ in range(500)]
    assert texts(values, wiki.clean_wiki(F.col("text"))) == [model(v) for v in values]
