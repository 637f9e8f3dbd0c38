"""Cutting text into the pieces that a vocabulary is made of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import control
from textmill.functions.binding import once


def split_pieces(text: Column, pattern: str = "gpt2") -> Column:
    """All pieces of a text in order; joined again they give the text.

    ``pattern`` is ``"gpt2"``, ``"gpt4"`` or a regular expression.
    """
    regex = tables.SPLIT_PATTERNS.get(pattern, pattern)
    return F.regexp_extract_all(text, F.lit("(?U)" + regex), F.lit(0))


def split_pieces_with_control(
    text: Column, pattern: str = "gpt2", family: str = "tiktoken"
) -> Column:
    """Pieces of a text in which control tokens are pieces of their own."""

    def cut(value: Column) -> Column:
        around = control.around_control(
            value, lambda part: split_pieces(part, pattern), family
        )
        return F.when(control.holds_control(value, family), around).otherwise(
            split_pieces(value, pattern)
        )

    return once(text, cut)


#: A word that ends before a blank and a word: no piece of the named patterns crosses such a place.
_WORD_END = r"(?<=[A-Za-z])(?= [A-Za-z])"


def text_stretches(text: Column, characters: int, pattern: str = "gpt2") -> Column:
    """A text longer than ``characters`` cut where no piece is, into stretches a little longer; else the text alone.

    Their pieces in order are the text's. Texts without a word of ASCII letters before another, and those
    for patterns of one's own, are not cut.
    """
    if pattern not in tables.SPLIT_PATTERNS:
        return F.array(text)
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{{characters},}}?{_WORD_END}|.+"), F.lit(0))
    return F.when(F.length(text) > characters, parts).otherwise(F.array(text))


def utf8_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a text that is not empty, as ``ARRAY<INT>``.

    Read as Latin-1, every byte is one character whose code is the byte. Taking characters
    by position is quick for short texts and splitting for long ones.
    """

    def codes(one_each: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(one_each))
        return F.when(
            F.length(one_each) <= 64,
            F.transform(places, lambda i: F.ascii(F.substring(one_each, i, F.lit(1)))),
        ).otherwise(F.transform(F.split(one_each, ""), F.ascii))

    return once(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), codes)
