"""Spelling characters outside the allowed set in ASCII."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping
from functools import lru_cache
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions.charsets import PASSING_ABOVE_ASCII

_LAST_DECOMPOSING = 0x1FFFF  # no code point beyond this plane decomposes to ASCII


def _printable(text: str) -> str:
    return "".join(c for c in text if c in "\t\n" or " " <= c <= "~")


def _from(first: int, spellings: str) -> dict[str, str]:
    """Spellings of neighbouring characters; a point stands for nothing."""
    return {chr(first + k): "" if s == "." else s for k, s in enumerate(spellings.split())}


@lru_cache(maxsize=1)
def _hand_spellings() -> dict[str, str]:
    return {
        **dict(line.split(" ", 1) for line in tables.ASCII_SPELLINGS.strip().splitlines()),
        **_from(0x0391, tables.GREEK_FROM_0391),
        **_from(0x03B1, tables.GREEK_FROM_03B1),
        **_from(0x0400, tables.CYRILLIC_FROM_0400),
        **_from(0x05D0, tables.HEBREW_FROM_05D0),
        **_from(0x0627, tables.ARABIC_FROM_0627),
        **_from(0x0641, tables.ARABIC_FROM_0641),
        **_from(0x3041, tables.KANA),
        **_from(0x30A1, tables.KANA),
        "ー": "-",
    }


HANGUL = (0xAC00, 0xD7A3)


def spell_hangul(text: Column) -> Column:
    """Hangul syllables by their sounds, which the code point gives by arithmetic."""
    first, middle, last = (
        F.array(*[F.lit("" if s == "." else s) for s in part.split()])
        for part in (tables.HANGUL_FIRST, tables.HANGUL_MIDDLE, tables.HANGUL_LAST)
    )

    def spelled(c: Column) -> Column:
        place = F.ascii(c) - HANGUL[0]
        sounds = F.concat(
            F.get(first, F.floor(place / 588).cast("int")),
            F.get(middle, (F.floor(place / 28) % 21).cast("int")),
            F.get(last, (place % 28).cast("int")),
        )
        return F.when(F.ascii(c).between(*HANGUL), sounds).otherwise(c)

    # text between syllables is one part, however long
    parts = F.regexp_extract_all(text, F.lit(r"[\x{AC00}-\x{D7A3}]|[^\x{AC00}-\x{D7A3}]++"), F.lit(0))
    whole = F.array_join(F.transform(parts, spelled), "")
    return F.when(text.rlike(r"[\x{AC00}-\x{D7A3}]"), whole).otherwise(text)


def compatibility_spelling(char: str) -> str:
    """Listed spelling, else the NFKD form without marks if that is all ASCII."""
    hand = _hand_spellings()
    if char in hand:
        return hand[char]
    parts = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
    spelled = "".join(hand.get(c, c) for c in parts)
    return spelled if spelled.isascii() else ""


def fold_table(spell: Callable[[str], str] = compatibility_spelling) -> dict[str, str]:
    """``{character: ASCII}`` for every character that may not pass but has a spelling.

    ``spell`` is any function from one character to text, for example a full
    transliteration library; characters it gives no printable ASCII for are dropped
    from the text. A doubled dash inside one spelling becomes a single dash.
    """
    table = {}
    for point in range(0x80, _LAST_DECOMPOSING + 1):
        if HANGUL[0] <= point <= HANGUL[1]:
            continue  # spelled by rule
        if point in PASSING_ABOVE_ASCII or 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        spelled = _printable(spell(char).replace("--", "-"))
        if spelled:
            table[char] = spelled
    return table


@lru_cache(maxsize=1)
def default_folds() -> dict[str, str]:
    return fold_table()


def table_folder(spark: SparkSession, table: Mapping[str, str] | DataFrame) -> Callable[[Column], Column]:
    """Folds of a table of any size, as a function of a text column.

    ``table`` maps characters to spellings, or has the columns ``character`` and ``spelling``; it has at most one row
    for each of Unicode's characters, so it goes to every task once. The plan holds no part of it. Characters that may
    pass, sentinels and keys of the other replacements keep their meaning. Only texts with a character beyond ASCII
    are sent to the function, which looks up each of their characters.
    """
    if isinstance(table, DataFrame):
        one = table.select("character", "spelling").filter(F.char_length("character") == 1)
        pairs = one.dropDuplicates(["character"]).toArrow().to_pydict()
        table = dict(zip(pairs["character"], pairs["spelling"]))
    kept = {c for old, new in tables.SIGN_REPLACEMENTS + tables.EMOJI_SENTINELS for c in (old, new)} | set(tables.CIRCLED_NUMBERS)
    own = {
        ord(c): _printable((s or "").replace("--", "-"))
        for c, s in table.items()
        if len(c) == 1 and not c.isascii() and ord(c) not in PASSING_ABOVE_ASCII and c not in kept
    }
    shared = spark.sparkContext.broadcast(own)

    def translated(batches):
        for batch in batches:
            yield batch.map(lambda text: text.translate(shared.value), na_action="ignore")

    translated.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    apply = F.pandas_udf(translated, "string")
    return lambda text: F.coalesce(apply(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)
