"""Clean-up of encyclopedia text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions.cleaning import replace_in_order


def tighten_spacing(text: Column) -> Column:
    """No space before closing marks and after opening ones."""
    return replace_in_order(text, tables.WIKI_SPACING)


def join_digit_commas(text: Column) -> Column:
    """``1 , 2`` becomes ``1,2``; matches do not overlap."""
    blank = "".join(rf"\x{{{ord(c):X}}}" for c in tables.WHITE_SPACE)
    return F.regexp_replace(text, rf"(\p{{Nd}})[{blank}]*+,[{blank}]*+(\p{{Nd}})", "$1,$2")


def pair_quotes(text: Column) -> Column:
    """Straight double quotes become « and » in turn; an odd last one opens."""
    paired = F.regexp_replace(text, r'"([^"]*+)"', "«$1»")
    return F.replace(paired, F.lit('"'), F.lit("«"))


def clean_wiki(text: Column) -> Column:
    return pair_quotes(join_digit_commas(tighten_spacing(text)))
