"""Control tokens: names, spellings, ids."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import tables

NAMES = list(tables.CONTROL_TOKENS["tiktoken"])


def spelling(family: str = "tiktoken") -> dict[str, str]:
    """``{name: token text}`` of one family, in id order."""
    try:
        return dict(tables.CONTROL_TOKENS[family])
    except KeyError:
        known = ", ".join(sorted(tables.CONTROL_TOKENS))
        raise ValueError(f"unknown control token family {family!r}; known: {known}") from None


def ids(first_id: int, family: str = "tiktoken") -> dict[str, int]:
    """``{token text: id}``; control ids follow the vocabulary, in list order."""
    return {text: first_id + i for i, text in enumerate(spelling(family).values())}


def control_id(name: str, first_id: int) -> int:
    return first_id + NAMES.index(name)


def control_tokens(spark: SparkSession, first_id: int = 0) -> DataFrame:
    """The ten tokens as a table ``(name, custom, tiktoken, id)``."""
    rows = [
        (
            name,
            tables.CONTROL_TOKENS["custom"][name],
            tables.CONTROL_TOKENS["tiktoken"][name],
            first_id + i,
        )
        for i, name in enumerate(NAMES)
    ]
    return spark.createDataFrame(rows, "name string, custom string, tiktoken string, id int")


def pattern(family: str = "tiktoken") -> str:
    """A regular expression that matches any one token of the family.

    What all tokens begin and end with stands outside the alternatives, so that a search
    looks for one literal.
    """
    texts = list(spelling(family).values())
    head = os.path.commonprefix(texts)
    tail = os.path.commonprefix([text[::-1] for text in texts])[::-1]
    middles = [text[len(head) : len(text) - len(tail)] for text in texts]
    return f"{re.escape(head)}(?:{'|'.join(map(re.escape, middles))}){re.escape(tail)}"


def holds_control(text: Column, family: str = "tiktoken") -> Column:
    """Does the text hold a control token? Counts documents whose raw text does."""
    return text.rlike(pattern(family))


def around_control(
    text: Column, between: Callable[[Column], Column], family: str = "tiktoken"
) -> Column:
    """Arrays of ``between(part)`` for the parts of a text and its control tokens, in order.

    ``between`` makes an array of strings from the text between two control tokens.
    """
    parts = F.split(text, pattern(family), -1)
    tokens = F.regexp_extract_all(text, F.lit(pattern(family)), F.lit(0))
    # one part more than tokens: the last pair has no token
    paired = F.zip_with(
        parts, tokens, lambda part, token: F.concat(between(part), F.array_compact(F.array(token)))
    )
    return F.flatten(paired)
