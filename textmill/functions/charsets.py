"""Regular expression classes built from sets of code points."""

from __future__ import annotations

from collections.abc import Iterable
from math import isqrt

from textmill import tables


def _ranges(points: Iterable[int]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for point in sorted(set(points)):
        if merged and merged[-1][1] == point - 1:
            merged[-1] = (merged[-1][0], point)
        else:
            merged.append((point, point))
    return merged


def class_body(points: Iterable[int]) -> str:
    """The inside of a character class, as ranges that Java and RE2 both read."""
    return "".join(
        rf"\x{{{low:X}}}" if low == high else rf"\x{{{low:X}}}-\x{{{high:X}}}"
        for low, high in _ranges(points)
    )


def grouped_class_body(points: Iterable[int]) -> str:
    """A set above ASCII for Java, neighbouring ranges grouped under their hull.

    A class of many ranges is tried range by range; with groups ASCII fails at once
    and other characters are tried against the hulls, then inside one of them.
    """
    ranges = _ranges(points)
    step = max(1, isqrt(len(ranges)))
    groups = [ranges[i : i + step] for i in range(0, len(ranges), step)]
    inside = "".join(
        rf"[\x{{{group[0][0]:X}}}-\x{{{group[-1][1]:X}}}&&["
        + class_body(p for low, high in group for p in range(low, high + 1))
        + "]]"
        for group in groups
    )
    return rf"[\x{{80}}-\x{{10FFFF}}&&[{inside}]]"


#: Code points above ASCII that pass cleaning unchanged, sentinels not counted.
ALLOWED_ABOVE_ASCII = frozenset(
    ord(c) for c in tables.ALLOWED_LETTERS + tables.ALLOWED_SIGNS + tables.ALLOWED_EMOJI
)

#: Single characters that stand for emoji sequences.
SENTINELS = frozenset(ord(one) for _, one in tables.EMOJI_SENTINELS)

#: Everything above ASCII that the character filter lets through.
PASSING_ABOVE_ASCII = ALLOWED_ABOVE_ASCII | SENTINELS

_CONTROL_BODY = r"\x00-\x08\x0B-\x1F\x7F"

#: ASCII controls that never pass (tab and line feed do).
DROPPED_ASCII = f"[{_CONTROL_BODY}]"

#: All characters that never pass. The intersection keeps ASCII off the long class.
DROPPED_ANY = (
    f"[{_CONTROL_BODY}[\\x{{80}}-\\x{{10FFFF}}&&[^{grouped_class_body(PASSING_ABOVE_ASCII)}]]]"
)

#: One character that passes the filter.
PASSING_ONE = rf"^[\t\n\x20-\x7E{class_body(PASSING_ABOVE_ASCII)}]$"
