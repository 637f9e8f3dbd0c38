"""Text cleaning and its inverse as column expressions.

All of it stays inside the JVM but the lookup in fold tables of any size. Text is scanned a fixed number of times whatever
the size of the character tables, and no pattern used here backtracks, so a long
run of blanks costs no more than the same length of words.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import charsets, control, folding
from textmill.functions.binding import once

_SEPARATOR, _ENTRY, _FIELD = "\x1f", "\x1e", "\x1d"


def replace_in_order(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Apply plain replacements one after the other, for short lists."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _constant_array(items: Sequence[str]) -> Column:
    """One folded literal, however many items it has."""
    return F.split(F.lit(_SEPARATOR.join(items)), _SEPARATOR, -1)


def _mark(key: str) -> str:
    return next(c for c in key if ord(c) > 0x7F)


def replace_where_marked(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Ordered replacements for long lists whose keys all hold a non-ASCII character.

    Texts with no such character are left alone after one scan. In the others only
    the pairs whose character occurs are applied: each is found in a list of those whose code points
    have its remainder, so the cost follows the text and not the length of the list, and neither does the size of the plan.
    """
    marks = [_mark(old) for old, _ in pairs]
    body = charsets.grouped_class_body(map(ord, marks))
    lists: list[list[str]] = [[] for _ in range(max(1, len(pairs)))]
    for i, (mark, (old, new)) in enumerate(zip(marks, pairs)):
        lists[ord(mark) % len(lists)].append(_FIELD.join([f"{i:06d}", mark, old, new]))
    table = _constant_array([_ENTRY.join(entries) for entries in lists])
    present = F.array_distinct(F.regexp_extract_all(text, F.lit(f"[{body}]"), F.lit(0)))

    def entries(mark: Column) -> Column:
        same = F.split(F.get(table, F.ascii(mark) % len(lists)), _ENTRY, -1)
        return F.filter(same, lambda entry: F.substring(entry, 8, 1) == mark)

    # numbers of equal length come first, so the order of texts is that of the list
    applying = F.array_sort(F.flatten(F.transform(present, entries)))

    def replaced_one(done: Column, entry: Column) -> Column:
        fields = F.split(entry, _FIELD, -1)
        return F.replace(done, F.get(fields, F.lit(2)), F.get(fields, F.lit(3)))

    replaced = F.reduce(applying, text, replaced_one)
    return F.when(text.rlike(f"[{body}]"), replaced).otherwise(text)


def drop_carriage_returns(text: Column) -> Column:
    return F.replace(text, F.lit("\r"), F.lit(""))


def replace_signs(text: Column) -> Column:
    """Guillemets, exclamation and question marks, check marks and faces."""
    return replace_where_marked(text, tables.SIGN_REPLACEMENTS)


def _circled_pairs() -> list[tuple[str, str]]:
    return [(c, str(i)) for i, c in enumerate(tables.CIRCLED_NUMBERS, start=1)]


def escape_circled_numbers(text: Column) -> Column:
    """Circled numbers of the text become digits: they are sentinels from here on."""
    return replace_where_marked(text, _circled_pairs())


def encode_emoji(text: Column) -> Column:
    """Emoji of several code points become one character each."""
    return replace_where_marked(text, tables.EMOJI_SENTINELS)


def decode_emoji(text: Column) -> Column:
    """Inverse of :func:`encode_emoji`."""
    return replace_where_marked(
        text, [(one, sequence) for sequence, one in reversed(tables.EMOJI_SENTINELS)]
    )


def drop_unknown_characters(text: Column) -> Column:
    """Delete every character outside the allowed set, tab and line feed."""
    return F.regexp_replace(text, charsets.DROPPED_ANY, "")


def fold_to_ascii(text: Column, folds: Mapping[str, str] | None = None) -> Column:
    """Spell characters outside the allowed set in ASCII (no deletion)."""
    spelled = folding.spell_hangul(text) if folds is None else text
    folds = folding.default_folds() if folds is None else folds
    return _fold_single(replace_where_marked(spelled, _long_folds(folds)), folds)


def _fold_single(text: Column, folds: Mapping[str, str]) -> Column:
    single = {c: s for c, s in folds.items() if len(s) == 1}
    if not single:
        return text
    return F.translate(text, "".join(single), "".join(single.values()))


def _long_folds(folds: Mapping[str, str]) -> list[tuple[str, str]]:
    return [(c, s) for c, s in folds.items() if len(s) > 1]


def tidy_blanks(text: Column) -> Column:
    """No spaces, then no tabs, before a line feed; at most two line feeds in a row."""

    def where(value: Column, held: str, pattern: str, new: str) -> Column:
        # a plain search is far quicker than trying the pattern at every blank
        return once(value, lambda v: F.when(F.contains(v, F.lit(held)), F.regexp_replace(v, pattern, new)).otherwise(v))

    text = where(text, " \n", r"(?<! ) ++\n", "\n")
    text = where(text, "\t\n", r"(?<!\t)\t++\n", "\n")
    return where(text, "\n\n\n", r"\n{3,}+", "\n\n")


def strip(text: Column) -> Column:
    """Python's ``str.strip()``."""
    return F.trim(text, F.lit(tables.WHITE_SPACE))


def controls_to_tokens(text: Column, family: str = "tiktoken") -> Column:
    """Tab and line feed become control tokens."""
    token = control.spelling(family)
    return replace_in_order(text, [("\t", token["tab"]), ("\n", token["new_line"])])


def allowed_text(text: Column, folds: Mapping[str, str] | None = None) -> Column:
    """Replace, fold and filter characters; blanks are left as they are."""
    no_return = drop_carriage_returns(text)
    if folds is None:
        folds, no_return = folding.default_folds(), folding.spell_hangul(no_return)
    # spellings are ASCII and their characters no table key, so one pass does all four
    pairs = (
        tables.SIGN_REPLACEMENTS
        + _circled_pairs()
        + tables.EMOJI_SENTINELS
        + _long_folds(folds)
    )
    full = drop_unknown_characters(
        _fold_single(replace_where_marked(no_return, pairs), folds)
    )
    # every table key and fold is above ASCII, so plain ASCII needs one filter only
    plain = F.regexp_replace(text, charsets.DROPPED_ASCII, "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), full).otherwise(plain)


def _clean_whole(text: Column, family: str, folds: Mapping[str, str] | None) -> Column:
    # after the character filter only space, tab and line feed can be white space
    tidied = F.trim(tidy_blanks(allowed_text(text, folds)), F.lit(" \t\n"))
    return controls_to_tokens(tidied, family)


def clean_with_table(
    docs: DataFrame,
    folder: Callable[[Column], Column],
    family: str = "tiktoken",
    text: str = "text",
) -> DataFrame:
    """:func:`clean_text` of a column with the folds of :func:`folding.table_folder`.

    The table's function cannot stand inside another expression, so the steps before and after it
    are projections of their own.
    """
    pairs = tables.SIGN_REPLACEMENTS + _circled_pairs() + tables.EMOJI_SENTINELS
    spelled = docs.withColumn(text, replace_where_marked(drop_carriage_returns(F.col(text)), pairs))
    folded = spelled.withColumn(text, folder(F.col(text)))
    tidied = F.trim(tidy_blanks(drop_unknown_characters(F.col(text))), F.lit(" \t\n"))
    return folded.withColumn(text, controls_to_tokens(tidied, family))


def clean_text(
    text: Column,
    family: str = "tiktoken",
    keep_control_tokens: bool = False,
    folds: Mapping[str, str] | None = None,
) -> Column:
    """The whole cleaning of one text.

    With ``keep_control_tokens`` the control tokens already in the text stay and the
    parts between them are cleaned, each on its own. ``folds`` replaces the default
    table of ASCII spellings.
    """

    def whole(value: Column) -> Column:
        return _clean_whole(value, family, folds)

    def by_parts(value: Column) -> Column:
        parts = control.around_control(value, lambda part: F.array(whole(part)), family)
        return F.when(control.holds_control(value, family), F.concat_ws("", parts)).otherwise(
            whole(value)
        )

    if keep_control_tokens:
        # a carriage return inside a token hides it until the returns are gone
        return once(drop_carriage_returns(text), by_parts)
    return once(text, whole)


def unclean_text(
    text: Column, family: str = "tiktoken", keep_control_tokens: bool = False
) -> Column:
    """Readable text again: emoji sequences back, control tokens spelled out."""
    decoded = once(text, decode_emoji)
    if keep_control_tokens:
        return decoded
    token = control.spelling(family)
    # order matters only in that no readable form holds a token
    pairs = [(token[name], readable) for name, readable in tables.READABLE_CONTROL.items()]
    return replace_in_order(decoded, pairs)
