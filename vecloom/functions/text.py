"""Splitting and parsing of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a line ends, what parts words, what a whole number looks like.
LINE_END = r"\r\n|\n|\r"
BLANKS = r"\s+"
WHOLE_NUMBER = r"^[+-]?[0-9]+$"

#: Words, digit groups and punctuation runs, each with at most one leading blank. It needs no
#: look-ahead, so other engines' regular expressions read it alike.
PIECE = r" ?\p{L}+| ?\p{N}{1,3}| ?[^\s\p{L}\p{N}]+"

#: Why a parser drops a row.
NO_VALUE, NO_TAB, NO_NUMBER, NO_TOKENS, NO_PAIR, NO_VECTOR = (
    "no value", "no tab", "not a number", "no tokens", "not two fields", "not a vector")


def rejected(*grounds: tuple[Column, str]) -> Column:
    """The column ``reason``: what the first ground that holds is called, NULL if none does."""
    reason = F.lit(None).cast("string")
    for holds, name in reversed(grounds):
        reason = F.when(holds, name).otherwise(reason)
    return reason.alias("reason")


def lines_of(text: Column) -> Column:
    """The lines of a text. A line end closes a line, so none follows the last one; no text, no line."""
    parts = F.split(text, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def words_of(text: Column) -> Column:
    """The words between blanks; a leading or trailing blank makes no empty word."""
    return F.filter(F.split(text, BLANKS), lambda word: word != "")


def pieces_of(text: Column) -> Column:
    """The regular-expression pieces of a text, the tokens SQL can make."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def piece_id(piece: Column, vocab_size: int) -> Column:
    """A token id below ``vocab_size`` for a piece, from its md5."""
    hashed = F.conv(F.substring(F.md5(piece), 1, 8), 16, 10).cast("bigint")
    return F.pmod(hashed, F.lit(vocab_size).cast("bigint")).cast("int")


def piece_ids_of(text: Column, vocab_size: int) -> Column:
    return F.transform(pieces_of(text), lambda piece: piece_id(piece, vocab_size))


def whole_numbers(words: Column) -> Column:
    """The words that are 32-bit whole numbers, as ints; every other word is skipped alone."""
    shaped = F.filter(words, lambda word: word.rlike(WHOLE_NUMBER))
    return F.filter(F.transform(shaped, lambda word: word.try_cast("int")), lambda n: n.isNotNull())


def whole_part(number: Column, divisor: int) -> Column:
    """Division of whole numbers, rounded down, in whole numbers throughout, so exact up to the ends of 64 bits."""
    by = F.lit(divisor).cast("bigint")
    number = number.cast("bigint")
    down = F.call_function("div", number, by)
    return down - F.when((number % by != 0) & ((number < 0) != F.lit(divisor < 0)), 1).otherwise(0)


def must_cast(value: Column, type_name: str) -> Column:
    """Cast, or fail the job with the value that cannot be read, whatever the session's ANSI setting."""
    complaint = F.raise_error(F.concat(F.lit(f"not a {type_name}: "), value))
    return F.coalesce(value.try_cast(type_name), F.when(value.isNotNull(), complaint).cast(type_name))


def stripped(text: Column) -> Column:
    """Without white space and control characters at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def pair_field(fields: Column, place: int) -> Column:
    """A field of a row that has two, else NULL: Spark may evaluate it before a filter on the number of fields."""
    return F.when(F.size(fields) == 2, F.get(fields, F.lit(place)))


def float_list(text: Column) -> Column:
    """The comma-separated fields inside ``[...]``, as strings; a cast to a number takes no notice of blanks around them."""
    bare = F.regexp_replace(F.regexp_replace(stripped(text), r"^\[", ""), r"\]$", "")
    return F.split(F.regexp_replace(bare, ",+$", ""), ",")
