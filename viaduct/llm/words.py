"""Words of a text, as Column expressions.

Fixed values: a word is a run of characters other than the blank and the code points 9 to 13.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str | Column = "text") -> Column:
    """The text as a string; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are. Texts of ASCII only take the faster built-in."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
