"""Words and lines of a text as native expressions.

A word is a longest run of characters other than space and U+0009..U+000D; a
line is what stands between two ``\\n``.  A null text has no word and no line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of ``text`` in order (empty for null or blank)."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return (F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+"))
            .otherwise(F.array().cast("array<string>")))


def n_words(text: Column) -> Column:
    """Number of words (0 for null)."""
    return F.size(words(text)).cast("bigint")


def lines(text: Column) -> Column:
    """Array of the lines of ``text`` (empty for null)."""
    return F.when(text.isNotNull(), F.split(text, "\n")).otherwise(F.array().cast("array<string>"))


def is_blank(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(WHITE_SPACE))) == 0
