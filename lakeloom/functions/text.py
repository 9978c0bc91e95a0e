"""Column expressions for line and word handling.

Words follow ASCII rules throughout: only A-Z and a-z are letters, and only they change case.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

ASCII_WHITESPACE = " \t\n\x0b\f\r"


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ascii(col: str | Column) -> Column:
    """Remove ASCII white space, not only spaces, from both ends."""
    return F.btrim(as_column(col), F.lit(ASCII_WHITESPACE))


SPACE = r"[ \t\n\x0B\f\r]"
INK = r"[^ \t\n\x0B\f\r]"


def words(col: str | Column) -> Column:
    """White-space separated tokens as an array; a blank line gives an empty array."""
    return F.array_remove(F.split(as_column(col), f"{SPACE}+"), "")


def lower_ascii(col: str | Column) -> Column:
    return F.translate(as_column(col), string.ascii_uppercase, string.ascii_lowercase)


def clean_word(col: str | Column) -> Column:
    """Strip non-letters from both ends and lower the case; may give an empty string."""
    return lower_ascii(F.regexp_replace(as_column(col), "^[^A-Za-z]+|[^A-Za-z]+$", ""))


def clean_words(col: str | Column) -> Column:
    """The cleaned words of a line as an array, without empty ones.

    The same as cleaning each token, but in one pass over the line: non-letters go where they
    follow white space or the start, and where white space or the end follows them.
    """
    not_letters = r"[^A-Za-z \t\n\x0B\f\r]++"
    stripped = F.regexp_replace(
        as_column(col), f"(?<!{INK}){not_letters}|(?<=[A-Za-z]){not_letters}(?!{INK})", "")
    return words(lower_ascii(stripped))


def delimited_tokens(col: str | Column, delimiters: str = "[\t ]*") -> Column:
    """Split at any one of the characters in ``delimiters`` and drop empty tokens."""
    char_class = "".join("\\" + c if c in "[]^-\\*" else c for c in delimiters)
    return F.array_remove(F.split(as_column(col), f"[{char_class}]+"), "")


def field(col: str | Column, index: int, sep: str = ",") -> Column:
    """Field ``index`` of a delimited line, NULL when the line is shorter."""
    return F.get(F.split(as_column(col), rf"\Q{sep}\E"), F.lit(index))


def parse_int(col: str | Column) -> Column:
    """Integer, or NULL when the text is not one."""
    return as_column(col).try_cast("bigint")


def parse_double(col: str | Column) -> Column:
    return as_column(col).try_cast("double")
