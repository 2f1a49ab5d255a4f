"""Column expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " "
NON_WORD = r"\W+"
# White space, no-break spaces not among it.
WHITE_SPACE = (
    r"\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}"
    r"\x{205F}\x{3000}"
)


def is_not_blank(text: Column) -> Column:
    """True for text with a character that is no white space; null counts as blank."""
    return F.coalesce(text.rlike(f"[^{WHITE_SPACE}]"), F.lit(False))


def space_tokens(text: Column) -> Column:
    """Tokens between single spaces.

    Empty tokens inside the text are kept, trailing ones are dropped, and text
    made of spaces only has no token at all.
    """
    body = F.rtrim(text)
    only_spaces = (F.length(body) == 0) & (F.length(text) > 0)
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(
        F.split(body, SPACE)
    )


def word_pieces(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and underscores, in order.

    The first and last piece are empty when the text begins or ends otherwise.
    """
    return F.split(F.lower(text), NON_WORD)


def char_at(code_point: Column) -> Column:
    """The character for a code point below 256."""
    return F.chr(code_point)
