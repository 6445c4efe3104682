"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floatlake.catalog import CSV_NULL_TOKENS, READING_NULL_TOKENS

_BLANKS = " \t\n\r\f\v"
# Plain decimal notation only: the SQL cast alone would also take "1d" or "1f".
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove blanks of every kind from both ends."""
    return F.btrim(col(c), F.lit(_BLANKS))


def null_tokens(c: Column | str) -> Column:
    """Null for the CSV null tokens (compared untrimmed), else the text itself."""
    c = col(c)
    return F.when(~c.isin(CSV_NULL_TOKENS), c)


def reading_value(c: Column | str) -> Column:
    """Trimmed text, or null when nothing is left to load."""
    text = strip(null_tokens(c))
    return F.when(~text.isin(READING_NULL_TOKENS), text)


def clean_bytes(c: Column | str) -> Column:
    """Trim, then drop the wrapper of byte-string text such as b'AB' or b"AB"."""
    return unwrapped(strip(c))


def unwrapped(text: Column) -> Column:
    """Trimmed text without the wrapper of byte-string text."""
    wrapped = (text.startswith("b'") & text.endswith("'")) | (
        text.startswith('b"') & text.endswith('"')
    )
    inner = F.substring(text, F.lit(3), F.greatest(F.length(text) - 3, F.lit(0)))
    return F.when(wrapped, inner).otherwise(text)


def decode_text(c: Column | str, drop_invalid: bool = True) -> Column:
    """Binary to UTF-8 text; undecodable bytes are left out, or with drop_invalid off an error."""
    c = col(c)
    if drop_invalid:
        return F.replace(F.make_valid_utf8(c.cast("string")), F.lit("�"), F.lit(""))
    return F.decode(c, "UTF-8")


def join_chars(c: Column | str, binary: bool = False) -> Column:
    """One trimmed string from an array of characters, or of bytes in binary form."""
    chars = F.transform(col(c), lambda x: decode_text(x)) if binary else col(c)
    return strip(F.array_join(chars, ""))


def parses_as_float(c: Column | str) -> Column:
    """True where the text is a number, an infinity or nan (any case)."""
    text = strip(c)
    return F.coalesce(
        text.rlike(_NUMBER) | text.rlike(_INFINITY) | text.rlike(r"(?i)^[+-]?nan$"),
        F.lit(False),
    )


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    text = strip(c)
    sign = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(text.rlike(_NUMBER), text.try_cast("double"))
        .when(text.rlike(_INFINITY), sign)
    )


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def is_finite(c: Column | str) -> Column:
    """True for a real number; null, NaN and infinities are false."""
    c = col(c)
    infinity = float("inf")
    # NaN sorts above infinity, so one upper and one lower bound cover it.
    return F.coalesce((c > F.lit(-infinity)) & (c < F.lit(infinity)), F.lit(False))
