"""Text expressions with the null behaviour of the measure's SQL dialect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTE = "'"
CRLF = "\r\n"


def concat_null_empty(*parts: Column | str) -> Column:
    """Concatenate, a NULL counting as the empty string."""
    return F.concat_ws("", *(_col(p).cast("string") for p in parts))


def quote_wrap(c: Column | str) -> Column:
    return concat_null_empty(F.lit(QUOTE), _col(c), F.lit(QUOTE))


def location_label(city: Column | str, state: Column | str) -> Column:
    """``'City, 'State``: one opening quote before each part, none closing."""
    return concat_null_empty(F.lit(QUOTE), _col(city), F.lit(", "), F.lit(QUOTE), _col(state))


def report_line(label: str, value: Column, leading_break: bool = False) -> Column:
    """Report text; unlike the other concatenations a NULL value makes it NULL."""
    prefix = (CRLF if leading_break else "") + label + ": "
    return F.concat(F.lit(prefix), cast_text(value))


def strip_dots(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit("."), F.lit(""))


def cast_text(c: Column | str, length: int | None = None) -> Column:
    """Cast to text, whole; a text longer than ``length``, if one is given, is an error."""
    text = _col(c).cast("string")
    if length is None:
        return text
    too_long = F.raise_error(F.concat(F.lit(f"text longer than {length}: "), text))
    return F.when(F.char_length(text) > length, too_long).otherwise(text)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
