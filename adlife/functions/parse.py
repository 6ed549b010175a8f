"""Text -> number parsers (Column -> Column), all JVM-side expressions.

Every parser returns -1 for text that is not a plain run of ASCII digits after
its clean-up step; empty text and values beyond int range also give -1 (the
original throws there). Spark 4 runs with ANSI mode on, so only ``try_cast``
is used on parsed text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlife import config

_DIGITS = r"^[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(text: Column, *tokens: str) -> Column:
    for token in tokens:
        text = F.replace(text, F.lit(token), F.lit(""))
    return text


def digits_to_int(text) -> Column:
    """Plain digits -> int, anything else (also empty / overflow / null) -> -1."""
    text = _col(text)
    return F.coalesce(F.when(text.rlike(_DIGITS), text.try_cast("int")), F.lit(config.NULL_INT))


def parse_km(text) -> Column:
    """``'99 000 km'`` -> 99000: drop spaces, ``km`` and quotes."""
    return digits_to_int(_strip(_col(text), " ", "km", '"'))


def parse_year(text) -> Column:
    """``'2007'`` or ``'"2007"'`` -> 2007."""
    return digits_to_int(_strip(_col(text), '"'))


def parse_price(text) -> Column:
    """``'149 000,-'`` -> 149000: drop ``,-``, spaces and quotes."""
    return digits_to_int(_strip(_col(text), ",-", " ", '"'))


def parse_code(url, width: int = 8) -> Column:
    """Ad code = the last ``width`` characters of the url, quotes dropped.

    A url shorter than ``width`` gives -1 (the original throws).
    """
    url = _col(url)
    tail = _strip(F.right(url, F.lit(width)), '"')
    return F.when(F.length(url) >= width, digits_to_int(tail)).otherwise(F.lit(config.NULL_INT))


def is_sold(price_text, marker: str = config.SOLD_MARKER) -> Column:
    """Exact match of the price text with the sold marker; null -> false."""
    return F.coalesce(_col(price_text) == F.lit(marker), F.lit(False))


def parse_double(text) -> Column:
    """Text -> double, null when it does not parse."""
    return _col(text).try_cast("double")
