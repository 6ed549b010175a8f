"""Attributes derived from a listing's property map, equipment set and text.

All functions map Columns to Columns, so the whole roll-up projection stays
inside one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlife import config
from adlife.functions.parse import _col


def _missing() -> Column:
    return F.lit(str(config.NULL_INT))


def _value_or_missing(props, key: str) -> Column:
    return F.coalesce(F.try_element_at(_col(props), F.lit(key)), _missing())


def map_text(props, key: str) -> Column:
    """Value at ``key``; null when absent (as the original's map lookup)."""
    return F.try_element_at(_col(props), F.lit(key))


def map_equals(props, key: str, value: str) -> Column:
    return F.coalesce(map_text(props, key) == F.lit(value), F.lit(False))


def map_has_key(props, key: str) -> Column:
    return F.coalesce(F.map_contains_key(_col(props), F.lit(key)), F.lit(False))


def engine_volume(props, key: str = config.KEY_ENGINE_VOLUME) -> Column:
    """``'2,3 l'`` -> 2.3: drop ASCII letters and whitespace, comma -> dot; else -1."""
    text = F.regexp_replace(_value_or_missing(props, key), r"[A-Za-z\s ]", "")
    parsed = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    return F.coalesce(parsed, F.lit(float(config.NULL_INT)))


def power(props, key: str = config.KEY_POWER) -> Column:
    """``'135 Hk'`` -> 135; anything left besides digits -> -1."""
    text = F.regexp_replace(_value_or_missing(props, key), r"[A-Za-z\s]", "")
    return F.coalesce(text.try_cast("int"), F.lit(config.NULL_INT))


def weight(props, key: str = config.KEY_WEIGHT, legacy: bool = True) -> Column:
    """``'1 440 kg'`` -> 1440 by keeping only digits.

    With ``legacy`` a missing key gives 1, as in the original: its default
    ``-1`` loses the minus sign to the digit filter. ``legacy=False`` gives -1.
    """
    raw = map_text(props, key)
    digits = F.regexp_replace(F.coalesce(raw, _missing()), r"\D", "")
    parsed = F.coalesce(digits.try_cast("int"), F.lit(config.NULL_INT))
    if legacy:
        return parsed
    return F.when(raw.isNull(), F.lit(config.NULL_INT)).otherwise(parsed)


def owners(props, key: str = config.KEY_OWNERS) -> Column:
    """Plain int value, -1 when absent or not a number."""
    return F.coalesce(_value_or_missing(props, key).try_cast("int"), F.lit(config.NULL_INT))


def has_label(equipment, label: str) -> Column:
    return F.coalesce(F.array_contains(_col(equipment), F.lit(label)), F.lit(False))


def has_any_label(equipment, labels: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(x) for x in labels])
    return F.coalesce(F.arrays_overlap(_col(equipment), wanted), F.lit(False))


def interior_class(equipment, leather=config.LEATHER_LABELS,
                   part_leather=config.PART_LEATHER_LABEL) -> Column:
    """Leather labels -> leather; else part-leather label -> part leather; else cloth."""
    return (F.when(has_any_label(equipment, leather), F.lit(config.INTERIOR_LEATHER))
            .when(has_label(equipment, part_leather), F.lit(config.INTERIOR_PART_LEATHER))
            .otherwise(F.lit(config.INTERIOR_CLOTH)))


def contains_any(text, phrases: Sequence[str]) -> Column:
    """True when the text contains any phrase, case as written."""
    text = _col(text)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | text.contains(phrase)
    return F.coalesce(hit, F.lit(False))


def municipality(location) -> Column:
    """Placeholder kept from the original: always the text sentinel."""
    return F.lit(config.NULL_TEXT)


def county(location) -> Column:
    """Placeholder kept from the original: always the text sentinel."""
    return F.lit(config.NULL_TEXT)
