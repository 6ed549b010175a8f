"""JSON text readers for the raw details columns (Column -> Column).

Invalid JSON gives the sentinel map / set instead of an exception, and
non-string map values are kept as their JSON text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlife import config
from adlife.functions.parse import _col


def null_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in config.NULL_MAP.items() for x in kv])


def null_set() -> Column:
    return F.array(*[F.lit(x) for x in config.NULL_SET])


def json_map(text, excluded: Sequence[str] = config.DEFAULT_EXCLUDED) -> Column:
    """JSON object of strings -> ``map<string,string>`` without ``excluded`` keys."""
    parsed = F.from_json(_col(text), "map<string,string>")
    kept = F.map_filter(parsed, lambda k, v: ~k.isin(list(excluded))) if excluded else parsed
    return F.coalesce(kept, null_map())


def json_set(text, excluded: Sequence[str] = config.DEFAULT_EXCLUDED) -> Column:
    """JSON array of strings -> sorted distinct ``array<string>`` without ``excluded``."""
    parsed = F.array_distinct(F.from_json(_col(text), "array<string>"))
    kept = F.filter(parsed, lambda x: ~x.isin(list(excluded))) if excluded else parsed
    return F.coalesce(F.array_sort(kept), null_set())


def json_string(text) -> Column:
    """JSON string literal -> its text; text that is no such literal is kept as is."""
    text = _col(text)
    unquoted = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string").getField("v")
    return F.when(F.trim(text).startswith('"'), F.coalesce(unquoted, text)).otherwise(text)


def quote_json_string(text) -> Column:
    """Text -> JSON string literal (the inverse of :func:`json_string`)."""
    text = _col(text)
    wrapped = F.to_json(F.struct(text.alias("v")))
    # (?s): JSON leaves U+0085 / U+2028 unescaped, and they end a line for `.`
    return F.when(text.isNotNull(), F.regexp_extract(wrapped, r'(?s)^\{"v":(.*)\}$', 1))
