"""First / last / latest record per key (grouped arg-min / arg-max).

All of them are one ``groupBy`` with ``min_by`` / ``max_by`` on a struct, so
Spark combines map-side before the shuffle: a key that holds a third of the
rows still sends one partial row per map task, never its whole history to
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ORDER = ("load_time",)


def order_columns(df: DataFrame, order: Sequence[str] = DEFAULT_ORDER,
                  tiebreak: str | None = "seq") -> list[str]:
    """Ordering columns: ``order`` plus the tiebreak column when the frame has one."""
    cols = list(order)
    if tiebreak and tiebreak in df.columns and tiebreak not in cols:
        cols.append(tiebreak)
    return cols


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool,
          where: Column | None) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if where is not None:
        df = df.where(where)
    by = F.struct(*order)
    pick = F.max_by if newest else F.min_by
    return (df.groupBy(*keys)
              .agg(pick(F.struct(*payload), by).alias("__rec"))
              .select(*keys, *[F.col("__rec")[c].alias(c) for c in payload]))


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("load_date", "url"),
                   order: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key by ``order`` (default ``load_time`` + optional ``seq``)."""
    return _pick(df, keys, order or order_columns(df), True, None)


def first_record(df: DataFrame, key: str | Sequence[str] = "url", where: Column | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """Oldest row per key, optionally among rows satisfying ``where``."""
    keys = [key] if isinstance(key, str) else list(key)
    return _pick(df, keys, order or order_columns(df), False, where)


def last_record(df: DataFrame, key: str | Sequence[str] = "url", where: Column | None = None,
                order: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key, optionally among rows satisfying ``where``."""
    keys = [key] if isinstance(key, str) else list(key)
    return _pick(df, keys, order or order_columns(df), True, where)


def distinct_keys(df: DataFrame, key: str = "url") -> DataFrame:
    return df.select(key).distinct()


def semi_join_keys(df: DataFrame, keys_df: DataFrame, key: str = "url") -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df`` (EXISTS, no duplication)."""
    return df.join(keys_df.select(key), key, "left_semi")
