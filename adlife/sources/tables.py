"""Scans of the date-partitioned listing tables.

Every scan states its schema (``load_date`` stays ISO text) and filters on
the partition column, so Catalyst prunes directories (``PartitionFilters``)
and pushes the rest into the Parquet reader (``PushedFilters``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlife import config, schemas
from adlife.functions.dates import dates_between, iso_shift
from adlife.sinks.tables import stored_table

DAILY_RANGE_COLUMNS = tuple(schemas.DAILY.names)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of a table of the keyed sinks, or a plain Parquet table, at ``path``."""
    stored = stored_table(spark, path, schema)
    return stored if stored is not None else spark.read.schema(schema).parquet(path)


def read_raw_headers(spark: SparkSession, path: str, with_seq: bool = False) -> DataFrame:
    schema = schemas.extended(schemas.RAW_HEADER, ("seq", T.LongType())) if with_seq else schemas.RAW_HEADER
    return read_table(spark, path, schema)


def read_raw_details(spark: SparkSession, path: str, with_seq: bool = False) -> DataFrame:
    schema = schemas.extended(schemas.RAW_DETAILS, ("seq", T.LongType())) if with_seq else schemas.RAW_DETAILS
    return read_table(spark, path, schema)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.DAILY)


def scan_dates(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Rows of the given load dates (one pruned scan, not one scan per date)."""
    return df.where(F.col("load_date").isin(list(dates)))


def union_slices(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Bag union of one slice per date: the rows of a date that is named k times come k times.

    One pruned scan, however many dates there are.
    """
    times = Counter(dates)
    rows = scan_dates(df, list(times))
    often = {d: n for d, n in times.items() if n > 1}
    if not often:
        return rows
    named = F.coalesce(*[F.when(F.col("load_date") == d, n) for d, n in often.items()], F.lit(1))
    copies = "__copy"
    return rows.withColumn(copies, F.explode(F.array_repeat(F.lit(0), named))).drop(copies)


def scan_date_range(df: DataFrame, start: str, end: str,
                    columns: Sequence[str] = DAILY_RANGE_COLUMNS) -> DataFrame:
    """Inclusive ISO date range with a column projection."""
    return df.where(F.col("load_date").between(start, end)).select(*columns)


def history_of(df: DataFrame, urls: Sequence[str], until_time: int | None = None, until_date: str | None = None) -> DataFrame:
    """The snapshots of a few ``urls`` up to a time (and date), newest first: a point read.

    The urls reach the Parquet reader as single equalities, as long as there are at most as many as it takes
    (``spark.sql.parquet.pushdown.inFilterThreshold``); it skips row groups by their statistics and Bloom filters,
    and pages by the page index. For many urls semi-join the history with them instead.
    """
    rows = df.where(F.col("url").isin(list(urls)))
    if until_time is not None:
        rows = rows.where(F.col("load_time") <= until_time)
    if until_date is not None:
        rows = rows.where(F.col("load_date") <= until_date)
    return rows.orderBy("url", F.desc("load_time"))


def latest_load_date(df: DataFrame, as_of: str | Column,
                     margin_days: int = config.SAFETY_MARGIN_DAYS,
                     first_load: str = config.FIRST_LOAD_DATE) -> DataFrame:
    """One row: newest ``load_date`` in ``[as_of - margin, as_of]``, else ``first_load``.

    ``as_of`` is a parameter (never the clock inside the plan); the filter
    prunes partitions, so only the margin's days are read.
    """
    as_of_col = F.lit(as_of) if isinstance(as_of, str) else as_of
    lo = F.date_format(F.date_sub(F.to_date(as_of_col), margin_days), "yyyy-MM-dd")
    window = df.where(F.col("load_date").between(lo, as_of_col))
    return window.agg(F.coalesce(F.max("load_date"), F.lit(first_load)).alias("latest_load_date"))


def delta_dates(df: DataFrame, today: str, margin_days: int = config.SAFETY_MARGIN_DAYS,
                first_load: str = config.FIRST_LOAD_DATE) -> DataFrame:
    """Dates to (re)load: from the latest loaded date (inclusive) to ``today``."""
    probe = latest_load_date(df, today, margin_days, first_load)
    return probe.select(F.explode(dates_between(F.col("latest_load_date"), F.lit(today))).alias("load_date"))


def window_bounds(as_of: str, window_days: int = config.LIFECYCLE_WINDOW_DAYS) -> tuple[str, str]:
    """(as_of - window_days, as_of) as ISO text."""
    return iso_shift(as_of, -window_days), as_of


def sample(df: DataFrame, order: Sequence[str | Column], n: int = 1,
           columns: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows by ``order`` (a distributed top-n, not a full sort)."""
    out = df.select(*columns) if columns else df
    return out.orderBy(*order).limit(n)
