"""The daily incremental job: raw snapshots -> daily table -> lifecycle table.

One run, for a given ``today`` (a parameter, never the clock inside a plan):

1. probe the daily table for the newest loaded date within the safety
   margin (else the first-load date) — one scalar comes back to the driver;
2. the delta is every date from that one (inclusive, so a partly loaded
   day is reloaded) to ``today``: a partition-pruned scan of both raw tables;
3. bring the table of newest unsold prices forward to the look-back's start
   (it reads only the raw partitions since its last version), build the typed
   daily rows for the delta (sold prices looked up in the raw partitions of the
   look-back and that table) and upsert them on (load_date, url);
4. bring the table of closed months forward (one row per url and month, made once
   from the daily rows when no run can change the month any more), and roll the window
   (``today`` - 365 days: closed months and the days at its ends) up to lifecycle rows for
   the urls seen in the delta; store them as this run's version of their urls;
5. tidy: settled versions are merged in tiers, raw partitions of many run folders are
   sorted into one, and folders that no reader can be using are deleted.

Every step is a Spark job over whole partitions; reruns are idempotent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlife import config, schemas
from adlife.functions.dates import iso_shift, month_end, months_between
from adlife.operators.daily import build_daily, newest_unsold
from adlife.operators.lifecycle import WINDOW_FIELDS, lifecycle_rollup, month_partials
from adlife.sinks.tables import (ConcurrentWrite, merge_runs, merge_tiers, read_current, stored_table, upsert, vacuum,
                                 versions, write_version)
from adlife.sources import tables as src
from adlife.streaming.ingest import RAW_ORDER


@dataclass(frozen=True)
class Tables:
    raw_headers: str
    raw_details: str
    daily: str
    lifecycle: str
    prices: str | None = None
    months: str | None = None

    @property
    def price_table(self) -> str:
        """Newest unsold price per url, in versions; beside the daily table unless named."""
        return self.prices or f"{self.daily.rstrip('/')}_prices"

    @property
    def month_table(self) -> str:
        """Partials of closed months per url; beside the daily table unless named."""
        return self.months or f"{self.daily.rstrip('/')}_months"


def read_lifecycle(spark: SparkSession, path: str):
    """The newest lifecycle row of every url."""
    return read_current(spark, path, schemas.LIFECYCLE, ["url"])


def price_schema(headers: DataFrame) -> T.StructType:
    return T.StructType([headers.schema[c] for c in ("url", "load_time", "price", "seq") if c in headers.columns])


def prices_before(spark: SparkSession, path: str, headers: DataFrame, day: str) -> DataFrame:
    """The newest unsold header of every url in the partitions before ``day``.

    The table at ``path`` holds versions; version d has the urls with unsold rows since the version
    before it. Raw partitions are read only from the last version up to ``day``, once.
    """
    schema = price_schema(headers)
    last = max(versions(spark, path, day), default=None)
    if last is None or last < day:
        since = F.col("load_date") < day if last is None else (F.col("load_date") >= last) & (F.col("load_date") < day)
        write_version(spark, newest_unsold(headers.where(since)), path, ["url"], day)
    return read_current(spark, path, schema, ["url"], upto=day)


def closed_months(spark: SparkSession, path: str, daily: DataFrame, start: str, settled: str,
                  lo: str) -> tuple[DataFrame | None, list[str]]:
    """The partials of the closed months from ``lo`` on, and which months those are.

    A month is closed when it ended before ``settled``. Missing ones are made from the daily rows, and those
    that the run's delta (from ``start``) reached are made again: usually one month, once a month.
    """
    closed = [m for m in months_between(lo, settled) if lo <= f"{m}-01" and month_end(m) < settled]
    have = set(versions(spark, path))
    make = [m for m in closed if m not in have or m >= start[:7]]
    if make:
        rows = daily.where(F.col("load_date").between(f"{make[0]}-01", month_end(make[-1]))
                           & F.substring("load_date", 1, 7).isin(make)).select(*WINDOW_FIELDS)
        upsert(spark, month_partials(rows), path, ["month", "url"], partition_by="month", unique_keys=True)
    schema = month_partials(daily.select(*WINDOW_FIELDS)).schema
    return stored_table(spark, path, schema), [m for m in closed if m in set(versions(spark, path))]


def run_daily_batch(spark: SparkSession, tables: Tables, today: str, *,
                    window_days: int = config.LIFECYCLE_WINDOW_DAYS,
                    margin_days: int = config.SAFETY_MARGIN_DAYS,
                    first_load: str = config.FIRST_LOAD_DATE,
                    with_seq: bool = False) -> str:
    """Run the job for ``today``; returns the first date of the delta."""
    stored = stored_table(spark, tables.daily, schemas.DAILY)
    if stored is not None:
        start = src.latest_load_date(stored, today, margin_days, first_load).first()[0]
    else:
        start = first_load
    headers = src.read_raw_headers(spark, tables.raw_headers, with_seq=with_seq)
    details = src.read_raw_details(spark, tables.raw_details, with_seq=with_seq)
    in_delta = F.col("load_date").between(start, today)
    # sold prices: the raw partitions of the delta and the safety margin, and one stored row per url before
    recent_from = iso_shift(start, -margin_days)
    older = prices_before(spark, tables.price_table, headers, recent_from)
    daily_delta = build_daily(headers.where(in_delta), details.where(in_delta),
                              history=headers.where(F.col("load_date").between(recent_from, today)), older=older)
    # one row per (load_date, url) and per url by construction: no de-dup shuffle
    upsert(spark, daily_delta, tables.daily, ["load_date", "url"], unique_keys=True)
    daily = src.read_daily(spark, tables.daily)
    settled = iso_shift(recent_from, -margin_days)
    months, closed = closed_months(spark, tables.month_table, daily, start, settled, iso_shift(today, -window_days))
    rolled = lifecycle_rollup(daily, today, start, window_days=window_days, months=months, closed=closed)
    # a version per run: rows of urls outside the delta are neither read nor written
    write_version(spark, rolled, tables.lifecycle, ["url"], today)
    tidy(spark, tables, headers, settled)
    return start


def tidy(spark: SparkSession, tables: Tables, headers: DataFrame, settled: str) -> None:
    """Keep what readers have to open small: versions up to ``settled`` in tiers, raw partitions in few files.

    A step that meets another writer is left for the next run.
    """
    steps = (
        lambda: merge_tiers(spark, tables.lifecycle, schemas.LIFECYCLE, ["url"], settled),
        lambda: merge_tiers(spark, tables.price_table, price_schema(headers), ["url"], settled),
        lambda: merge_runs(spark, tables.raw_headers, headers.schema, RAW_ORDER),
        lambda: merge_runs(spark, tables.raw_details, schemas.RAW_DETAILS if "seq" not in headers.columns else
                           schemas.extended(schemas.RAW_DETAILS, ("seq", T.LongType())), RAW_ORDER),
    )
    for step in steps:
        try:
            step()
        except ConcurrentWrite:
            continue
    for path in (tables.daily, tables.month_table, tables.lifecycle, tables.price_table, tables.raw_headers, tables.raw_details):
        vacuum(spark, path)
