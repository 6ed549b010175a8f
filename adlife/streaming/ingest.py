"""Structured Streaming ingest: page messages -> raw header and details tables.

Any streaming DataFrame with a string column ``value`` holding one listing
page per row will do (Kafka in production, a file source in tests). Every
micro-batch is flattened once, persisted for its two sinks, and appended with
key-based de-duplication. Each append publishes (query id, batch number) with its rows, so
a batch that is replayed after a failure is skipped by the tables that have it, without
reading them; rows that come again in another batch are dropped by their keys. Files are
sorted by url, newest first. Progress and offsets live in the checkpoint location.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adlife.operators.pages import (explode_listing, extract_all, extracted_details, linked_ads, sent_if_small,
                                    urls_with_page, with_details)
from adlife.sinks.manifest import current, row_counts
from adlife.sinks.tables import append_keyed

RAW_KEY = ("load_date", "url", "load_time")
RAW_ORDER = ("url", "-load_time")


def _stored(spark: SparkSession, path: str, batch_id: tuple[str, int]) -> bool:
    version = current(spark, path)
    return version is not None and version.batches.get(batch_id[0], -1) >= batch_id[1]


def _beside(work: Callable[[], None]) -> Callable[[], None]:
    """Start ``work`` in a thread of its own; the function that is returned waits for it and raises what it raised."""
    failed: list[BaseException] = []

    def run() -> None:
        try:
            work()
        except BaseException as e:  # noqa: BLE001 - raised again by whoever waits
            failed.append(e)
    thread = InheritableThread(target=run)
    thread.start()

    def wait() -> None:
        thread.join()
        if failed:
            raise failed[0]
    return wait


def ingest_batch(spark: SparkSession, batch: DataFrame, header_path: str, details_path: str,
                 pages: DataFrame | None, selectors: Mapping[str, str] | None = None,
                 zone: str = "UTC", batch_id: tuple[str, int] | None = None, extractions: str | None = None,
                 extracted: bool = False) -> None:
    """Flatten one batch of page messages and append headers and details.

    ``batch_id`` (query id, batch number) makes a replay of the whole batch free of any scan. ``extractions`` is
    the path of a store of page extractions: a page is then parsed once, not once a batch. ``extracted`` states
    that ``pages`` are extractions (:func:`~adlife.operators.pages.extract_all`). Both tables are written at the same
    time; the details are published after the headers.
    """
    if batch_id is not None and _stored(spark, header_path, batch_id) and (
            pages is None or _stored(spark, details_path, batch_id)):
        return
    if batch.isEmpty():
        return
    kept = [explode_listing(batch, zone).persist()]
    headers = kept[0]
    try:
        if pages is None:
            append_keyed(spark, headers, header_path, RAW_KEY, batch=batch_id, order=RAW_ORDER)
            return
        headers.count()                              # both tables are written from the cache, side by side
        stored = _beside(lambda: append_keyed(spark, headers, header_path, RAW_KEY, batch=batch_id, order=RAW_ORDER))
        try:
            linked = linked_ads(headers)
            kept.append(urls_with_page(pages, linked.select("url").distinct()).persist())
            asked = pages.join(sent_if_small(kept[-1]), "url", "left_semi")
            kept.append((asked if extracted else extracted_details(asked, selectors, extractions)).persist())
            details = sent_if_small(kept[-1])
            append_keyed(spark, linked, details_path, RAW_KEY, batch=batch_id, order=RAW_ORDER,
                         derive=lambda rows: with_details(rows, details), before_publish=stored)
        finally:
            stored()
    finally:
        for rows in kept:
            rows.unpersist()


def ingest_counts(spark: SparkSession, header_path: str, details_path: str) -> DataFrame:
    """(load_date, n_headers, n_details) stored by the ingest: from the counts published with each batch,
    no table is read. Raises if a table was not written by the keyed sinks (it has no counts)."""
    held = [row_counts(spark, p) for p in (header_path, details_path)]
    if any(h is None for h in held):
        raise ValueError("a table has rows that were stored without counts")
    days = sorted({d for h in held for d in h if d is not None})
    return spark.createDataFrame([(d, *[h.get(d, 0) for h in held]) for d in days],
                                 "load_date string, n_headers long, n_details long")


def start_ingest(messages: DataFrame, header_path: str, details_path: str, checkpoint: str,
                 pages: DataFrame | None = None, selectors: Mapping[str, str] | None = None,
                 zone: str = "UTC", processing_time: str | None = "60 seconds",
                 available_now: bool = False, query_name: str | None = None,
                 extractions: str | None = None, extract_once: str | None = None) -> StreamingQuery:
    """Start the ingest query; ``available_now`` drains what is there and stops.

    By default every batch looks at ``pages`` as they are then, and parses those that its ads link to.
    ``extract_once`` is a folder for pages that do not change while the query runs: all are parsed into it now, and
    batches read the extractions alone, so that the pages are not read again with every batch.
    """
    spark = messages.sparkSession
    extracted = pages is not None and extract_once is not None
    if extracted:
        pages = extract_all(pages, extract_once, selectors)

    started, query_id = threading.Event(), []

    def each(batch: DataFrame, number: int) -> None:
        started.wait()                               # the id is the checkpoint's, the same after a restart
        ingest_batch(spark, batch, header_path, details_path, pages, selectors, zone, (query_id[0], number), extractions,
                     extracted)

    writer = messages.select("value").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    query_id.append(query.id)
    started.set()
    return query
