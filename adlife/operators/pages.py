"""Listing pages and ad pages.

* :func:`explode_listing` — search-result page messages (JSON text) -> one raw
  header row per ad. Only the first ``group`` array is read; a missing
    element or an empty array gives the text sentinel; a page without ``data`` (or
  with empty ``data`` or ``group``) gives no rows. A missing timestamp leaves
  load time and date null: the keyed sinks set such rows aside.
* :func:`extract_pages` — ``(url, html)`` rows -> properties, equipment,
  text and header fields by CSS selectors (``mapInPandas``; the per-page
  parse is the only Python in the library). A null page is a deleted ad; a
  page whose parse fails keeps its row, with the reason in ``parse_error``.
* :func:`details_from_listing` — header rows -> raw details rows: each
  distinct ad url is looked up in a pages table once (its newest fetch),
  extracted, and the result joined back to every header row with that url.
  An ad without a link has no details.
* :func:`stored_details` — extractions kept by content between calls, so that
  an unchanged page is parsed once ever.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlife import config, schemas
from adlife.functions.dates import epoch_ms_to_local_date
from adlife.functions.jsontext import null_map, null_set, quote_json_string
from adlife.session import ship_package
from adlife.sinks.tables import append_keyed, stored_table, with_key_bucket

#: Rows of a store of extractions: details without the times of any header.
STORED_DETAILS = T.StructType([
    *[f for f in schemas.RAW_DETAILS.fields if f.name not in ("load_date", "load_time")],
    T.StructField("digest", T.StringType()), T.StructField("key_bucket", T.IntegerType())])

#: Bytes of text up to which the rows that a batch looks up are sent to the rows that look.
SENT_BYTES = 16_000_000

HEADER_FIELDS = ("location", "title", "year", "km", "price")


def explode_listing(messages: DataFrame, zone: str = "UTC", value_col: str = "value") -> DataFrame:
    """Raw header rows (RAW_HEADER) from page messages in column ``value_col``."""
    return explode_documents(messages.select(F.from_json(F.col(value_col), schemas.LISTING_PAGE).alias("doc")), zone)


def explode_documents(docs: DataFrame, zone: str = "UTC", doc_col: str = "doc") -> DataFrame:
    """Raw header rows (RAW_HEADER) from parsed listing pages (schema LISTING_PAGE) in ``doc_col``."""
    page = F.col(doc_col)
    time = page["pageData"]["timestamp"]
    read = docs.select(time.alias("load_time"), epoch_ms_to_local_date(time, zone).alias("load_date"),
                       F.get(page["extractorData"]["data"], F.lit(0))["group"].alias("group"))
    # The outer form: for the plain one Spark puts a filter on the array below the parsing, which then runs three
    # times a page. ``place`` is null where there are no ads (an ad itself may be null).
    ads = read.select("load_time", "load_date", F.posexplode_outer("group").alias("place", "ad")).where(F.col("place").isNotNull())

    def first_text(field: str, attr: str = "text"):
        return F.coalesce(F.get(F.col("ad")[field], F.lit(0))[attr], F.lit(config.NULL_TEXT))

    return ads.select(
        first_text("title", "href").alias("url"),
        "load_date",
        "load_time",
        first_text("title").alias("title"),
        first_text("location").alias("location"),
        first_text("year").alias("year"),
        first_text("km").alias("km"),
        first_text("price").alias("price"),
    )


def _extract_one(url: str, html, selectors: Mapping) -> dict:
    """One page -> extracted fields; ``selectors`` map field -> selector (text or compiled)."""
    from adlife.functions import html as H

    if html is None:
        return {"url": url, "properties": dict(config.NULL_MAP), "equipment": list(config.NULL_SET),
                "information": config.NULL_TEXT, "deleted": True,
                **{f: config.NULL_TEXT for f in HEADER_FIELDS}}
    nodes = H.parse(html)
    out: dict = {"url": url, "deleted": False}
    box = H.select_first(nodes, selectors["properties"])
    if box is None:
        out["properties"] = {config.MISSING_KEYS: config.MISSING_VALUES}
    else:
        props: dict = {}
        kids = box.children
        for i in range(0, len(kids), 2):       # children alternate key, value
            props[kids[i].text()] = kids[i + 1].text() if i + 1 < len(kids) else ""
        out["properties"] = props
    box = H.select_first(nodes, selectors["equipment"])
    out["equipment"] = [c.text() for c in box.children] if box is not None else [config.MISSING_VALUES]
    node = H.select_first(nodes, selectors["information"])
    out["information"] = node.text() if node is not None else config.MISSING_VALUES
    for f in HEADER_FIELDS:
        node = H.select_first(nodes, selectors[f])
        out[f] = node.text() if node is not None else config.MISSING_VALUE
    return out


def _nothing_found(url: str) -> dict:
    return {"url": url, "properties": {config.MISSING_KEYS: config.MISSING_VALUES},
            "equipment": [config.MISSING_VALUES], "information": config.MISSING_VALUES, "deleted": False,
            **{f: config.MISSING_VALUE for f in HEADER_FIELDS}}


def extract_pages(pages: DataFrame, selectors: Mapping[str, str] | None = None,
                  url_col: str = "url", html_col: str = "html", keep: tuple = ()) -> DataFrame:
    """Extraction result (schema EXTRACTED_PAGE, plus ``keep`` columns) per ``(url, html)`` row."""
    sel = {**config.DETAIL_SELECTORS, **(selectors or {})}
    keep = tuple(keep)
    schema = schemas.extended(schemas.EXTRACTED_PAGE, *[(c, pages.schema[c].dataType) for c in keep])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from adlife.functions import html as H
        compiled = {k: H.compile_selector(v) for k, v in sel.items()}   # once per task
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                try:
                    row = {**_extract_one(rec.url, rec.html if isinstance(rec.html, str) else None, compiled),
                           "parse_error": None}
                except Exception as e:  # noqa: BLE001 - one bad page must not fail the job; it is recorded
                    row = {**_nothing_found(rec.url), "parse_error": f"{type(e).__name__}: {e}"[:500]}
                for i, c in enumerate(keep):
                    row[c] = rec[2 + i]
                rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    ship_package(pages.sparkSession)
    src = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"), *keep)
    return src.mapInPandas(run, schema)


def to_raw_details(extracted: DataFrame, keep: tuple = ()) -> DataFrame:
    """Extraction -> stored form: JSON text for map, list and text (and the ``keep`` columns)."""
    return extracted.select(
        "url",
        F.to_json("properties").alias("properties"),
        F.to_json("equipment").alias("equipment"),
        quote_json_string("information").alias("information"),
        "deleted", *keep,
    )


def sent_if_small(rows: DataFrame) -> DataFrame:
    """``rows`` (persisted, of text) to join with: marked to be sent whole if their text is up to SENT_BYTES."""
    size = rows.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, t in rows.dtypes if t == "string"), F.lit(0)))).first()[0]
    return F.broadcast(rows) if (size or 0) <= SENT_BYTES else rows


def urls_with_page(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """Those of ``urls`` that ``pages`` holds; of the pages only the url column is read and shuffled.

    They are few, so that the pages themselves need not be shuffled to be found (:func:`sent_if_small`): html that
    nothing asks for is then neither moved nor sorted.
    """
    return pages.select("url").join(urls, "url", "left_semi").distinct()


def newest_pages(pages: DataFrame, urls: DataFrame | None, fetched: str | None = None) -> DataFrame:
    """(url, html) of the newest fetch of each of ``urls``; without ``fetched`` the greatest html, so reruns agree.

    The semi-join comes first: only pages that are asked for move, and a small url set can be sent to them.
    Without ``urls``: of all pages.
    """
    wanted = pages if urls is None else pages.join(urls, "url", "left_semi")
    order = F.struct(*([F.col(fetched)] if fetched else []), F.col("html").isNotNull(), F.col("html"))
    return wanted.groupBy("url").agg(F.max_by("html", order).alias("html"))


def stored_details(pages: DataFrame, selectors: Mapping[str, str] | None, store: str) -> DataFrame:
    """Details of ``pages`` (url, html), taken from the table at ``store`` where it has them.

    The store is addressed by content: url and a digest of the html and the selectors. Pages that it has not
    are parsed and appended; if there are none, no Python runs. Missing pages (null html) are not stored.
    """
    spark = pages.sparkSession
    chosen = json.dumps({**config.DETAIL_SELECTORS, **(selectors or {})}, sort_keys=True)
    key = ["key_bucket", "url", "digest"]
    live = with_key_bucket(pages.where(F.col("html").isNotNull())
                           .withColumn("digest", F.sha2(F.concat(F.lit(chosen), F.lit("\n"), F.col("html")), 256))).persist()
    try:
        known = stored_table(spark, store, STORED_DETAILS)
        new = live if known is None else live.join(known.select(*key), key, "left_anti")
        if not new.isEmpty():
            parsed = to_raw_details(extract_pages(new, selectors, keep=("digest",)), keep=("digest",))
            append_keyed(spark, with_key_bucket(parsed).select(*STORED_DETAILS.names), store, key, partition_by="key_bucket")
        known = stored_table(spark, store, STORED_DETAILS)
        if known is None:
            return spark.createDataFrame([], STORED_DETAILS).drop("key_bucket", "digest")
        return known.join(live.select("url", "digest"), ["url", "digest"], "left_semi").drop("key_bucket", "digest")
    finally:
        live.unpersist()


def linked_ads(headers: DataFrame) -> DataFrame:
    """(url, load_date, load_time) of the header rows that link to an ad page."""
    return headers.where(F.col("url") != config.NULL_TEXT).select("url", "load_date", "load_time")


def extracted_details(pages: DataFrame, selectors: Mapping[str, str] | None = None, store: str | None = None,
                      fetched: str | None = None, urls: DataFrame | None = None) -> DataFrame:
    """Details without the times of any header: one row per url of ``pages`` (among ``urls``), from its newest fetch."""
    newest = newest_pages(pages, urls, fetched)
    return to_raw_details(extract_pages(newest, selectors)) if store is None else stored_details(newest, selectors, store)


def extract_all(pages: DataFrame, path: str, selectors: Mapping[str, str] | None = None) -> DataFrame:
    """:func:`extracted_details` of all ``pages``, written to ``path``: for pages that stay as they are while many batches ask for them."""
    extracted_details(pages, selectors).write.mode("overwrite").parquet(path)
    return pages.sparkSession.read.schema(T.StructType([f for f in STORED_DETAILS.fields if f.name not in ("digest", "key_bucket")])).parquet(path)


def with_details(linked: DataFrame, details: DataFrame) -> DataFrame:
    """Raw details rows (RAW_DETAILS), one per row of ``linked`` (:func:`linked_ads`); a url without ``details`` is a deleted ad."""
    gone = {"properties": F.to_json(null_map()), "equipment": F.to_json(null_set()),
            "information": quote_json_string(F.lit(config.NULL_TEXT)), "deleted": F.lit(True)}
    return linked.join(details, "url", "left").select(
        "url", "load_date", "load_time", *[F.coalesce(F.col(c), v).alias(c) for c, v in gone.items()])


def details_from_listing(headers: DataFrame, pages: DataFrame,
                         selectors: Mapping[str, str] | None = None, fetched: str | None = None,
                         store: str | None = None) -> DataFrame:
    """Raw details rows (RAW_DETAILS) for header rows; details share the header's load time.

    A url absent from ``pages`` (or with null html) is a deleted ad page; a
    header without a link (the text sentinel) gives no row. Each distinct url
    is extracted once however many ads point at it; ``fetched`` names the
    column of ``pages`` that orders several fetches of one url; ``store`` the path of a table that keeps
    extractions between calls (:func:`stored_details`).
    """
    linked = linked_ads(headers)
    return with_details(linked, extracted_details(pages, selectors, store, fetched, linked.select("url").distinct()))
