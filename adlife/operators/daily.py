"""Raw snapshots -> typed daily rows.

* :func:`with_last_known_price` — price of a row; for a row marked as sold the
  newest earlier unsold price of the same url over the whole header history
  (as-of lookup, history first cut to the urls that need it).
* :func:`build_daily` — newest header and newest details per (load_date, url),
  inner-joined, typed.
* :func:`merge_header_details` — every header row left-as-of-joined to the
  newest non-deleted details at or before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlife import config
from adlife.functions import jsontext, parse
from adlife.operators.asof import asof_lookup, timeline_segments
from adlife.operators.records import last_record, latest_per_key, order_columns

DETAIL_VALUES = ("properties", "equipment", "information", "deleted")


def _tiebreak(df: DataFrame) -> str | None:
    return "seq" if "seq" in df.columns else None


def with_last_known_price(rows: DataFrame, history: DataFrame, *, price_col: str = "price",
                          out_col: str = "price_value", marker: str = config.SOLD_MARKER,
                          until_date: str | None = None, older: DataFrame | None = None,
                          segments: DataFrame | None | bool = True) -> DataFrame:
    """Add ``out_col`` (int) to ``rows`` (columns url, load_time, ``price_col``).

    Unsold rows parse their own price. A sold row takes the newest header of
    the same url with ``load_time <=`` its own whose price is not the sold
    marker, and parses that; none found or unparsable -> -1. Ads without a link
    share the text sentinel as url; they have no history, so sold ones get -1. The newest unsold
    row is chosen before parsing, so an unparsable one is not skipped.

    ``older`` (columns url, load_time, price and the tiebreak if there is one)
    adds stored candidates: the newest unsold row per url of the partitions
    that ``history`` leaves out. No older row can beat it for a probe that is
    not older itself, so the result is exact while only recent partitions of
    the raw history are read (:func:`newest_unsold` makes such rows).

    ``segments``: of the timelines of hot urls, as :func:`asof_lookup` takes them; True finds them in the
    history (of which ``rows`` are a part), in one narrow scan.
    """
    if segments is True:
        segments = timeline_segments([(history, "load_time")], "url")
    sold = parse.is_sold(F.col(price_col), marker)
    unsold_rows = rows.where(~sold).withColumn(out_col, parse.parse_price(price_col))
    probes = rows.where(sold)
    candidates = history.where(~parse.is_sold(F.col("price"), marker) & (F.col("url") != config.NULL_TEXT))
    if until_date is not None:
        candidates = candidates.where(F.col("load_date") <= F.lit(until_date))
    tiebreak = _tiebreak(candidates)
    keep = ["url", "load_time", "price"] + ([tiebreak] if tiebreak else [])
    candidates = candidates.select(*keep)
    if older is not None:
        candidates = candidates.unionByName(older.select(*keep))
    candidates = candidates.join(probes.select("url").distinct(), "url", "left_semi")
    found = asof_lookup(probes, candidates, "url", "load_time", "load_time", {"__prev_price": "price"},
                        build_tiebreak=tiebreak, segments=segments)
    return unsold_rows.unionByName(found.withColumn(out_col, parse.parse_price("__prev_price")).drop("__prev_price"))


def newest_unsold(headers: DataFrame, marker: str = config.SOLD_MARKER) -> DataFrame:
    """(url, load_time, price[, seq]) of the newest unsold header of every url, map-side combined."""
    tiebreak = _tiebreak(headers)
    keep = ["url", "load_time", "price"] + ([tiebreak] if tiebreak else [])
    unsold = headers.where(~parse.is_sold(F.col("price"), marker) & F.col("url").isNotNull()
                           & (F.col("url") != config.NULL_TEXT)).select(*keep)
    return last_record(unsold, "url", order=["load_time"] + ([tiebreak] if tiebreak else [])).select(*keep)


def typed_columns(price: str = "price_value", marker: str = config.SOLD_MARKER,
                  unquote_information: bool = True):
    """The 14 typed columns of a daily row, from joined header + details text."""
    info = jsontext.json_string("information") if unquote_information else F.col("information")
    return [
        F.col("url"), F.col("load_date"),
        parse.parse_code("url").alias("finnkode"),
        F.col("title"), F.col("location"),
        parse.parse_year("year").alias("year"),
        parse.parse_km("km").alias("km"),
        F.col(price).alias("price"),
        jsontext.json_map("properties").alias("properties"),
        jsontext.json_set("equipment").alias("equipment"),
        info.alias("information"),
        parse.is_sold("price", marker).alias("sold"),
        F.coalesce(F.col("deleted"), F.lit(False)).alias("deleted"),
        F.col("load_time"),
    ]


def latest_header_details(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Newest header and newest details per (load_date, url), inner-joined."""
    h = latest_per_key(headers, ("load_date", "url"), order_columns(headers))
    return _with_latest_details(h, details)


def _with_latest_details(latest_headers: DataFrame, details: DataFrame) -> DataFrame:
    d = latest_per_key(details.select("load_date", "url", "load_time", *DETAIL_VALUES,
                                      *(["seq"] if "seq" in details.columns else [])),
                       ("load_date", "url"), order_columns(details))
    return latest_headers.join(d.select("load_date", "url", *DETAIL_VALUES), ["load_date", "url"])


def build_daily(headers: DataFrame, details: DataFrame, history: DataFrame | None = None, *,
                marker: str = config.SOLD_MARKER, until_date: str | None = None,
                older: DataFrame | None = None) -> DataFrame:
    """Typed daily rows (schema :data:`adlife.schemas.DAILY`) for the given raw slices.

    ``history`` is the raw header table used for sold-price look-back (default:
    ``headers``), ``older`` the stored newest unsold rows of what it leaves out.
    Only the header that is kept of each day is priced: one a url and day, so a url is hot by its history alone.
    """
    latest = latest_per_key(headers, ("load_date", "url"), order_columns(headers))
    priced = with_last_known_price(latest, history if history is not None else headers, marker=marker,
                                   until_date=until_date, older=older)
    return _with_latest_details(priced, details).select(*typed_columns(marker=marker))


def merge_header_details(headers: DataFrame, details: DataFrame, history: DataFrame | None = None,
                         *, marker: str = config.SOLD_MARKER, keep: tuple = ()) -> DataFrame:
    """Each header row with the newest non-deleted details at or before it.

    Headers without such details get the sentinel map / set / text and
    ``deleted = true``. ``information`` is copied as stored (not un-quoted).
    ``keep`` names extra header columns to pass through.
    """
    live = details.where(~F.coalesce(F.col("deleted"), F.lit(False)))
    # prices first, on narrow raw headers: the details look-up is then not an input of another look-up
    history = history if history is not None else headers
    # hot urls are found once, for both look-ups
    segments = timeline_segments([(history, "load_time"), (live, "load_time")], "url")
    priced = with_last_known_price(headers, history, marker=marker, segments=segments)
    merged = asof_lookup(priced, live, "url", "load_time", "load_time",
                         {"properties": "properties", "equipment": "equipment",
                          "information": "information"},
                         build_tiebreak=_tiebreak(live), matched_col="__found", segments=segments)
    found = F.col("__found")
    return merged.select(
        "url", "load_date", parse.parse_code("url").alias("finnkode"), "title", "location",
        parse.parse_year("year").alias("year"), parse.parse_km("km").alias("km"),
        F.col("price_value").alias("price"),
        F.when(found, jsontext.json_map("properties")).otherwise(jsontext.null_map()).alias("properties"),
        F.when(found, jsontext.json_set("equipment")).otherwise(jsontext.null_set()).alias("equipment"),
        F.when(found, F.col("information")).otherwise(F.lit(config.NULL_TEXT)).alias("information"),
        parse.is_sold("price", marker).alias("sold"),
        (~found).alias("deleted"),
        "load_time", *keep,
    )
