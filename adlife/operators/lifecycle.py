"""Daily rows -> one lifecycle row per listing.

The original ran two look-ups per listing from a driver loop, after
collecting the delta's urls and broadcasting two driver-side maps. Here:

* the newest record of each url in the delta: one ``max_by`` over the delta's
  partitions only, the one place that reads the map, array and text columns;
* first record, first sold and first deleted date over the window: ``min_by``
  on six narrow columns, after a semi-join with the delta's urls, so listings
  that are not rolled up never move. Where closed months are kept as one row a url
  (:func:`month_partials`), only the days at the window's ends are read as days;
* a join of the two on url, and a projection that derives the attributes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlife import config
from adlife.config import DEFAULT_VOCABULARY, Vocabulary
from adlife.functions import attributes as A
from adlife.functions.dates import days_between, iso_shift, month_end

LAST_FIELDS = ("url", "finnkode", "title", "location", "year", "km", "price", "sold",
               "deleted", "load_date", "properties", "equipment", "information")


def event_dates(window: DataFrame, key: str = "url") -> DataFrame:
    """First sold and first deleted ``load_date`` per key, date sentinel when none."""
    t = F.col("load_time")
    return window.groupBy(key).agg(
        F.coalesce(F.min_by("load_date", F.when(F.col("sold"), t)),
                   F.lit(config.NULL_DATE)).alias("sold_date"),
        F.coalesce(F.min_by("load_date", F.when(F.col("deleted"), t)),
                   F.lit(config.NULL_DATE)).alias("deleted_date"),
    )


WINDOW_FIELDS = ("url", "load_date", "load_time", "price", "sold", "deleted")


def day_partials(daily: DataFrame) -> DataFrame:
    """Each daily row as the partial of its url and day (the columns of :func:`month_partials` without the month)."""
    t = F.col("load_time")
    return daily.select(
        "url", t.alias("first_time"), F.struct("price", "load_date").alias("first"),
        *[c for flag in ("sold", "deleted") for c in (
            F.when(F.col(flag), t).alias(f"{flag}_time"), F.when(F.col(flag), F.col("load_date")).alias(f"{flag}_date"))])


def _merged(partials: DataFrame, *keys: str) -> DataFrame:
    """The partials of the same ``keys`` as one."""
    return partials.groupBy(*keys).agg(
        F.min("first_time").alias("first_time"), F.min_by("first", "first_time").alias("first"),
        *[c for flag in ("sold", "deleted") for c in (
            F.min(f"{flag}_time").alias(f"{flag}_time"), F.min_by(f"{flag}_date", f"{flag}_time").alias(f"{flag}_date"))])


def month_partials(daily: DataFrame) -> DataFrame:
    """(month, url, first_time, first, sold_time, sold_date, deleted_time, deleted_date): what the roll-up needs of
    the rows of a url and month."""
    by_day = day_partials(daily).withColumn("month", F.substring("first.load_date", 1, 7))
    return _merged(by_day, "month", "url")


def day_ranges(lo: str, hi: str, months: Sequence[str]) -> list[tuple[str, str]]:
    """The date ranges of ``lo`` .. ``hi`` outside ``months``."""
    out, at = [], lo
    for m in sorted(months):
        if at < f"{m}-01":
            out.append((at, iso_shift(f"{m}-01", -1)))
        at = iso_shift(month_end(m), 1)
    return [*out, (at, hi)] if at <= hi else out


def rollup_inputs(daily: DataFrame, as_of: str, delta_start: str, lo: str, months: DataFrame | None = None,
                  closed: Sequence[str] = ()) -> DataFrame:
    """One row per url of the delta: ``__last``, ``__first``, ``__sold_date``, ``__deleted_date``.

    ``months`` holds the partials (:func:`month_partials`) of the months ``closed``; those that lie in the window
    whole are read from there, all other days from ``daily``.
    """
    t, day = F.col("load_time"), F.col("load_date")
    delta = daily.where(day.between(max(lo, delta_start), as_of))
    last = delta.groupBy("url").agg(F.max_by(F.struct(*LAST_FIELDS), t).alias("__last"))
    whole = [m for m in closed if lo <= f"{m}-01" and month_end(m) <= as_of] if months is not None else []
    days = F.lit(False)
    for a, b in day_ranges(lo, as_of, whole):
        days = days | day.between(a, b)
    window = day_partials(daily.where(days).select(*WINDOW_FIELDS))
    if whole:
        window = window.unionByName(months.where(F.col("month").isin(whole)).drop("month"))
    first = _merged(window.join(delta.select("url").distinct(), "url", "left_semi"), "url").select(
        "url", F.col("first").alias("__first"), F.col("sold_date").alias("__sold_date"),
        F.col("deleted_date").alias("__deleted_date"))
    return last.join(first, "url")


def attribute_columns(last: str = "__last", vocab: Vocabulary = DEFAULT_VOCABULARY,
                      legacy_weight: bool = True) -> dict[str, Column]:
    """The 20 derived attribute columns, from the last record's map / set / text."""
    props, equip = F.col(f"{last}.properties"), F.col(f"{last}.equipment")
    k = vocab.keys
    return {
        "automatgir": A.map_equals(props, k["gearbox"], config.VALUE_AUTOMATIC),
        "hengerfeste": A.has_any_label(equip, vocab.towbar),
        "skinninterior": A.interior_class(equip, vocab.leather, vocab.part_leather),
        "drivstoff": A.map_text(props, k["fuel"]),
        "sylindervolum": A.engine_volume(props, k["engine_volume"]),
        "effekt": A.power(props, k["power"]),
        "regnsensor": A.has_label(equip, vocab.rain_sensor),
        "farge": A.map_text(props, k["colour"]),
        "cruisekontroll": A.has_label(equip, vocab.cruise_control),
        "parkeringsensor": A.has_any_label(equip, vocab.parking_sensor),
        "antall_eiere": A.owners(props, k["owners"]),
        "kommune": A.municipality(F.col(f"{last}.location")),
        "fylke": A.county(F.col(f"{last}.location")),
        "xenon": A.has_label(equip, vocab.xenon),
        "navigasjon": A.has_label(equip, vocab.navigation),
        "servicehefte": A.contains_any(F.col(f"{last}.information"), vocab.service_book),
        "sportsseter": A.has_label(equip, vocab.sport_seats),
        "tilstandsrapport": A.map_has_key(props, k["condition_report"]),
        "vekt": A.weight(props, k["weight"], legacy=legacy_weight),
    }


def lifecycle_rollup(daily: DataFrame, as_of: str, delta_start: str, *,
                     window_days: int = config.LIFECYCLE_WINDOW_DAYS,
                     vocab: Vocabulary = DEFAULT_VOCABULARY,
                     legacy_weight: bool = True, months: DataFrame | None = None,
                     closed: Sequence[str] = ()) -> DataFrame:
    """Lifecycle rows (schema :data:`adlife.schemas.LIFECYCLE`) for urls seen in the delta.

    ``daily`` holds typed daily rows; the window is ``as_of - window_days`` ..
    ``as_of`` and the delta ``delta_start`` .. ``as_of`` (ISO dates, inclusive).
    First price / date and event dates come from the window, everything else
    from the newest delta row. ``months`` and ``closed``: see :func:`rollup_inputs`.
    """
    lo = iso_shift(as_of, -window_days)
    g = rollup_inputs(daily, as_of, delta_start, lo, months, closed)
    first_date = F.col("__first.load_date")
    sold_date = F.coalesce(F.col("__sold_date"), F.lit(config.NULL_DATE))
    deleted_date = F.coalesce(F.col("__deleted_date"), F.lit(config.NULL_DATE))
    attrs = attribute_columns(vocab=vocab, legacy_weight=legacy_weight)
    cols = {
        "url": F.col("url"),
        "finnkode": F.col("__last.finnkode"),
        "title": F.col("__last.title"),
        "location": F.col("__last.location"),
        "year": F.col("__last.year"),
        "km": F.col("__last.km"),
        "price_first": F.col("__first.price"),
        "price_last": F.col("__last.price"),
        "price_delta": (F.col("__last.price") - F.col("__first.price")).cast("int"),
        "sold": F.col("__last.sold"),
        "sold_date": sold_date,
        "lead_time_sold": days_between(first_date, sold_date),
        "deleted": F.col("__last.deleted"),
        "deleted_date": deleted_date,
        "lead_time_deleted": days_between(first_date, deleted_date),
        "load_date_first": first_date,
        "load_date_latest": F.col("__last.load_date"),
        **{name: attrs[name] for name in (
            "automatgir", "hengerfeste", "skinninterior", "drivstoff", "sylindervolum",
            "effekt", "regnsensor", "farge", "cruisekontroll", "parkeringsensor",
            "antall_eiere", "kommune", "fylke", "xenon", "navigasjon", "servicehefte",
            "sportsseter", "tilstandsrapport", "vekt")},
        "last_updated": F.lit(config.NULL_DATE),
    }
    return g.select(*[c.alias(n) for n, c in cols.items()])
