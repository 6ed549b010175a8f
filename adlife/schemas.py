"""Explicit schemas of every table layer (no inference anywhere).

``load_date`` is ISO text (``yyyy-MM-dd``) and the partition column of the
raw and daily tables. Read those tables with these schemas: Spark would
otherwise infer DateType for the partition directories.
"""

from pyspark.sql import types as T

S, L, I, B, D = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw snapshot of a listing as seen in a search-result page; all text.
RAW_HEADER = _struct(
    ("url", S), ("load_date", S), ("load_time", L), ("title", S),
    ("location", S), ("year", S), ("km", S), ("price", S),
)

# Raw snapshot of the ad page; JSON kept as text.
RAW_DETAILS = _struct(
    ("url", S), ("load_date", S), ("load_time", L), ("properties", S),
    ("equipment", S), ("information", S), ("deleted", B),
)

# Typed, one row per (load_date, url).
DAILY = _struct(
    ("url", S), ("load_date", S), ("finnkode", I), ("title", S), ("location", S),
    ("year", I), ("km", I), ("price", I),
    ("properties", T.MapType(S, S)), ("equipment", T.ArrayType(S)),
    ("information", S), ("sold", B), ("deleted", B), ("load_time", L),
)

# Lifecycle roll-up, one row per url.
LIFECYCLE = _struct(
    ("url", S), ("finnkode", I), ("title", S), ("location", S), ("year", I), ("km", I),
    ("price_first", I), ("price_last", I), ("price_delta", I),
    ("sold", B), ("sold_date", S), ("lead_time_sold", I),
    ("deleted", B), ("deleted_date", S), ("lead_time_deleted", I),
    ("load_date_first", S), ("load_date_latest", S),
    ("automatgir", B), ("hengerfeste", B), ("skinninterior", S), ("drivstoff", S),
    ("sylindervolum", D), ("effekt", I), ("regnsensor", B), ("farge", S),
    ("cruisekontroll", B), ("parkeringsensor", B), ("antall_eiere", I),
    ("kommune", S), ("fylke", S), ("xenon", B), ("navigasjon", B),
    ("servicehefte", B), ("sportsseter", B), ("tilstandsrapport", B),
    ("vekt", I), ("last_updated", S),
)

_TEXT = T.ArrayType(_struct(("text", S)))

# One search-result page message: ads under extractorData.data[].group[].
LISTING_PAGE = _struct(
    ("extractorData", _struct(
        ("url", S), ("resourceId", S),
        ("data", T.ArrayType(_struct(("group", T.ArrayType(_struct(
            ("location", _TEXT),
            ("title", T.ArrayType(_struct(("text", S), ("href", S)))),
            ("year", _TEXT), ("km", _TEXT), ("price", _TEXT),
        )))))),
    )),
    ("pageData", _struct(("statusCode", I), ("timestamp", L))),
)

# Output of page extraction (one row per fetched url).
EXTRACTED_PAGE = _struct(
    ("url", S), ("properties", T.MapType(S, S)), ("equipment", T.ArrayType(S)),
    ("information", S), ("title", S), ("location", S), ("price", S),
    ("year", S), ("km", S), ("deleted", B), ("parse_error", S),
)


def extended(schema: T.StructType, *fields) -> T.StructType:
    """A copy of ``schema`` with extra ``(name, type)`` fields (never mutates)."""
    return T.StructType(list(schema.fields) + [T.StructField(n, t, True) for n, t in fields])
