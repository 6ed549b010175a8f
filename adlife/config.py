"""Constants shared by every layer.

The block marked FIXED VALUES holds the sentinels, labels, phrases and
selectors whose exact text decides whether a result equals the one the
original application produces; change them only to model a different site.
Everything else in the library takes them as default arguments, so callers
can pass their own vocabulary without touching this module.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the original application's)
# ---------------------------------------------------------------------------

# Missing-value sentinels: text, int, date, map and set.
NULL_TEXT = "NULL"
NULL_INT = -1
NULL_DATE = "1900-01-01"
NULL_MAP = {"NULL": "NULL"}
NULL_SET = ("NULL",)

# Incremental-load settings.
SAFETY_MARGIN_DAYS = 7
FIRST_LOAD_DATE = "2016-07-01"
LIFECYCLE_WINDOW_DAYS = 365

# Price text of a listing that is marked as sold.
SOLD_MARKER = "Solgt"

# Placeholders written by page extraction when an element is absent.
MISSING_VALUE = "MissingValue"
MISSING_VALUES = "MissingValues"
MISSING_KEYS = "MissingKeys"

# Default exclusion lists of the JSON map / array readers.
DEFAULT_EXCLUDED = ("None",)

# Property keys read from the details map.
KEY_GEARBOX = "Girkasse"
VALUE_AUTOMATIC = "Automat"
KEY_FUEL = "Drivstoff"
KEY_ENGINE_VOLUME = "Sylindervolum"
KEY_POWER = "Effekt"
KEY_COLOUR = "Farge"
KEY_OWNERS = "Antall eiere"
KEY_CONDITION_REPORT = "Tilstandsrapport"
KEY_WEIGHT = "Vekt"

# Equipment labels.
TOWBAR_LABELS = ("Hengerfeste", "Tilhengarfeste", "Tilhengerfeste")
LEATHER_LABELS = ("Skinninteriør", "Skinnseter")
PART_LEATHER_LABEL = "Delskinn"
INTERIOR_LEATHER = "Skinnseter"
INTERIOR_PART_LEATHER = "Delskinn"
INTERIOR_CLOTH = "Tøyseter"
RAIN_SENSOR_LABEL = "Regnsensor"
CRUISE_CONTROL_LABEL = "Cruisekontroll"
PARKING_SENSOR_LABELS = ("Parkeringsensor", "Parkeringsensor bak", "Parkeringsensor foran")
XENON_LABEL = "Xenon"
NAVIGATION_LABEL = "Navigasjonssystem"
SPORT_SEATS_LABEL = "Sportsseter"

# Phrases that reveal a service book in the free text (case as written).
SERVICE_BOOK_PHRASES = ("servicehefte", "Servicehefte", "service hefte")

# CSS selectors of the ad page.
DETAIL_SELECTORS = {
    "properties": ".mvn+ .col-count2from990",
    "equipment": ".col-count2upto990",
    "information": ".object-description p[data-automation-id]",
    "price": ".mtn.r-margin",
    "title": ".tcon",
    "location": ".hide-lt768 h2",
    "year": "hr+ .col-count2from990 dd:nth-child(2) , .mvn+ .col-count2from990 dt:nth-child(2)",
    "km": ".mvn+ .col-count2from990 dd:nth-child(6)",
}

# ---------------------------------------------------------------------------
# Tunables (not fixed by the original application)
# ---------------------------------------------------------------------------

DAY_MS = 86_400_000


@dataclass(frozen=True)
class Vocabulary:
    """Labels, keys and phrases the attribute roll-up looks for."""

    towbar: tuple = TOWBAR_LABELS
    leather: tuple = LEATHER_LABELS
    part_leather: str = PART_LEATHER_LABEL
    rain_sensor: str = RAIN_SENSOR_LABEL
    cruise_control: str = CRUISE_CONTROL_LABEL
    parking_sensor: tuple = PARKING_SENSOR_LABELS
    xenon: str = XENON_LABEL
    navigation: str = NAVIGATION_LABEL
    sport_seats: str = SPORT_SEATS_LABEL
    service_book: tuple = SERVICE_BOOK_PHRASES
    keys: dict = field(default_factory=lambda: {
        "gearbox": KEY_GEARBOX,
        "fuel": KEY_FUEL,
        "engine_volume": KEY_ENGINE_VOLUME,
        "power": KEY_POWER,
        "colour": KEY_COLOUR,
        "owners": KEY_OWNERS,
        "condition_report": KEY_CONDITION_REPORT,
        "weight": KEY_WEIGHT,
    })


DEFAULT_VOCABULARY = Vocabulary()
