"""DuckDB SQL that recomputes the registered queries from the source numbers.

These strings are the correctness oracle: they never see the formatted text
the Spark side parses, only the numbers it was formatted from (see
:mod:`adlife.plans.testbed`).
"""

from __future__ import annotations

from adlife.functions.dates import iso_shift

# Events as listing snapshots.
EV = """
ev AS (
  SELECT event_id, user_id, event_type, value,
         'https://ads.example/item?code=' || CAST(10000000 + user_id AS VARCHAR) AS url,
         strftime(ts, '%Y-%m-%d') AS load_date,
         epoch_us(ts) // 1000 AS load_time,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(day(ts) AS INTEGER) AS dom,
         CAST(round(value * 100) AS INTEGER) AS cents
  FROM events),
hdr AS (SELECT * FROM ev WHERE event_type IN ('view', 'purchase', 'signup')),
det AS (SELECT * FROM ev WHERE event_type IN ('click', 'error')),
prev AS (
  SELECT pid, price FROM (
    SELECT p.event_id AS pid,
           CASE WHEN c.event_type = 'view' THEN c.cents ELSE -1 END AS price,
           row_number() OVER (PARTITION BY p.event_id ORDER BY c.load_time DESC, c.event_id DESC) AS rn
    FROM hdr p JOIN hdr c
      ON c.user_id = p.user_id AND c.event_type <> 'purchase' AND c.load_time <= p.load_time
    WHERE p.event_type = 'purchase') t WHERE rn = 1),
hdr_priced AS (
  SELECT h.*, CAST(CASE h.event_type WHEN 'view' THEN h.cents WHEN 'signup' THEN -1
                    ELSE coalesce(pv.price, -1) END AS INTEGER) AS price
  FROM hdr h LEFT JOIN prev pv ON pv.pid = h.event_id),
h_last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url, load_date
                                              ORDER BY load_time DESC, event_id DESC) AS rn
                 FROM hdr_priced) t WHERE rn = 1),
d_last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url, load_date
                                              ORDER BY load_time DESC, event_id DESC) AS rn
                 FROM det) t WHERE rn = 1)"""

# Text renderings of a details event (alias d) as the library stores them.
PROPERTY_KEYS = """CASE WHEN {d}.event_type = 'error' THEN 'NULL' ELSE concat_ws('|',
    CASE WHEN {d}.value >= 20 THEN 'Antall eiere' END, 'Drivstoff', 'Effekt',
    CASE WHEN NOT ({d}.k BETWEEN 40 AND 44) THEN 'Farge' END, 'Girkasse', 'Salgsform', 'Sylindervolum',
    CASE WHEN {d}.value >= 400 THEN 'Tilstandsrapport' END, CASE WHEN {d}.k >= 10 THEN 'Vekt' END) END"""

EQUIPMENT = """CASE WHEN {d}.event_type = 'error' THEN 'NULL' ELSE concat_ws('|', 'Aluminiumsfelger',
    CASE WHEN {d}.k < 30 THEN 'Cruisekontroll' END,
    CASE WHEN {d}.value >= 150 AND {d}.value < 280 THEN 'Delskinn' END,
    CASE WHEN {d}.k >= 80 THEN 'Hengerfeste' END,
    CASE WHEN {d}.value < 100 THEN 'Navigasjonssystem' END,
    CASE WHEN {d}.value >= 200 AND {d}.value < 220 THEN 'Parkeringsensor' END,
    CASE WHEN {d}.value >= 100 AND {d}.value < 200 THEN 'Parkeringsensor bak' END,
    CASE WHEN {d}.dom >= 15 THEN 'Regnsensor' END,
    CASE WHEN {d}.value >= 280 AND {d}.value < 300 THEN 'Skinninteriør' END,
    CASE WHEN {d}.value >= 300 THEN 'Skinnseter' END,
    CASE WHEN {d}.k BETWEEN 60 AND 70 THEN 'Sportsseter' END,
    CASE WHEN {d}.k BETWEEN 40 AND 45 THEN 'Tilhengerfeste' END,
    CASE WHEN {d}.k BETWEEN 30 AND 35 THEN 'Xenon' END,
    CASE WHEN {d}.k BETWEEN 36 AND 39 THEN 'Xenonlys' END) END"""

INFO_TEXT = """('Bil ' || CAST({d}.user_id AS VARCHAR) ||
    CASE WHEN {d}.k >= 90 THEN ' med servicehefte'
         WHEN {d}.k BETWEEN 20 AND 22 THEN '. service hefte finnes'
         WHEN {d}.k BETWEEN 23 AND 25 THEN '. SERVICEHEFTE'
         WHEN {d}.k BETWEEN 26 AND 27 THEN '. Servicehefte ok' ELSE '' END ||
    CASE WHEN {d}.value < 10 THEN ' og 17" felger' ELSE '' END)"""


def fmt(template: str, alias: str) -> str:
    return template.format(d=alias)


DAILY = EV + """,
daily AS (
  SELECT h.url, h.load_date, CAST(10000000 + h.user_id AS INTEGER) AS finnkode,
         'Listing ' || CAST(h.user_id AS VARCHAR) AS title,
         'Area ' || CAST(h.k AS VARCHAR) AS location,
         CAST(CASE WHEN h.event_type = 'signup' THEN -1 ELSE 1990 + h.dom END AS INTEGER) AS year,
         h.cents AS km, h.price,
         """ + fmt(PROPERTY_KEYS, "d") + """ AS property_keys,
         """ + fmt(EQUIPMENT, "d") + """ AS equipment,
         CASE WHEN d.event_type = 'error' THEN 'NULL' ELSE """ + fmt(INFO_TEXT, "d") + """ END AS information,
         h.event_type = 'purchase' AS sold, d.event_type = 'error' AS deleted, h.load_time,
         h.event_id AS header_seq, d.event_id AS details_seq,
         d.k AS dk, d.value AS dv, d.dom AS ddom
  FROM h_last h JOIN d_last d ON d.url = h.url AND d.load_date = h.load_date)"""


def lifecycle_select(as_of: str, delta_start: str, window_days: int = 365, daily: str = "daily") -> str:
    """SELECT producing lifecycle rows from the ``daily`` CTE."""
    lo = iso_shift(as_of, -window_days)
    return f"""
SELECT l.url, l.finnkode, l.title, l.location, l.year, l.km,
       c.price_first, l.price AS price_last, CAST(l.price - c.price_first AS INTEGER) AS price_delta,
       l.sold, coalesce(c.sold_date0, '1900-01-01') AS sold_date,
       CAST(CASE WHEN c.sold_date0 IS NULL THEN -1
            ELSE date_diff('day', CAST(c.load_date_first AS DATE), CAST(c.sold_date0 AS DATE)) END AS INTEGER) AS lead_time_sold,
       l.deleted, coalesce(c.deleted_date0, '1900-01-01') AS deleted_date,
       CAST(CASE WHEN c.deleted_date0 IS NULL THEN -1
            ELSE date_diff('day', CAST(c.load_date_first AS DATE), CAST(c.deleted_date0 AS DATE)) END AS INTEGER) AS lead_time_deleted,
       c.load_date_first, l.load_date AS load_date_latest,
       (NOT l.deleted AND l.dk >= 50) AS automatgir,
       (NOT l.deleted AND (l.dk >= 80 OR l.dk BETWEEN 40 AND 45)) AS hengerfeste,
       CASE WHEN l.deleted THEN 'Tøyseter' WHEN l.dv >= 280 THEN 'Skinnseter'
            WHEN l.dv >= 150 THEN 'Delskinn' ELSE 'Tøyseter' END AS skinninterior,
       CASE WHEN l.deleted THEN NULL WHEN l.dv >= 250 THEN 'Diesel' ELSE 'Bensin' END AS drivstoff,
       CASE WHEN l.deleted THEN -1.0 ELSE CAST(l.dk AS DOUBLE) / 10.0 END AS sylindervolum,
       CAST(CASE WHEN l.deleted THEN -1 ELSE l.dk END AS INTEGER) AS effekt,
       (NOT l.deleted AND l.ddom >= 15) AS regnsensor,
       CASE WHEN l.deleted THEN NULL WHEN l.dk < 40 THEN 'Blå' WHEN l.dk <= 44 THEN NULL
            WHEN l.dk < 66 THEN 'Sølv' ELSE 'Svart' END AS farge,
       (NOT l.deleted AND l.dk < 30) AS cruisekontroll,
       (NOT l.deleted AND l.dv >= 100 AND l.dv < 220) AS parkeringsensor,
       CAST(CASE WHEN l.deleted OR l.dv < 20 THEN -1 ELSE 1 + floor(l.dv / 100) END AS INTEGER) AS antall_eiere,
       'NULL' AS kommune, 'NULL' AS fylke,
       (NOT l.deleted AND l.dk BETWEEN 30 AND 35) AS xenon,
       (NOT l.deleted AND l.dv < 100) AS navigasjon,
       (NOT l.deleted AND (l.dk >= 90 OR l.dk BETWEEN 20 AND 22 OR l.dk BETWEEN 26 AND 27)) AS servicehefte,
       (NOT l.deleted AND l.dk BETWEEN 60 AND 70) AS sportsseter,
       (NOT l.deleted AND l.dv >= 400) AS tilstandsrapport,
       CAST(CASE WHEN l.deleted OR l.dk < 10 THEN 1 ELSE 1000 + l.dk END AS INTEGER) AS vekt,
       '1900-01-01' AS last_updated
FROM (
  SELECT url, arg_min(price, load_time) AS price_first, min(load_date) AS load_date_first,
         min(load_date) FILTER (WHERE sold) AS sold_date0,
         min(load_date) FILTER (WHERE deleted) AS deleted_date0,
         max(load_time) FILTER (WHERE load_date >= '{delta_start}') AS last_time
  FROM {daily} WHERE load_date BETWEEN '{lo}' AND '{as_of}'
  GROUP BY url HAVING count(*) FILTER (WHERE load_date >= '{delta_start}') > 0) c
JOIN {daily} l ON l.url = c.url AND l.load_time = c.last_time"""
