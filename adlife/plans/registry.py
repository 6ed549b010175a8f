"""Registered queries (one per operator group of the survey) and their oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables at ``sf_dir`` (or data Spark derives from them). Map and set
columns are rendered as sorted ``|``-joined text so DuckDB can compare them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlife import config
from adlife.functions import attributes as A
from adlife.functions import dates, jsontext, parse
from adlife.operators import daily as daily_ops
from adlife.operators import lifecycle as lc
from adlife.operators import records
from adlife.plans import oracle as O
from adlife.plans import testbed as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the test history (events span 2024-01-01 .. 2024-01-30).
AS_OF = "2024-01-30"
DELTA_START = "2024-01-28"


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def render_keys(m) -> Column:
    return F.array_join(F.array_sort(F.map_keys(m)), "|")


def render_set(a) -> Column:
    return F.array_join(F.array_sort(a), "|")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, details = tb.stored_raw(spark, sf_dir)
    return daily_ops.build_daily(headers, details)


def _daily_out(df: DataFrame) -> DataFrame:
    return df.select("url", "load_date", "finnkode", "title", "location", "year", "km", "price",
                     render_keys("properties").alias("property_keys"),
                     render_set("equipment").alias("equipment"),
                     "information", "sold", "deleted", "load_time")


# ---------------------------------------------------------------------------
# Aggregations: latest / first / last record per key
# ---------------------------------------------------------------------------

@register("latest_per_day", "WITH " + O.EV + """
SELECT 'header' AS layer, load_date, url, load_time, event_id AS seq FROM h_last
UNION ALL
SELECT 'details' AS layer, load_date, url, load_time, event_id AS seq FROM d_last""")
def latest_per_day(spark, sf_dir):
    headers, details = tb.stored_raw(spark, sf_dir)
    h = records.latest_per_key(headers, ("load_date", "url"))
    d = records.latest_per_key(details, ("load_date", "url"))
    cols = ["load_date", "url", "load_time", "seq"]
    return (h.select(F.lit("header").alias("layer"), *cols)
             .unionByName(d.select(F.lit("details").alias("layer"), *cols)))


@register("first_record", "WITH " + O.EV + """
SELECT url, arg_min(load_date, (load_time, event_id)) AS load_date,
       min(load_time) AS load_time, arg_min(event_id, (load_time, event_id)) AS seq
FROM hdr GROUP BY url""")
def first_record(spark, sf_dir):
    headers, _ = tb.stored_raw(spark, sf_dir)
    return records.first_record(headers, "url").select("url", "load_date", "load_time", "seq")


@register("last_record", "WITH " + O.EV + """
SELECT url, arg_max(load_date, (load_time, event_id)) AS load_date,
       max(load_time) AS load_time, arg_max(event_id, (load_time, event_id)) AS seq
FROM hdr GROUP BY url""")
def last_record(spark, sf_dir):
    headers, _ = tb.stored_raw(spark, sf_dir)
    return records.last_record(headers, "url").select("url", "load_date", "load_time", "seq")


@register("first_matching_record", "WITH " + O.EV + """
SELECT url, arg_min(load_date, (load_time, event_id)) AS load_date,
       min(load_time) AS load_time, arg_min(event_id, (load_time, event_id)) AS seq
FROM hdr WHERE event_type = 'purchase' GROUP BY url""")
def first_matching_record(spark, sf_dir):
    headers, _ = tb.stored_raw(spark, sf_dir)
    sold = parse.is_sold("price")
    return records.first_record(headers, "url", where=sold).select("url", "load_date", "load_time", "seq")


# ---------------------------------------------------------------------------
# Joins: header x details, as-of look-ups
# ---------------------------------------------------------------------------

@register("header_details_join", "WITH " + O.EV + """
SELECT h.load_date, h.url, h.load_time, h.event_id AS header_seq, d.event_id AS details_seq,
       d.event_type = 'error' AS deleted
FROM h_last h JOIN d_last d ON d.url = h.url AND d.load_date = h.load_date""")
def header_details_join(spark, sf_dir):
    headers, details = tb.stored_raw(spark, sf_dir)
    h = records.latest_per_key(headers, ("load_date", "url")).withColumnRenamed("seq", "header_seq")
    d = (records.latest_per_key(details, ("load_date", "url"))
                .select("load_date", "url", F.col("seq").alias("details_seq"), "deleted"))
    return h.join(d, ["load_date", "url"]).select("load_date", "url", "load_time", "header_seq",
                                                  "details_seq", "deleted")


@register("last_known_price", "WITH " + O.EV + """
SELECT event_id AS seq, url, load_time, price FROM hdr_priced""")
def last_known_price(spark, sf_dir):
    headers, _ = tb.stored_raw(spark, sf_dir)
    priced = daily_ops.with_last_known_price(headers, headers)
    return priced.select("seq", "url", "load_time", F.col("price_value").alias("price"))


@register("asof_details", "WITH " + O.EV + """,
m AS (
  SELECT * FROM (
    SELECT h.event_id AS hid, d.event_id AS did,
           row_number() OVER (PARTITION BY h.event_id ORDER BY d.load_time DESC, d.event_id DESC) AS rn
    FROM hdr h JOIN det d ON d.user_id = h.user_id AND d.event_type = 'click' AND d.load_time <= h.load_time
  ) t WHERE rn = 1)
SELECT h.event_id AS seq, h.url, h.load_date, CAST(10000000 + h.user_id AS INTEGER) AS finnkode,
       CAST(CASE WHEN h.event_type = 'signup' THEN -1 ELSE 1990 + h.dom END AS INTEGER) AS year,
       h.cents AS km, h.price,
       CASE WHEN d.event_id IS NULL THEN 'NULL' ELSE """ + O.fmt(O.PROPERTY_KEYS, "d") + """ END AS property_keys,
       CASE WHEN d.event_id IS NULL THEN 'NULL' ELSE """ + O.fmt(O.EQUIPMENT, "d") + """ END AS equipment,
       CASE WHEN d.event_id IS NULL THEN 'NULL'
            ELSE '"' || replace(""" + O.fmt(O.INFO_TEXT, "d") + """, '"', '\\"') || '"' END AS information,
       h.event_type = 'purchase' AS sold, d.event_id IS NULL AS deleted, h.load_time
FROM hdr_priced h LEFT JOIN m ON m.hid = h.event_id LEFT JOIN det d ON d.event_id = m.did""")
def asof_details(spark, sf_dir):
    headers, details = tb.stored_raw(spark, sf_dir)
    merged = daily_ops.merge_header_details(headers, details, keep=("seq",))
    return merged.select("seq", "url", "load_date", "finnkode", "year", "km", "price",
                         render_keys("properties").alias("property_keys"),
                         render_set("equipment").alias("equipment"),
                         "information", "sold", "deleted", "load_time")


# ---------------------------------------------------------------------------
# Daily build and lifecycle roll-up
# ---------------------------------------------------------------------------

@register("build_daily", "WITH " + O.DAILY + """
SELECT url, load_date, finnkode, title, location, year, km, price, property_keys, equipment,
       information, sold, deleted, load_time FROM daily""")
def build_daily(spark, sf_dir):
    return _daily_out(_daily(spark, sf_dir))


@register("lifecycle_rollup", "WITH " + O.DAILY + O.lifecycle_select(AS_OF, DELTA_START))
def lifecycle_rollup(spark, sf_dir):
    return lc.lifecycle_rollup(_daily(spark, sf_dir), AS_OF, DELTA_START)


@register("event_dates", "WITH " + O.DAILY + """
SELECT url, coalesce(min(load_date) FILTER (WHERE sold), '1900-01-01') AS sold_date,
       coalesce(min(load_date) FILTER (WHERE deleted), '1900-01-01') AS deleted_date
FROM daily WHERE load_date BETWEEN '2023-01-30' AND '2024-01-30' GROUP BY url""")
def event_dates(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    window = daily.where(F.col("load_date").between(dates.iso_shift(AS_OF, -365), AS_OF))
    return lc.event_dates(window)


@register("lead_time", "WITH " + O.DAILY + """
SELECT url, min(load_date) AS load_date_first,
       coalesce(min(load_date) FILTER (WHERE sold), '1900-01-01') AS sold_date,
       CAST(CASE WHEN min(load_date) FILTER (WHERE sold) IS NULL THEN -1
            ELSE date_diff('day', CAST(min(load_date) AS DATE),
                          CAST(min(load_date) FILTER (WHERE sold) AS DATE)) END AS INTEGER) AS lead_time_sold
FROM daily GROUP BY url""")
def lead_time(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    first = records.first_record(daily.select("url", "load_date", "load_time"), "url")
    sold = lc.event_dates(daily).select("url", "sold_date")
    return (first.join(sold, "url")
                 .select("url", F.col("load_date").alias("load_date_first"), "sold_date",
                         dates.days_between(F.col("load_date"), F.col("sold_date")).alias("lead_time_sold")))


@register("delta_semi_join", "WITH " + O.DAILY + f"""
SELECT url, load_date, price FROM daily
WHERE url IN (SELECT DISTINCT url FROM daily WHERE load_date >= '{DELTA_START}')""")
def delta_semi_join(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    delta_urls = records.distinct_keys(daily.where(F.col("load_date") >= DELTA_START))
    return records.semi_join_keys(daily, delta_urls).select("url", "load_date", "price")


# ---------------------------------------------------------------------------
# Scalar functions on the header text
# ---------------------------------------------------------------------------

@register("sold_flag", "WITH " + O.EV + """
SELECT event_id AS seq, event_type = 'purchase' AS sold FROM hdr""")
def sold_flag(spark, sf_dir):
    headers, _ = tb.stored_raw(spark, sf_dir)
    return headers.select("seq", parse.is_sold("price").alias("sold"))


@register("epoch_to_load_date", "WITH " + O.EV + """
SELECT e.event_id AS seq, strftime(x.ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS local_date
FROM hdr e JOIN events x ON x.event_id = e.event_id""")
def epoch_to_load_date(spark, sf_dir):
    headers, _ = tb.stored_raw(spark, sf_dir)
    return headers.select("seq", dates.epoch_ms_to_local_date("load_time", "Europe/Oslo").alias("local_date"))


# ---------------------------------------------------------------------------
# Sources: partition-pruned scans, probes, samples
# ---------------------------------------------------------------------------

from adlife.session import table_path  # noqa: E402
from adlife.sinks import tables as sinks  # noqa: E402
from adlife.sources import files as file_sources  # noqa: E402
from adlife.sources import tables as sources  # noqa: E402

SLICE_DATES = ("2024-01-05", "2024-01-06", "2024-01-07")
_SLICE_SQL = ", ".join(f"'{d}'" for d in SLICE_DATES)


def _raw_tables(spark, sf_dir):
    h = sources.read_raw_headers(spark, tb.raw_header_table(spark, sf_dir), with_seq=True)
    d = sources.read_raw_details(spark, tb.raw_details_table(spark, sf_dir), with_seq=True)
    return h, d


@register("scan_header_dates", "WITH " + O.EV + f"""
SELECT 'header' AS layer, url, load_date, load_time, event_id AS seq FROM hdr WHERE load_date IN ({_SLICE_SQL})
UNION ALL
SELECT 'details' AS layer, url, load_date, load_time, event_id AS seq FROM det WHERE load_date IN ({_SLICE_SQL})""")
def scan_header_dates(spark, sf_dir):
    h, d = _raw_tables(spark, sf_dir)
    cols = ["url", "load_date", "load_time", "seq"]
    return (sources.scan_dates(h, SLICE_DATES).select(F.lit("header").alias("layer"), *cols)
            .unionByName(sources.scan_dates(d, SLICE_DATES).select(F.lit("details").alias("layer"), *cols)))


@register("union_slices", "WITH " + O.EV + "\n" + "\nUNION ALL\n".join(
    f"SELECT url, load_date, load_time, event_id AS seq FROM hdr WHERE load_date = '{d}'" for d in SLICE_DATES))
def union_slices(spark, sf_dir):
    h, _ = _raw_tables(spark, sf_dir)
    return sources.union_slices(h, SLICE_DATES).select("url", "load_date", "load_time", "seq")


@register("scan_daily_range", "WITH " + O.DAILY + """
SELECT url, load_date, finnkode, title, location, year, km, price, property_keys, equipment,
       information, sold, deleted, load_time FROM daily
WHERE load_date BETWEEN '2024-01-10' AND '2024-01-20'""")
def scan_daily_range(spark, sf_dir):
    daily = sources.read_daily(spark, tb.daily_table(spark, sf_dir))
    lo, hi = sources.window_bounds("2024-01-20", 10)
    return _daily_out(sources.scan_date_range(daily, lo, hi))


@register("latest_load_date", "WITH " + O.EV + """
SELECT '2024-02-03' AS as_of,
       coalesce(max(load_date) FILTER (WHERE load_date BETWEEN '2024-01-27' AND '2024-02-03'), '2016-07-01') AS latest_load_date
FROM hdr
UNION ALL
SELECT '2024-03-01' AS as_of,
       coalesce(max(load_date) FILTER (WHERE load_date BETWEEN '2024-02-23' AND '2024-03-01'), '2016-07-01') AS latest_load_date
FROM hdr""")
def latest_load_date(spark, sf_dir):
    h, _ = _raw_tables(spark, sf_dir)
    return reduce_union([sources.latest_load_date(h, d).select(F.lit(d).alias("as_of"), "latest_load_date")
                         for d in ("2024-02-03", "2024-03-01")])


def reduce_union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("delta_dates", "WITH " + O.EV + """
SELECT strftime(d, '%Y-%m-%d') AS load_date
FROM (SELECT coalesce(max(load_date) FILTER (WHERE load_date BETWEEN '2024-01-26' AND '2024-02-02'),
                      '2016-07-01') AS lo FROM hdr) p,
     generate_series(CAST(p.lo AS DATE), DATE '2024-02-02', INTERVAL 1 DAY) AS g(d)""")
def delta_dates(spark, sf_dir):
    h, _ = _raw_tables(spark, sf_dir)
    return sources.delta_dates(h, "2024-02-02")


@register("table_sample", "WITH " + O.EV + """
SELECT url, load_date, load_time, event_id AS seq FROM hdr ORDER BY load_time, event_id LIMIT 1""")
def table_sample(spark, sf_dir):
    h, _ = _raw_tables(spark, sf_dir)
    return sources.sample(h, ["load_time", "seq"], 1, ["url", "load_date", "load_time", "seq"])


@register("ordered_history", "WITH " + O.EV + """
SELECT url, load_date, load_time, event_id AS seq, true AS in_order FROM hdr""")
def ordered_history(spark, sf_dir):
    """Every row with whether it stands behind its predecessor in the file: url, then newest first.

    The table is written by two appends; the days that both wrote are merged into one sorted run.
    """
    from pyspark.sql import Window
    h, _ = _raw_tables(spark, sf_dir)
    path = table_path(spark, "runs", "ordered_history", tb.uuid_tag())
    for part in (F.col("seq") % 3 == 0, F.col("seq") % 3 != 0):
        sinks.append_keyed(spark, h.where(part), path, [*stream_ops.RAW_KEY, "seq"], order=stream_ops.RAW_ORDER)
    sinks.merge_runs(spark, path, h.schema, stream_ops.RAW_ORDER, min_runs=2)
    back = sources.read_raw_headers(spark, path, with_seq=True).select(
        "url", "load_date", "load_time", "seq", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"))
    place, order = Window.partitionBy("file").orderBy("row"), F.struct("url", -F.col("load_time"))
    return back.withColumn("in_order", F.coalesce(F.lag(order).over(place) <= order, F.lit(True))).drop("file", "row")


@register("ingest_counts", "WITH " + O.EV + """
SELECT load_date, count(*) FILTER (WHERE event_type IN ('view', 'purchase', 'signup')) AS n_headers,
       count(*) FILTER (WHERE event_type IN ('click', 'error')) AS n_details
FROM ev GROUP BY load_date""")
def ingest_counts(spark, sf_dir):
    """Counts published with the appends; the stored tables are not read again."""
    paths = []
    for name, rows in zip(("headers", "details"), _raw_tables(spark, sf_dir)):
        paths.append(table_path(spark, "runs", "ingest_counts", tb.uuid_tag(), name))
        sinks.append_keyed(spark, rows, paths[-1], [*stream_ops.RAW_KEY, "seq"], order=stream_ops.RAW_ORDER)
    return stream_ops.ingest_counts(spark, *paths)


@register("temp_view_sql", "WITH " + O.EV + """
SELECT url, load_date, load_time, event_id AS seq FROM hdr WHERE event_type = 'purchase'""")
def temp_view_sql(spark, sf_dir):
    h, _ = _raw_tables(spark, sf_dir)
    sinks.register_view(h, "acq_car_header")
    return spark.sql(f"SELECT url, load_date, load_time, seq FROM acq_car_header "
                     f"WHERE price = '{config.SOLD_MARKER}'")


@register("json_lines_source", "WITH " + O.EV + """
SELECT 'header' AS kind, url, load_date, load_time, event_id AS seq, 'Listing ' || CAST(user_id AS VARCHAR) AS title,
       CAST(CASE WHEN event_type = 'view' THEN cents ELSE -1 END AS INTEGER) AS price, CAST(NULL AS BOOLEAN) AS deleted
FROM hdr UNION ALL
SELECT 'details', url, load_date, load_time, event_id, NULL, NULL, event_type = 'error' FROM det""")
def json_lines_source(spark, sf_dir):
    from pyspark.sql import types as T
    from adlife import schemas
    h, d = tb.raw_from_events(spark, sf_dir)
    run = table_path(spark, "runs", "json_lines", tb.uuid_tag())
    h.write.mode("overwrite").json(f"{run}/headers")
    d.write.mode("overwrite").json(f"{run}/details")
    seq = ("seq", T.LongType())
    headers = file_sources.read_json_lines(spark, f"{run}/headers", schemas.extended(schemas.RAW_HEADER, seq))
    details = file_sources.read_json_lines(spark, f"{run}/details", schemas.extended(schemas.RAW_DETAILS, seq))
    key = ["url", "load_date", "load_time", "seq"]
    return headers.select(F.lit("header").alias("kind"), *key, "title", parse.parse_price("price").alias("price")).unionByName(
        details.select(F.lit("details").alias("kind"), *key, "deleted"), allowMissingColumns=True)


# ---------------------------------------------------------------------------
# Sinks: keyed upserts and text export
# ---------------------------------------------------------------------------

UPSERT_CUT_MS = 1705752000000   # 2024-01-20 12:00 UTC: the base load stops mid-day
UPSERT_RELOAD_FROM = "2024-01-18"


@register("upsert_daily", "WITH " + O.DAILY + """
SELECT url, load_date, finnkode, title, location, year, km, price, property_keys, equipment,
       information, sold, deleted, load_time FROM daily""")
def upsert_daily(spark, sf_dir):
    h, d = _raw_tables(spark, sf_dir)
    path = table_path(spark, "runs", "upsert_daily", tb.uuid_tag())
    early = F.col("load_time") < F.lit(UPSERT_CUT_MS)
    base = daily_ops.build_daily(h.where(early), d.where(early), history=h.where(early))
    sinks.upsert(spark, base, path, ["load_date", "url"], unique_keys=True)
    reload = F.col("load_date") >= F.lit(UPSERT_RELOAD_FROM)
    update = daily_ops.build_daily(h.where(reload), d.where(reload), history=h)
    sinks.upsert(spark, update, path, ["load_date", "url"], unique_keys=True)
    return _daily_out(sources.read_daily(spark, path))


@register("upsert_lifecycle", "WITH " + O.DAILY + ",\nbase AS (" + O.lifecycle_select("2024-01-20", "2024-01-18")
          + "),\nupd AS (" + O.lifecycle_select(AS_OF, DELTA_START) + """)
SELECT * FROM upd UNION ALL SELECT * FROM base WHERE url NOT IN (SELECT url FROM upd)""")
def upsert_lifecycle(spark, sf_dir):
    daily = sources.read_daily(spark, tb.daily_table(spark, sf_dir))
    path = table_path(spark, "runs", "upsert_lifecycle", tb.uuid_tag())
    for as_of, delta in (("2024-01-20", "2024-01-18"), (AS_OF, DELTA_START)):
        sinks.write_version(spark, lc.lifecycle_rollup(daily, as_of, delta), path, ["url"], as_of)
    return batch_plan.read_lifecycle(spark, path)


_EXPORT_COLS = [f.name for f in __import__("adlife.schemas", fromlist=["LIFECYCLE"]).LIFECYCLE.fields]


@register("export_semicolon", "WITH " + O.DAILY + ",\nlc AS (" + O.lifecycle_select(AS_OF, DELTA_START) + """)
SELECT """ + " || ';' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in _EXPORT_COLS)
          + " AS value FROM lc")
def export_semicolon(spark, sf_dir):
    daily = sources.read_daily(spark, tb.daily_table(spark, sf_dir))
    path = table_path(spark, "runs", "export", tb.uuid_tag())
    sinks.export_delimited(lc.lifecycle_rollup(daily, AS_OF, DELTA_START), path)
    return spark.read.text(path)


# ---------------------------------------------------------------------------
# Scalar parsers and attribute functions on formatted text
# ---------------------------------------------------------------------------

@register("parse_numbers", """
SELECT o_orderkey,
       CAST(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_orderkey END AS INTEGER) AS code,
       CAST(CASE WHEN o_orderpriority = '5-LOW' THEN -1 ELSE floor(o_totalprice) END AS INTEGER) AS price,
       CAST(o_custkey * 37 AS INTEGER) AS km,
       CAST(CASE WHEN o_orderstatus = 'O' THEN -1 ELSE year(o_orderdate) END AS INTEGER) AS year,
       o_totalprice AS total
FROM orders""")
def parse_numbers(spark, sf_dir):
    t = tb.order_texts(tb.read_table(spark, sf_dir, "orders"))
    return t.select("o_orderkey", parse.parse_code("url").alias("code"),
                    parse.parse_price("price_text").alias("price"),
                    parse.parse_km("km_text").alias("km"),
                    parse.parse_year("year_text").alias("year"),
                    parse.parse_double("total_text").alias("total"))


@register("map_numeric_attributes", """
SELECT p_partkey,
       CASE WHEN p_type = 'SMALL' THEN -1.0 ELSE CAST(p_size AS DOUBLE) / 10.0 END AS sylindervolum,
       CAST(CASE WHEN p_type = 'PROMO' THEN -1 ELSE p_size END AS INTEGER) AS effekt,
       CAST(CASE WHEN p_brand = 'Brand#11' THEN 1 ELSE 1000 + p_size END AS INTEGER) AS vekt,
       CAST(CASE WHEN p_brand = 'Brand#11' THEN -1 ELSE 1000 + p_size END AS INTEGER) AS vekt_strict,
       CAST(CASE WHEN p_type = 'STANDARD' THEN -1 ELSE p_size END AS INTEGER) AS antall_eiere
FROM part""")
def map_numeric_attributes(spark, sf_dir):
    p = tb.part_properties(tb.read_table(spark, sf_dir, "part"))
    props = jsontext.json_map("properties")
    return p.select("p_partkey", A.engine_volume(props).alias("sylindervolum"),
                    A.power(props).alias("effekt"), A.weight(props).alias("vekt"),
                    A.weight(props, legacy=False).alias("vekt_strict"),
                    A.owners(props).alias("antall_eiere"))


@register("map_text_attributes", """
SELECT p_partkey,
       CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_size > 25 THEN 'Diesel' ELSE 'Bensin' END AS drivstoff,
       p_size > 30 AS automatgir,
       CASE WHEN p_type = 'MEDIUM' THEN NULL ELSE upper(p_type[1]) || lower(p_type[2:]) END AS farge,
       p_retailprice >= 950 AS tilstandsrapport
FROM part""")
def map_text_attributes(spark, sf_dir):
    p = tb.part_properties(tb.read_table(spark, sf_dir, "part"))
    props = jsontext.json_map("properties")
    return p.select("p_partkey", A.map_text(props, config.KEY_FUEL).alias("drivstoff"),
                    A.map_equals(props, config.KEY_GEARBOX, config.VALUE_AUTOMATIC).alias("automatgir"),
                    A.map_text(props, config.KEY_COLOUR).alias("farge"),
                    A.map_has_key(props, config.KEY_CONDITION_REPORT).alias("tilstandsrapport"))


@register("json_map_exclude", """
SELECT event_id, 2 AS n_default, 1 AS n_excluded,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""")
def json_map_exclude(spark, sf_dir):
    ev = tb.read_table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"Salgsform":"Bruktbil til salgs",'), F.regexp_replace("props", r"^\s*\{", ""))
    kept = jsontext.json_map(text, ["Salgsform"])
    return ev.select("event_id", F.size(jsontext.json_map(text)).alias("n_default"),
                     F.size(kept).alias("n_excluded"),
                     F.element_at(kept, "k").try_cast("int").alias("k"))


_LINE_LABELS = """
labels AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'Hengerfeste' WHEN 'A' THEN 'Tilhengarfeste'
                          ELSE 'Aluminiumsfelger' END AS label FROM lineitem
  UNION ALL
  SELECT l_orderkey, CASE WHEN l_linestatus = 'O' THEN 'Cruisekontroll' ELSE 'Regnsensor' END FROM lineitem
  UNION ALL
  SELECT l_orderkey, CASE WHEN l_quantity >= 45 THEN 'Skinnseter' WHEN l_quantity >= 40 THEN 'Skinninteriør'
                          WHEN l_quantity >= 30 THEN 'Delskinn' WHEN l_quantity < 3 THEN 'Xenon'
                          WHEN l_quantity < 5 THEN 'Xenonlys' WHEN l_quantity < 7 THEN 'Navigasjonssystem'
                          WHEN l_quantity < 9 THEN 'Sportsseter' WHEN l_quantity < 11 THEN 'Parkeringsensor foran'
                          WHEN l_quantity < 12 THEN 'Parkeringsensor' END FROM lineitem)"""


@register("json_set_exclude", "WITH " + _LINE_LABELS + """
SELECT l_orderkey, CAST(count(DISTINCT label) FILTER (WHERE label <> 'Aluminiumsfelger') AS INTEGER) AS n_items,
       coalesce(string_agg(DISTINCT label, '|' ORDER BY label) FILTER (WHERE label <> 'Aluminiumsfelger'), '') AS items
FROM labels WHERE label IS NOT NULL GROUP BY l_orderkey""")
def json_set_exclude(spark, sf_dir):
    eq = tb.order_equipment(tb.read_table(spark, sf_dir, "lineitem"))
    items = jsontext.json_set("equipment", ["Aluminiumsfelger"])
    return eq.select("l_orderkey", F.size(items).alias("n_items"), render_set(items).alias("items"))


@register("set_flags", "WITH " + _LINE_LABELS + """
SELECT l_orderkey,
       bool_or(label IN ('Hengerfeste', 'Tilhengarfeste', 'Tilhengerfeste')) AS hengerfeste,
       bool_or(label = 'Regnsensor') AS regnsensor,
       bool_or(label = 'Cruisekontroll') AS cruisekontroll,
       bool_or(label = 'Xenon') AS xenon,
       bool_or(label = 'Navigasjonssystem') AS navigasjon,
       bool_or(label = 'Sportsseter') AS sportsseter,
       bool_or(label IN ('Parkeringsensor', 'Parkeringsensor bak', 'Parkeringsensor foran')) AS parkeringsensor
FROM labels WHERE label IS NOT NULL GROUP BY l_orderkey""")
def set_flags(spark, sf_dir):
    eq = tb.order_equipment(tb.read_table(spark, sf_dir, "lineitem"))
    s = jsontext.json_set("equipment")
    v = config.DEFAULT_VOCABULARY
    return eq.select("l_orderkey",
                     A.has_any_label(s, v.towbar).alias("hengerfeste"),
                     A.has_label(s, v.rain_sensor).alias("regnsensor"),
                     A.has_label(s, v.cruise_control).alias("cruisekontroll"),
                     A.has_label(s, v.xenon).alias("xenon"),
                     A.has_label(s, v.navigation).alias("navigasjon"),
                     A.has_label(s, v.sport_seats).alias("sportsseter"),
                     A.has_any_label(s, v.parking_sensor).alias("parkeringsensor"))


@register("set_priority_class", "WITH " + _LINE_LABELS + """
SELECT l_orderkey,
       CASE WHEN bool_or(label IN ('Skinninteriør', 'Skinnseter')) THEN 'Skinnseter'
            WHEN bool_or(label = 'Delskinn') THEN 'Delskinn' ELSE 'Tøyseter' END AS skinninterior
FROM labels WHERE label IS NOT NULL GROUP BY l_orderkey""")
def set_priority_class(spark, sf_dir):
    eq = tb.order_equipment(tb.read_table(spark, sf_dir, "lineitem"))
    return eq.select("l_orderkey", A.interior_class(jsontext.json_set("equipment")).alias("skinninterior"))


@register("json_string_unquote", "SELECT doc_id, text FROM documents")
def json_string_unquote(spark, sf_dir):
    docs = tb.read_table(spark, sf_dir, "documents")
    quoted = jsontext.quote_json_string("text")
    return docs.select("doc_id", jsontext.json_string(quoted).alias("text"))


MARKER_PHRASES = ("License", "password", "@")


@register("text_contains_any", """
SELECT doc_id,
       (contains(text, 'servicehefte') OR contains(text, 'Servicehefte') OR contains(text, 'service hefte')) AS servicehefte,
       (contains(text, 'License') OR contains(text, 'password') OR contains(text, '@')) AS has_marker
FROM documents""")
def text_contains_any(spark, sf_dir):
    docs = tb.read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", A.contains_any("text", config.SERVICE_BOOK_PHRASES).alias("servicehefte"),
                       A.contains_any("text", MARKER_PHRASES).alias("has_marker"))


# ---------------------------------------------------------------------------
# Listing pages and ad pages
# ---------------------------------------------------------------------------

from adlife.operators import pages as page_ops  # noqa: E402

# Selectors for the driver's pages table (the ad-page defaults find nothing there).
PAGE_SELECTORS = {"properties": "nav ul", "equipment": "nav ul", "information": "div.ad",
                  "title": "h1", "location": "head title"}


def render_map(m) -> Column:
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


def _dec(x: str) -> str:
    # HTML entity decoding as an HTML5 parser does it for the entities in the pages:
    # legacy names also without ';', and '&amp' last so '&amp;quot;' stays '&quot;'
    for ent, ch in (("quot", '"'), ("copy", "©"), ("middot", "·")):
        x = f"replace(replace({x}, '&{ent};', '{ch}'), '&{ent}', '{ch}')"
    x = f"replace(replace({x}, '&amp;', '&'), '&amp', '&')"
    return f"regexp_replace(trim({x}), '\\s+', ' ', 'g')"


_EXTRACTED = """
ex AS (
  SELECT page_id, url,
         """ + _dec("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)") + """ AS title,
         """ + _dec("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)") + """ AS location,
         """ + _dec("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)") + """ AS information,
         list_transform(regexp_extract_all(html, '(?s)<li><a href=\"[^\"]*\">(.*?)</a></li>', 1),
                        lambda x: """ + _dec("x") + """) AS lis
  FROM pages),
pairs AS (
  SELECT page_id, lis[i] AS k, coalesce(lis[i + 1], '') AS v, i
  FROM (SELECT page_id, lis, unnest(generate_series(1, len(lis), 2)) AS i FROM ex) t),
props AS (
  SELECT page_id, string_agg(k || '=' || v, '|' ORDER BY k) AS properties
  FROM (SELECT page_id, k, arg_max(v, i) AS v FROM pairs GROUP BY page_id, k) t GROUP BY page_id),
exd AS (
  SELECT ex.page_id, ex.url, ex.title, ex.location, ex.information,
         array_to_string(ex.lis, '|') AS equipment, CAST(len(ex.lis) AS INTEGER) AS n_equipment,
         coalesce(props.properties, '') AS properties
  FROM ex LEFT JOIN props ON props.page_id = ex.page_id)"""


@register("page_extract", "WITH " + _EXTRACTED + """
SELECT page_id, url, title, location, information, equipment, n_equipment, properties,
       'MissingValue' AS price, 'MissingValue' AS year, 'MissingValue' AS km, false AS deleted
FROM exd""")
def page_extract(spark, sf_dir):
    pages = tb.read_table(spark, sf_dir, "pages")
    ex = page_ops.extract_pages(pages, PAGE_SELECTORS, keep=("page_id",))
    return ex.select("page_id", "url", "title", "location", "information",
                     F.array_join("equipment", "|").alias("equipment"),
                     F.size("equipment").alias("n_equipment"),
                     render_map("properties").alias("properties"),
                     "price", "year", "km", "deleted")


_HREFS = """
hrefs AS (
  SELECT DISTINCT coalesce(p.url, 'https://ads.example/gone/' || CAST(l.l_partkey AS VARCHAR)) AS url,
         p.page_id
  FROM lineitem l LEFT JOIN pages p ON p.page_id = l.l_partkey)"""


def _listing_headers(spark, sf_dir):
    msgs = spark.read.text(tb.listing_message_files(spark, sf_dir))
    return page_ops.explode_listing(msgs)


@register("page_extract_deleted", "WITH " + _EXTRACTED + "," + _HREFS + """
SELECT h.url, h.page_id IS NULL AS deleted,
       CASE WHEN h.page_id IS NULL THEN 'NULL' ELSE e.title END AS title,
       CASE WHEN h.page_id IS NULL THEN 'NULL' ELSE e.information END AS information,
       CASE WHEN h.page_id IS NULL THEN 'NULL' ELSE e.equipment END AS equipment,
       CASE WHEN h.page_id IS NULL THEN 'NULL=NULL' ELSE e.properties END AS properties
FROM hrefs h LEFT JOIN exd e ON e.page_id = h.page_id""")
def page_extract_deleted(spark, sf_dir):
    urls = _listing_headers(spark, sf_dir).select("url").distinct()
    pages = tb.read_table(spark, sf_dir, "pages").select("url", "html")
    found = page_ops.newest_pages(pages, urls)
    ex = page_ops.extract_pages(urls.join(found, "url", "left"), PAGE_SELECTORS)
    return ex.select("url", "deleted", "title", "information",
                     F.array_join("equipment", "|").alias("equipment"),
                     render_map("properties").alias("properties"))


@register("page_details_join", "WITH " + _EXTRACTED + """
SELECT coalesce(p.url, 'https://ads.example/gone/' || CAST(l.l_partkey AS VARCHAR)) AS url,
       strftime(TIMESTAMP '2024-01-01' + o.o_orderkey * INTERVAL 10 SECOND, '%Y-%m-%d') AS load_date,
       1704067200000 + o.o_orderkey * 10000 AS load_time,
       p.page_id IS NULL AS deleted,
       CASE WHEN p.page_id IS NULL THEN 'NULL' ELSE e.information END AS information,
       CASE WHEN p.page_id IS NULL THEN 'NULL' ELSE e.equipment END AS equipment
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN pages p ON p.page_id = l.l_partkey
LEFT JOIN exd e ON e.page_id = p.page_id""")
def page_details_join(spark, sf_dir):
    # details are derived from the stored header snapshots, as in the ingest
    headers = sources.read_raw_headers(spark, tb.listing_header_table(spark, sf_dir))
    pages = tb.read_table(spark, sf_dir, "pages")
    details = page_ops.details_from_listing(headers, pages, PAGE_SELECTORS)
    return details.select("url", "load_date", "load_time", "deleted",
                          jsontext.json_string("information").alias("information"),
                          F.array_join(F.from_json("equipment", "array<string>"), "|").alias("equipment"))


@register("explode_listing_page", """
SELECT coalesce(p.url, 'https://ads.example/gone/' || CAST(l.l_partkey AS VARCHAR)) AS url,
       strftime(TIMESTAMP '2024-01-01' + o.o_orderkey * INTERVAL 10 SECOND, '%Y-%m-%d') AS load_date,
       1704067200000 + o.o_orderkey * 10000 AS load_time,
       'Ad ' || CAST(10000000 + l.l_orderkey * 8 + l.l_linenumber AS VARCHAR) AS title,
       'Area ' || CAST(l.l_suppkey AS VARCHAR) AS location,
       CAST(year(l.l_shipdate) AS INTEGER) AS year,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE CAST(l.l_quantity AS INTEGER) * 1000 END AS INTEGER) AS km,
       l.l_returnflag = 'R' AS km_missing,
       CAST(floor(l.l_extendedprice) AS INTEGER) AS price
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN pages p ON p.page_id = l.l_partkey""")
def explode_listing_page(spark, sf_dir):
    headers = _listing_headers(spark, sf_dir)
    return headers.select("url", "load_date", "load_time", "title", "location",
                          parse.parse_year("year").alias("year"), parse.parse_km("km").alias("km"),
                          (F.col("km") == config.NULL_TEXT).alias("km_missing"),
                          parse.parse_price("price").alias("price"))


@register("json_documents_source", """
SELECT coalesce(p.url, 'https://ads.example/gone/' || CAST(l.l_partkey AS VARCHAR)) AS url,
       strftime(TIMESTAMP '2024-01-01' + (l.l_orderkey // 360) * INTERVAL 1 HOUR, '%Y-%m-%d') AS load_date,
       1704067200000 + (l.l_orderkey // 360) * 3600000 AS load_time,
       'Ad ' || CAST(10000000 + l.l_orderkey * 8 + l.l_linenumber AS VARCHAR) AS title,
       'Area ' || CAST(l.l_suppkey AS VARCHAR) AS location
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN pages p ON p.page_id = l.l_partkey""")
def json_documents_source(spark, sf_dir):
    from adlife import schemas
    docs = file_sources.read_json_documents(spark, tb.listing_documents(spark, sf_dir), schemas.LISTING_PAGE)
    return page_ops.explode_documents(docs).select("url", "load_date", "load_time", "title", "location")


# ---------------------------------------------------------------------------
# Streaming ingest
# ---------------------------------------------------------------------------

from adlife.streaming import ingest as stream_ops  # noqa: E402


@register("stream_ingest", "WITH " + _EXTRACTED + """,
ads AS (
  SELECT coalesce(p.url, 'https://ads.example/gone/' || CAST(l.l_partkey AS VARCHAR)) AS url,
         strftime(TIMESTAMP '2024-01-01' + o.o_orderkey * INTERVAL 10 SECOND, '%Y-%m-%d') AS load_date,
         1704067200000 + o.o_orderkey * 10000 AS load_time, p.page_id,
         'Ad ' || CAST(10000000 + l.l_orderkey * 8 + l.l_linenumber AS VARCHAR) AS title,
         'Area ' || CAST(l.l_suppkey AS VARCHAR) AS location, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE CAST(l.l_quantity AS INTEGER) * 1000 END AS INTEGER) AS km,
         CAST(floor(l.l_extendedprice) AS INTEGER) AS price
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN pages p ON p.page_id = l.l_partkey),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY load_date, url, load_time ORDER BY title DESC, location DESC, year DESC) AS rn
                        FROM ads) t WHERE rn = 1)
SELECT k.url, k.load_date, k.load_time, k.title, k.location, k.year, k.km, k.price, k.page_id IS NULL AS deleted,
       CASE WHEN k.page_id IS NULL THEN 'NULL' ELSE e.information END AS information,
       CASE WHEN k.page_id IS NULL THEN 'NULL' ELSE e.equipment END AS equipment
FROM kept k LEFT JOIN exd e ON e.page_id = k.page_id""")
def stream_ingest(spark, sf_dir):
    """The stored rows of both raw tables after the stream has drained its messages."""
    run = table_path(spark, "runs", "stream", tb.uuid_tag())
    source = tb.listing_message_files(spark, sf_dir)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 8).text(source)
    pages = tb.read_table(spark, sf_dir, "pages")
    q = stream_ops.start_ingest(messages, f"{run}/acq_header", f"{run}/acq_details", f"{run}/_checkpoint",
                                pages=pages, selectors=PAGE_SELECTORS, available_now=True,
                                extract_once=f"{run}/page_details")
    q.awaitTermination()
    key = ["load_date", "url", "load_time"]
    h = sources.read_raw_headers(spark, f"{run}/acq_header").select(
        *key, "title", "location", parse.parse_year("year").alias("year"), parse.parse_km("km").alias("km"),
        parse.parse_price("price").alias("price"))
    # most ads have no page: the sentinels they hold are not parsed
    no_text, no_labels = (json.dumps(x, separators=(",", ":")) for x in (config.NULL_TEXT, config.NULL_SET))
    d = sources.read_raw_details(spark, f"{run}/acq_details").select(
        *key, "deleted",
        F.when(F.col("information") == no_text, config.NULL_TEXT)
         .otherwise(jsontext.json_string("information")).alias("information"),
        F.when(F.col("equipment") == no_labels, "|".join(config.NULL_SET))
         .otherwise(F.array_join(F.from_json("equipment", "array<string>"), "|")).alias("equipment"))
    return h.join(d, key, "full")


# ---------------------------------------------------------------------------
# The incremental daily job, end to end
# ---------------------------------------------------------------------------

from adlife.plans import batch as batch_plan  # noqa: E402

BATCH_DAYS = ("2024-01-20", "2024-01-25", "2024-01-30")


@register("daily_batch", "WITH " + O.DAILY + ",\nr1 AS (" + O.lifecycle_select("2024-01-20", "2016-07-01")
          + "),\nr2 AS (" + O.lifecycle_select("2024-01-25", "2024-01-20")
          + "),\nr3 AS (" + O.lifecycle_select("2024-01-30", "2024-01-25") + """)
SELECT * FROM r3
UNION ALL SELECT * FROM r2 WHERE url NOT IN (SELECT url FROM r3)
UNION ALL SELECT * FROM r1 WHERE url NOT IN (SELECT url FROM r3) AND url NOT IN (SELECT url FROM r2)""")
def daily_batch(spark, sf_dir):
    run = table_path(spark, "runs", "daily_batch", tb.uuid_tag())
    tables = batch_plan.Tables(tb.raw_header_table(spark, sf_dir), tb.raw_details_table(spark, sf_dir),
                               f"{run}/prop_daily", f"{run}/lifecycle")
    for today in BATCH_DAYS:
        batch_plan.run_daily_batch(spark, tables, today, with_seq=True)
    return batch_plan.read_lifecycle(spark, tables.lifecycle)
