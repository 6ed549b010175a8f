"""Raw listing layers derived, with Spark, from the driver's test tables.

The driver's tables are not listing snapshots, so the registered queries
first derive them (every row of the source feeds the derived table, so the
work grows with the data):

* ``events`` is the snapshot history. ``user_id`` is the listing (url),
  ``ts`` the load time, ``event_id`` the arrival sequence (tiebreak).
  ``view`` / ``purchase`` / ``signup`` rows are search-result snapshots
  (headers); a purchase shows the sold marker as price, a signup an
  unparsable price. ``click`` / ``error`` rows are ad-page snapshots
  (details); an error is a deleted page.
* ``orders`` + ``lineitem`` are listing pages (one JSON message per order,
  one ad per line), each ad linking to ``pages.url`` when a page with
  ``page_id = l_partkey`` exists.

Text is *formatted* from the source numbers here and parsed back by the
library; the DuckDB oracle works from the original numbers, so the check is
independent of the formatting code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlife import config
from adlife.functions.dates import wall_clock_to_epoch_ms
from adlife.functions.jsontext import quote_json_string

URL_PREFIX = "https://ads.example/item?code="
HEADER_EVENTS = ("view", "purchase", "signup")
DETAIL_EVENTS = ("click", "error")
NBSP = "\u00a0"


_FRAMES: dict = {}


def memo(kind: str):
    """Reuse a derived DataFrame (a logical plan, no data) per session and input dir."""
    def wrap(fn):
        def inner(spark: SparkSession, sf_dir: str, *args):
            key = (spark.sparkContext.applicationId, kind, sf_dir.rstrip("/"), args)
            if key not in _FRAMES:
                _FRAMES[key] = fn(spark, sf_dir, *args)
            return _FRAMES[key]
        inner.__name__ = fn.__name__
        inner.__doc__ = fn.__doc__
        return inner
    return wrap


@memo("table")
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def group_digits(n: Column) -> Column:
    """12345 -> '12 345' (space as thousands separator)."""
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit(" "))


def _event_base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", "event_type", "value",
        F.concat(F.lit(URL_PREFIX), (F.lit(10_000_000) + F.col("user_id")).cast("string")).alias("url"),
        F.date_format("ts", "yyyy-MM-dd").alias("load_date"),
        wall_clock_to_epoch_ms("ts").alias("load_time"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.dayofmonth("ts").alias("dom"),
        F.round(F.col("value") * 100).cast("int").alias("cents"),
    )


def headers_from_events(events: DataFrame) -> DataFrame:
    """Raw header rows (schema RAW_HEADER + ``seq``)."""
    e = _event_base(events).where(F.col("event_type").isin(*HEADER_EVENTS))
    year = (F.lit(1990) + F.col("dom")).cast("string")
    year = (F.when(F.col("event_type") == "signup", F.lit("ukjent"))
             .when(F.col("value") < 50, F.concat(F.lit('"'), year, F.lit('"')))
             .otherwise(year))
    price = (F.when(F.col("event_type") == "purchase", F.lit(config.SOLD_MARKER))
              .when(F.col("event_type") == "signup", F.lit("Pris på forespørsel"))
              .otherwise(F.concat(group_digits(F.col("cents")), F.lit(",-"))))
    return e.select(
        "url", "load_date", "load_time",
        F.concat(F.lit("Listing "), F.col("user_id").cast("string")).alias("title"),
        F.concat(F.lit("Area "), F.col("k").cast("string")).alias("location"),
        year.alias("year"),
        F.concat(group_digits(F.col("cents")), F.lit(" km")).alias("km"),
        price.alias("price"),
        F.col("event_id").alias("seq"),
    )


def _between(c: Column, lo, hi) -> Column:
    return (c >= lo) & (c <= hi)


def _properties_json(k: Column, value: Column) -> Column:
    volume = F.concat((k / 10).cast("int").cast("string"), F.lit(","),
                      (k - (k / 10).cast("int") * 10).cast("string"), F.lit(" l"))
    colour = (F.when(k < 40, F.lit("Blå")).when(k <= 44, F.lit(None))
               .when(k < 66, F.lit("Sølv")).otherwise(F.lit("Svart")))
    entries = F.map_from_arrays(
        F.array(*[F.lit(x) for x in ("Effekt", "Sylindervolum", "Vekt", "Antall eiere", "Girkasse",
                                     "Drivstoff", "Farge", "Tilstandsrapport", "Salgsform")]),
        F.array(
            F.concat(k.cast("string"), F.lit(" Hk")),
            volume,
            F.when(k >= 10, F.concat(F.lit("1" + NBSP), F.lpad(k.cast("string"), 3, "0"), F.lit(" kg"))),
            F.when(value >= 20, (F.lit(1) + F.floor(value / 100)).cast("string")),
            F.when(k >= 50, F.lit("Automat")).otherwise(F.lit("Manuell")),
            F.when(value >= 250, F.lit("Diesel")).otherwise(F.lit("Bensin")),
            colour,
            F.when(value >= 400, F.lit("Ja")),
            F.lit("Bruktbil til salgs"),
        ))
    return F.to_json(F.map_filter(entries, lambda _, v: v.isNotNull()))


def _equipment_json(k: Column, value: Column, dom: Column) -> Column:
    labels = F.array(
        F.lit("Aluminiumsfelger"),
        F.when(k >= 80, F.lit("Hengerfeste")),
        F.when(_between(k, 40, 45), F.lit("Tilhengerfeste")),
        F.when(value >= 300, F.lit("Skinnseter")),
        F.when((value >= 280) & (value < 300), F.lit("Skinninteriør")),
        F.when((value >= 150) & (value < 280), F.lit("Delskinn")),
        F.when(dom >= 15, F.lit("Regnsensor")),
        F.when(k < 30, F.lit("Cruisekontroll")),
        F.when(_between(k, 30, 35), F.lit("Xenon")),
        F.when(_between(k, 36, 39), F.lit("Xenonlys")),
        F.when(value < 100, F.lit("Navigasjonssystem")),
        F.when(_between(k, 60, 70), F.lit("Sportsseter")),
        F.when((value >= 100) & (value < 200), F.lit("Parkeringsensor bak")),
        F.when((value >= 200) & (value < 220), F.lit("Parkeringsensor")),
        F.lit("Aluminiumsfelger"),
    )
    return F.to_json(F.filter(labels, lambda x: x.isNotNull()))


def _information_text(user_id: Column, k: Column, value: Column) -> Column:
    note = (F.when(k >= 90, F.lit(" med servicehefte"))
             .when(_between(k, 20, 22), F.lit(". service hefte finnes"))
             .when(_between(k, 23, 25), F.lit(". SERVICEHEFTE"))
             .when(_between(k, 26, 27), F.lit(". Servicehefte ok"))
             .otherwise(F.lit("")))
    rims = F.when(value < 10, F.lit(' og 17" felger')).otherwise(F.lit(""))
    return F.concat(F.lit("Bil "), user_id.cast("string"), note, rims)


def details_from_events(events: DataFrame) -> DataFrame:
    """Raw details rows (schema RAW_DETAILS + ``seq``)."""
    e = _event_base(events).where(F.col("event_type").isin(*DETAIL_EVENTS))
    k, value = F.col("k"), F.col("value")
    deleted = F.col("event_type") == "error"
    broken = value < 100   # deleted pages stored as invalid JSON, the rest as valid sentinels
    return e.select(
        "url", "load_date", "load_time",
        F.when(~deleted, _properties_json(k, value))
         .when(broken, F.lit("{NULL:NULL}")).otherwise(F.lit('{"NULL":"NULL"}')).alias("properties"),
        F.when(~deleted, _equipment_json(k, value, F.col("dom")))
         .when(broken, F.lit("[NULL]")).otherwise(F.lit('["NULL"]')).alias("equipment"),
        F.when(~deleted, quote_json_string(_information_text(F.col("user_id"), k, value)))
         .when(broken, F.lit("NULL")).otherwise(F.lit('"NULL"')).alias("information"),
        deleted.alias("deleted"),
        F.col("event_id").alias("seq"),
    )


@memo("raw")
def raw_from_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = read_table(spark, sf_dir, "events")
    return headers_from_events(events), details_from_events(events)


# ---------------------------------------------------------------------------
# Listing pages from orders + lineitem
# ---------------------------------------------------------------------------

def ad_code(orderkey: Column, linenumber: Column) -> Column:
    return (F.lit(10_000_000) + orderkey * 8 + linenumber).cast("string")


CRAWL_START_MS = 1_704_067_200_000   # 2024-01-01 00:00 UTC
CRAWL_STEP_MS = 10_000                # one search-result page fetched every 10 s


LINE_COLUMNS = ("l_linenumber", "l_suppkey", "l_partkey", "url", "l_shipdate", "l_returnflag", "l_quantity", "l_extendedprice")


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, is_line, line columns): order lines with the url of their page, and orders (``is_line`` false).

    Both in one table, as numbers: dealt once by order, lines meet their order without a join, and
    the text of the ads is formatted behind that shuffle.
    """
    orders = read_table(spark, sf_dir, "orders").where(F.col("o_orderkey").isNotNull())
    lines = read_table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull())
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    found = lines.join(pages, lines.l_partkey == pages.page_id, "left").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("is_line"), *LINE_COLUMNS)
    return found.unionByName(orders.select("o_orderkey", F.lit(False).alias("is_line")), allowMissingColumns=True)


def _ad(key: Column, line: Column) -> Column:
    return F.struct(
        F.array(F.struct(F.concat(F.lit("Area "), line["l_suppkey"].cast("string")).alias("text"))).alias("location"),
        F.array(F.struct(
            F.concat(F.lit("Ad "), ad_code(key, line["l_linenumber"])).alias("text"),
            F.coalesce(line["url"], F.concat(F.lit("https://ads.example/gone/"),
                                             line["l_partkey"].cast("string"))).alias("href"),
        )).alias("title"),
        F.array(F.struct(F.year(line["l_shipdate"]).cast("string").alias("text"))).alias("year"),
        F.when(line["l_returnflag"] != "R", F.array(F.struct(
            F.concat(group_digits(line["l_quantity"].cast("int") * 1000), F.lit(" km")).alias("text")))).alias("km"),
        F.array(F.struct(F.concat(group_digits(F.floor(line["l_extendedprice"]).cast("long")), F.lit(",-")).alias("text"))).alias("price"),
    )


def listing_pages(lines: DataFrame, *by: str) -> DataFrame:
    """(``by``, o_orderkey, lines): one row per order that has lines (a bounded group), from :func:`listing_lines`."""
    line = F.when(F.col("is_line"), F.struct(*LINE_COLUMNS))
    grouped = lines.groupBy(*by, "o_orderkey").agg(
        F.collect_list(line).alias("lines"), F.count_if(~F.col("is_line")).alias("orders"))
    # an order key that orders holds several times gives as many pages
    return (grouped.where((F.size("lines") > 0) & (F.col("orders") > 0))
                   .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("orders"))))
                   .select(*by, "o_orderkey", "lines"))


def page_ads(key: Column, lines: Column) -> Column:
    """The ads of a page's lines, by line number."""
    ads = F.transform(lines, lambda a: F.struct(a["l_linenumber"].alias("l_linenumber"), _ad(key, a).alias("ad")))
    return F.transform(F.sort_array(ads), lambda a: a["ad"])


def crawl_ms() -> Column:
    return F.lit(CRAWL_START_MS) + F.col("o_orderkey") * F.lit(CRAWL_STEP_MS)


@memo("listing")
def listing_messages(spark: SparkSession, sf_dir: str, zone: str = "UTC") -> DataFrame:
    """One JSON search-result page per order (column ``value``), one ad per line, dealt by ranges of the order key.

    Pages hold the lines of one order (a bounded group), and are fetched in
    order-key order, one every ``CRAWL_STEP_MS``. The ``km`` element is left
    out for returned lines (``l_returnflag = 'R'``) to exercise the
    missing-element default.
    """
    pages = listing_pages(listing_lines(spark, sf_dir).repartitionByRange("o_orderkey"))
    doc = F.struct(
        F.struct(F.concat(F.lit("https://ads.example/search?page="), F.col("o_orderkey").cast("string")).alias("url"),
                 F.col("o_orderkey").cast("string").alias("resourceId"),
                 F.array(F.struct(page_ads(F.col("o_orderkey"), F.col("lines")).alias("group"))).alias("data")).alias("extractorData"),
        F.struct(F.lit(200).alias("statusCode"), crawl_ms().cast("long").alias("timestamp")).alias("pageData"),
    )
    return pages.select(F.col("o_orderkey").alias("message_id"), F.to_json(doc).alias("value"))


# ---------------------------------------------------------------------------
# Written copies (date-partitioned tables in the shared folder)
# ---------------------------------------------------------------------------

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    from adlife.session import shared_dir
    return shared_dir(spark), sf_dir.rstrip("/"), name


def written_table(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of table ``name`` derived from ``sf_dir``; written once per session."""
    from adlife.session import table_path
    key = _key(spark, sf_dir, name)
    if key not in _WRITTEN:
        tag = "sf" + sf_dir.rstrip("/").rsplit("/", 1)[-1].replace("sf", "").replace(".", "_")
        # per application: concurrent jobs on the same inputs never share files
        path = table_path(spark, "testbed", spark.sparkContext.applicationId, tag, name)
        build(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def raw_header_table(spark: SparkSession, sf_dir: str) -> str:
    from adlife.sinks.tables import write_clustered
    return written_table(spark, sf_dir, "acq_header",
                         lambda p: write_clustered(raw_from_events(spark, sf_dir)[0], p))


def raw_details_table(spark: SparkSession, sf_dir: str) -> str:
    from adlife.sinks.tables import write_clustered
    return written_table(spark, sf_dir, "acq_details",
                         lambda p: write_clustered(raw_from_events(spark, sf_dir)[1], p))


def daily_table(spark: SparkSession, sf_dir: str) -> str:
    from adlife.operators.daily import build_daily
    from adlife.sources.tables import read_raw_details, read_raw_headers

    def build(path):
        h = read_raw_headers(spark, raw_header_table(spark, sf_dir), with_seq=True)
        d = read_raw_details(spark, raw_details_table(spark, sf_dir), with_seq=True)
        build_daily(h, d).write.mode("overwrite").partitionBy("load_date").parquet(path)
    return written_table(spark, sf_dir, "prop_daily", build)


def uuid_tag() -> str:
    import uuid
    return uuid.uuid4().hex[:12]


# ---------------------------------------------------------------------------
# Text formatted from orders / part / lineitem / documents
# ---------------------------------------------------------------------------

def order_texts(orders: DataFrame) -> DataFrame:
    """Listing-like text per order: url with ad code, price, km and year text."""
    key = F.col("o_orderkey").cast("string")
    code = (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("X"), F.lpad(key, 7, "0")))
             .otherwise(F.lpad(key, 8, "0")))
    price = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Ring for pris"))
              .otherwise(F.concat(group_digits(F.floor("o_totalprice")), F.lit(",-"))))
    year = F.year("o_orderdate").cast("string")
    year = (F.when(F.col("o_orderstatus") == "O", F.lit("ny"))
             .otherwise(F.concat(F.lit('"'), year, F.lit('"'))))
    return orders.select(
        "o_orderkey",
        F.concat(F.lit(URL_PREFIX), code).alias("url"),
        price.alias("price_text"),
        F.concat(group_digits(F.col("o_custkey") * 37), F.lit(" km")).alias("km_text"),
        year.alias("year_text"),
        F.col("o_totalprice").cast("string").alias("total_text"),
    )


def part_properties(part: DataFrame) -> DataFrame:
    """A property map per part, some keys left out by part attributes."""
    size, ptype, brand = F.col("p_size"), F.col("p_type"), F.col("p_brand")
    tenth = (size / 10).cast("int")
    entries = F.map_from_arrays(
        F.array(*[F.lit(x) for x in ("Sylindervolum", "Effekt", "Vekt", "Antall eiere", "Drivstoff",
                                     "Girkasse", "Farge", "Tilstandsrapport")]),
        F.array(
            F.when(ptype != "SMALL", F.concat(tenth.cast("string"), F.lit(","),
                                              (size - tenth * 10).cast("string"), F.lit(" l"))),
            F.when(ptype == "PROMO", F.concat(F.lit("ca. "), size.cast("string"), F.lit(" Hk")))
             .otherwise(F.concat(size.cast("string"), F.lit(" Hk"))),
            F.when(brand != "Brand#11", F.concat(F.lit("1" + NBSP), F.lpad(size.cast("string"), 3, "0"), F.lit(" kg"))),
            F.when(ptype != "STANDARD", size.cast("string")),
            F.when(ptype != "LARGE", F.when(size > 25, F.lit("Diesel")).otherwise(F.lit("Bensin"))),
            F.when(size > 30, F.lit("Automat")).otherwise(F.lit("Manuell")),
            F.when(ptype != "MEDIUM", F.initcap(ptype)),
            F.when(F.col("p_retailprice") >= 950, F.lit("Ja")),
        ))
    return part.select("p_partkey", F.to_json(F.map_filter(entries, lambda _, v: v.isNotNull())).alias("properties"))


def line_labels(lines: DataFrame) -> DataFrame:
    """Equipment-like labels of one order line (1-3 labels)."""
    q = F.col("l_quantity")
    flag = (F.when(F.col("l_returnflag") == "R", F.lit("Hengerfeste"))
             .when(F.col("l_returnflag") == "A", F.lit("Tilhengarfeste"))
             .otherwise(F.lit("Aluminiumsfelger")))
    status = F.when(F.col("l_linestatus") == "O", F.lit("Cruisekontroll")).otherwise(F.lit("Regnsensor"))
    by_qty = (F.when(q >= 45, F.lit("Skinnseter")).when(q >= 40, F.lit("Skinninteriør"))
               .when(q >= 30, F.lit("Delskinn")).when(q < 3, F.lit("Xenon")).when(q < 5, F.lit("Xenonlys"))
               .when(q < 7, F.lit("Navigasjonssystem")).when(q < 9, F.lit("Sportsseter"))
               .when(q < 11, F.lit("Parkeringsensor foran")).when(q < 12, F.lit("Parkeringsensor")))
    return lines.select("l_orderkey", F.filter(F.array(flag, status, by_qty), lambda x: x.isNotNull()).alias("labels"))


def order_equipment(lines: DataFrame) -> DataFrame:
    """One JSON label array per order (orders hold a bounded number of lines)."""
    per_line = line_labels(lines)
    return (per_line.groupBy("l_orderkey")
                    .agg(F.to_json(F.flatten(F.collect_list("labels"))).alias("equipment")))


def listing_message_files(spark: SparkSession, sf_dir: str) -> str:
    """Listing-page messages written as gzipped JSON-lines text files, in fetch order.

    Plays the role of the message log: range-partitioned by message id so earlier files hold
    earlier pages; their number is that of the shuffle's partitions.
    """
    return written_table(spark, sf_dir, "listing_messages",
                         lambda p: listing_messages(spark, sf_dir).select("value")
                                   .write.mode("overwrite").text(p, compression="gzip"))


def listing_documents(spark: SparkSession, sf_dir: str) -> str:
    """Pretty-printed whole-file documents (gzipped): one file per hour of crawling, its ads in one group.

    Lines are dealt once, by hour, and sorted for the folders before their text is formatted.
    """
    def build(path):
        hour = F.floor(crawl_ms() / 3_600_000)
        lines = listing_lines(spark, sf_dir).withColumn("hour", hour).repartition("hour")
        docs = listing_pages(lines, "hour").groupBy("hour").agg(
            F.collect_list(F.struct("o_orderkey", "lines")).alias("pages"))              # one crawled hour is one document
        ads = F.flatten(F.transform("pages", lambda p: page_ads(p["o_orderkey"], p["lines"])))
        doc = F.struct(
            F.struct(F.array(F.struct(ads.alias("group"))).alias("data")).alias("extractorData"),
            F.struct((F.col("hour") * 3_600_000).alias("timestamp")).alias("pageData"))
        docs.sortWithinPartitions("hour").select("hour", F.to_json(doc, {"pretty": "true"}).alias("value")).write.mode(
            "overwrite").partitionBy("hour").text(path, compression="gzip")
    return written_table(spark, sf_dir, "listing_documents", build)


def stored_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw header / details tables as stored (date-partitioned, with ``seq``)."""
    from adlife.sources.tables import read_raw_details, read_raw_headers
    return (read_raw_headers(spark, raw_header_table(spark, sf_dir), with_seq=True),
            read_raw_details(spark, raw_details_table(spark, sf_dir), with_seq=True))


def listing_header_table(spark: SparkSession, sf_dir: str) -> str:
    """Header snapshots exploded from the listing messages, stored by load date."""
    from adlife.operators.pages import explode_listing
    from adlife.sinks.tables import write_clustered
    return written_table(spark, sf_dir, "listing_headers",
                         lambda p: write_clustered(explode_listing(
                             spark.read.text(listing_message_files(spark, sf_dir))), p))
