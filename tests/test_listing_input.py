"""The listing input derived from orders and lineitem: dealt once as numbers, stored compressed, whole."""

import glob
import io
import re
from contextlib import redirect_stdout

import pytest

from adlife.plans import registry
from adlife.plans import testbed as tb

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Keys that repeat, are null or lack their other side."""
    d = str(tmp_path_factory.mktemp("listing") / "sf")
    lines = [(1, 1, 11, 1), (1, 2, 12, 2), (1, 2, 12, 2), (2, 9, None, 1), (3, 1, 13, 1), (None, 1, 1, 1), (500, 2, 15, None), (7, None, 1, 1)]
    day = "to_timestamp('1997-03-0' || (1 + l_suppkey % 5))"
    spark.createDataFrame([(*r, 10.0 * k, 1234.5 + k, "R" if k % 3 == 0 else "A") for k, r in enumerate(lines)],
                          LINES.rsplit(",", 1)[0]).selectExpr("*", f"{day} AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k,) for k in (1, 2, 2, 7, 8, 500, None)], "o_orderkey long").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1, "u1", "h"), (2, "u2", "h"), (2, "u2b", "h"), (None, "u0", "h")],
                          "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d


def joined(spark, sf):
    """(order key, line number, supplier, url), by plain joins."""
    for t in ("lineitem", "orders", "pages"):
        spark.read.parquet(f"{sf}/{t}.parquet").createOrReplaceTempView(f"listing_{t}")
    return sorted(map(tuple, spark.sql("""
        SELECT o_orderkey, 'Ad ' || (10000000 + o_orderkey * 8 + l_linenumber) AS title, 'Area ' || l_suppkey AS location,
               coalesce(url, 'https://ads.example/gone/' || l_partkey) AS url
        FROM listing_lineitem JOIN listing_orders ON o_orderkey = l_orderkey LEFT JOIN listing_pages ON page_id = l_partkey""").collect()), key=str)


def test_messages_hold_every_line_of_every_order(spark, sf):
    got = registry.explode_listing_page(spark, sf)
    got = [((r.load_time - tb.CRAWL_START_MS) // tb.CRAWL_STEP_MS, r.title, r.location, r.url) for r in got.collect()]
    want = [(k, *["NULL" if x is None else x for x in rest]) for k, *rest in joined(spark, sf)]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) == 10


def test_documents_hold_every_line_of_their_hour(spark, sf):
    got = registry.json_documents_source(spark, sf)
    got = [((r.load_time - tb.CRAWL_START_MS) // 3_600_000, r.title, r.location, r.url) for r in got.collect()]
    want = [(k // 360, *["NULL" if x is None else x for x in rest]) for k, *rest in joined(spark, sf)]
    assert sorted(got, key=str) == sorted(want, key=str)
    files = glob.glob(f"{tb.listing_documents(spark, sf)}/hour=*/*.gz")
    assert len(files) == len({k // 360 for k, *_ in joined(spark, sf)})          # one file an hour, compressed


def test_lines_are_dealt_once_and_as_numbers(spark, sf):
    """Behind the look-up of the pages there is one shuffle, and no formatted text in it."""
    text = io.StringIO()
    with redirect_stdout(text):
        tb.listing_messages(spark, sf).explain("formatted")
    exchanges = [block for block in re.split(r"\n\n+", text.getvalue()) if re.match(r"\(\d+\) Exchange", block)]
    dealt = [block for block in exchanges if "l_shipdate" in block or "ad#" in block or "value#" in block]
    assert len([b for b in dealt if "l_partkey" not in b.split("Arguments:")[1]]) == 1
    assert not any("ad#" in b or "value#" in b for b in exchanges)
    files = glob.glob(f"{tb.listing_message_files(spark, sf)}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
