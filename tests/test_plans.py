"""Plan-shape checks: the scale properties the design relies on stay in the plans."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from adlife.operators import daily as D
from adlife.operators import lifecycle as lc
from adlife.operators.asof import asof_lookup
from adlife.plans import testbed as tb
from adlife.sources import tables as T

SF = "/root/testdata/sf0.001"
NO_GO = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue().split("== Physical Plan ==")[-1]


def test_date_slices_prune_partitions_and_columns(spark):
    h, _ = tb.stored_raw(spark, SF)
    p = plan(T.scan_dates(h, ["2024-01-05", "2024-01-06"]).select("url", "load_time"))
    assert "PartitionFilters: [isnotnull(load_date" in p or "PartitionFilters: [load_date" in p
    assert "ReadSchema: struct<url:string,load_time:bigint>" in p
    probe = plan(T.latest_load_date(h, "2024-02-03"))
    assert "PartitionFilters: [isnotnull(load_date" in probe and "2024-01-27" in probe


def test_daily_build_is_python_free_and_join_safe(spark):
    h, d = tb.stored_raw(spark, SF)
    p = plan(D.build_daily(h, d))
    assert not any(x in p for x in NO_GO + PYTHON)


def test_lifecycle_reads_fat_columns_of_the_delta_only(spark):
    daily = T.read_daily(spark, tb.daily_table(spark, SF))
    p = plan(lc.lifecycle_rollup(daily, "2024-01-30", "2024-01-28"))
    assert "partial_max_by" in p and "partial_min_by" in p            # map-side combine
    scans = [x for x in p.split("FileScan")[1:]]
    year = [x for x in scans if "2023-01-30" in x]
    assert len(year) == 1 and not any(c in year[0].split("ReadSchema")[1] for c in ("properties", "equipment", "information"))
    fat = [x for x in scans if "properties" in x.split("ReadSchema")[1]]
    assert len(fat) == 1 and "2024-01-28" in fat[0].split("PushedFilters")[0]
    assert "LeftSemi" in p
    assert not any(x in p for x in NO_GO + PYTHON)


def test_asof_scans_each_input_once_and_segments_hot_keys_only(spark):
    h, _ = tb.stored_raw(spark, SF)
    sold = h.where(F.col("price") == "Solgt")
    single = plan(asof_lookup(sold, h, "url", "load_time", "load_time", ["price"], build_tiebreak="seq", tasks=2))
    assert "Exchange hashpartitioning(url" in single and "__s#" not in single
    assert single.count("FileScan") == 2 and "Join" not in single
    p = plan(asof_lookup(sold, h, "url", "load_time", "load_time", ["price"], build_tiebreak="seq", tasks=500))
    assert re.search(r"Exchange hashpartitioning\(url#\d+, __s", p) and "partial_max_by" in p
    assert not any(x in p + single for x in NO_GO + PYTHON)


def test_sinks_prune_the_stored_scan(spark):
    from adlife.sinks.tables import _touched
    h, _ = tb.stored_raw(spark, SF)
    new = h.where(F.col("load_date").isin("2024-01-05", "2024-01-06"))
    touched, values = _touched(h, new, "load_date")
    p = plan(touched)
    assert sorted(values) == ["2024-01-05", "2024-01-06"]
    assert "PartitionFilters" in p and all(v in p.split("PartitionFilters")[1].split("]")[0] for v in values)


def test_details_merge_prices_first(spark):
    h, d = tb.stored_raw(spark, SF)
    p = plan(D.merge_header_details(h, d))
    assert not any(x in p for x in NO_GO + PYTHON)
    # the price look-up has no details payload among its inputs: its sold rows are joined before details are read
    lines = p.splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    depth = len(lines[semi]) - len(lines[semi].lstrip(" :+-*"))
    below = [x for x in lines[semi + 1:] if x.strip()]
    end = next((i for i, x in enumerate(below) if len(x) - len(x.lstrip(" :+-*")) <= depth), len(below))
    assert end and not any("properties" in x for x in below[:end])


def test_listing_details_semi_join_pages_first(spark):
    from adlife.operators.pages import newest_pages
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    p = plan(newest_pages(pages, pages.select("url").where("url like '%1'").distinct()))
    assert "LeftSemi" in p and p.index("max_by") < p.index("LeftSemi")


def scanned_rows(df) -> int:
    """Rows that the file scans of an executed frame gave out."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")           # the plan as it runs, also where nothing is found
    try:
        df.collect()
        todo = [df._jdf.queryExecution().executedPlan()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_point_read_skips_row_groups(spark, workdir):
    """One url of a raw table: other row groups are skipped by statistics, and those around an absent url by Bloom filters."""
    from adlife.sinks import tables as K
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(1 << 14))
    try:
        rows = spark.range(40_000).selectExpr("'2024-01-01' AS load_date", "concat('http://ads.example/', lpad(id * 2, 8, '0')) AS url",
                                              "1000 + id AS load_time", "sha2(cast(id AS string), 256) AS title")
        K.append_keyed(spark, rows, workdir, ["load_date", "url", "load_time"], order=["url", "-load_time"])
    finally:
        conf.unset("parquet.block.size")
    table = T.read_table(spark, workdir, rows.schema)
    assert scanned_rows(table.select("url")) == 40_000
    held = [f"http://ads.example/{k:08d}" for k in (20_000, 61_000)]
    some = T.history_of(table, held, until_time=10**9)
    assert "In(url" in plan(some) or "EqualTo(url" in plan(some) or "PushedFilters: [In" in plan(some)
    assert some.count() == 2 and scanned_rows(T.history_of(table, held)) < 8_000
    absent = [f"http://ads.example/{k:08d}" for k in (20_001, 61_001)]
    assert scanned_rows(T.history_of(table, absent)) == 0
    assert T.history_of(table, held, until_time=0).count() == 0 and T.history_of(table, held, until_date="2023-12-31").count() == 0
    # without the dictionaries, which tell the same of such small row groups, the Bloom filters alone; then neither
    def read(**filters):
        options = {f"parquet.filter.{k}.enabled": str(v).lower() for k, v in {"dictionary": False, **filters}.items()}
        return T.history_of(spark.read.schema(rows.schema).options(**options).parquet(workdir), absent)
    assert scanned_rows(read(bloom=True)) == 0
    assert 0 < scanned_rows(read(bloom=False, columnindex=False)) < 8_000
