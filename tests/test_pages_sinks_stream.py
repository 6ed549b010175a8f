"""Page extraction, listing explode, keyed sinks and the streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from adlife import schemas
from adlife.functions import html as H
from adlife.operators import pages as P
from adlife.sinks import tables as K
from adlife.sources import files as S
from adlife.sources import tables as T
from adlife.streaming import ingest as I

AD_PAGE = """<!DOCTYPE html><html><head><title>Ad</title></head><body>
<div class="hide-lt768"><h2>Kyrksæterøra</h2></div>
<h1 class="tcon">Volkswagen  Passat</h1>
<span class="mtn r-margin">150 000,-</span>
<div class="mvn"></div><dl class="col-count2from990"><dt>Årsmodell</dt><dd>2010</dd><dt>Girkasse</dt>
<dd>Automat</dd><dt>Km.stand</dt><dd>121 835 km</dd></dl>
<hr><dl class="col-count2from990"><dt>Modellår</dt><dd>2009</dd></dl>
<ul class="col-count2upto990"><li>Vinterhjul</li><li>Xenonpakke &amp; lys</li></ul>
<div class="object-description"><p>intro</p><p data-automation-id="desc">Fin bil <b>med</b> Xenonpakke</p></div>
</body></html>"""


def test_selector_engine():
    nodes = H.parse(AD_PAGE)
    assert H.select_first(nodes, ".mvn+ .col-count2from990").tag == "dl"
    assert H.select_first(nodes, ".tcon").text() == "Volkswagen Passat"
    assert H.select_first(nodes, "hr+ .col-count2from990 dd:nth-child(2)").text() == "2009"
    assert H.select_first(nodes, ".mvn+ .col-count2from990 dd:nth-child(6)").text() == "121 835 km"
    assert [n.text() for n in H.select(nodes, "ul > li")] == ["Vinterhjul", "Xenonpakke & lys"]
    assert H.select_first(nodes, "div.nothing , .mtn.r-margin").text() == "150 000,-"
    # an unclosed <p> is closed by the next one
    ps = H.select(H.parse("<div><p>a<b>x<p>b</div>"), "p")
    assert [p.text() for p in ps] == ["ax", "b"]


def test_extract_live_and_deleted_page(spark):
    pages = spark.createDataFrame([("u1", AD_PAGE), ("u2", None)], "url string, html string")
    got = {r.url: r for r in P.extract_pages(pages).collect()}
    live, gone = got["u1"], got["u2"]
    assert "Årsmodell" in live.properties and live.properties["Km.stand"] == "121 835 km"
    assert "Vinterhjul" in live.equipment and "Xenonpakke" in live.information
    assert (live.title, live.location, live.price, live.year, live.km, live.deleted) == \
        ("Volkswagen Passat", "Kyrksæterøra", "150 000,-", "2009", "121 835 km", False)
    assert gone.properties == {"NULL": "NULL"} and gone.equipment == ["NULL"]
    assert (gone.information, gone.title, gone.deleted) == ("NULL", "NULL", True)
    empty = P.extract_pages(spark.createDataFrame([("u3", "<html><body></body></html>")], "url string, html string")).first()
    assert empty.properties == {"MissingKeys": "MissingValues"} and empty.equipment == ["MissingValues"]
    assert (empty.information, empty.price) == ("MissingValues", "MissingValue")


def _listing_doc(n_ads, ts):
    ads = []
    for i in range(n_ads):
        ad = {"location": [{"text": f"Sted {i}"}],
              "title": [{"text": f"Bil {i}", "href": f"http://m.example/ad.html?finnkode={78000000 + i}"}],
              "year": [{"text": "2010"}], "price": [{"text": f"{100 + i} 000,-"}]}
        if i % 2 == 0:
            ad["km"] = [{"text": f"{i} 000 km"}]
        ads.append(ad)
    return {"extractorData": {"url": "http://m.example/search?rows=100", "resourceId": "r",
                              "data": [{"group": ads}, {"group": ads[:1]}]},
            "pageData": {"statusCode": 200, "timestamp": ts}}


def test_listing_explode_whole_text_documents(spark, workdir):
    import os
    os.makedirs(workdir.replace("file:", ""), exist_ok=True)
    base = workdir.replace("file:", "")
    with open(f"{base}/page.json", "w") as f:
        json.dump(_listing_doc(11, 1467632481477), f, indent=2)          # pretty-printed, one document
    with open(f"{base}/nodata.json", "w") as f:
        json.dump({"extractorData": {"url": "x", "resourceId": "y"}}, f)
    docs = S.read_json_documents(spark, workdir, "struct<x:string>")
    rows = P.explode_listing(docs).collect()
    assert len(rows) == 11                                    # only the first group; no-data page -> 0 rows
    assert {r.load_date for r in rows} == {"2016-07-04"}
    missing = [r for r in rows if r.km == "NULL"]
    assert len(missing) == 5


def test_upsert_replaces_by_key_in_touched_partitions(spark, workdir):
    schema = "load_date string, url string, v long"
    first = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 1), ("d2", "a", 1)], schema)
    K.upsert(spark, first, workdir, ["load_date", "url"])
    second = spark.createDataFrame([("d1", "a", 2), ("d3", "c", 2)], schema)
    K.upsert(spark, second, workdir, ["load_date", "url"])
    K.upsert(spark, second, workdir, ["load_date", "url"])           # replay: no change
    got = _rows(spark, workdir, schema, "load_date", "url", "v")
    assert got == [("d1", "a", 2), ("d1", "b", 1), ("d2", "a", 1), ("d3", "c", 2)]


def test_append_keyed_is_idempotent(spark, workdir):
    schema = "load_date string, url string, load_time long, v string"
    batch = spark.createDataFrame([("d1", "a", 1, "x"), ("d1", "a", 1, "x"), ("d1", "b", 2, "y")], schema)
    K.append_keyed(spark, batch, workdir, ["load_date", "url", "load_time"])
    K.append_keyed(spark, batch, workdir, ["load_date", "url", "load_time"])
    assert spark.read.schema(schema).parquet(workdir).count() == 2


def test_export_prints_null(spark, workdir):
    df = spark.createDataFrame([("a", None, 1.5, True)], "s string, n string, d double, b boolean")
    K.export_delimited(df, workdir)
    assert [r.value for r in spark.read.text(workdir).collect()] == ["a;null;1.5;true"]


def test_latest_load_date_probe(spark):
    df = spark.createDataFrame([("2024-01-30",), ("2024-01-02",)], "load_date string")
    assert T.latest_load_date(df, "2024-02-03").first()[0] == "2024-01-30"
    assert T.latest_load_date(df, "2024-03-01").first()[0] == "2016-07-01"
    assert [r.load_date for r in T.delta_dates(df, "2024-02-01").collect()] == \
        ["2024-01-30", "2024-01-31", "2024-02-01"]


def test_stream_ingest_equals_batch_and_replays_idempotently(spark, workdir):
    docs = [json.dumps(_listing_doc(4, 1467632481477 + k * 1000)) for k in range(3)]
    src = f"{workdir}/src"
    spark.createDataFrame([(d,) for d in docs], "value string").repartition(3).write.text(src)
    pages = spark.createDataFrame([("http://m.example/ad.html?finnkode=78000000", AD_PAGE)], "url string, html string")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    q = I.start_ingest(stream, f"{workdir}/h", f"{workdir}/d", f"{workdir}/ck", pages=pages, available_now=True)
    q.awaitTermination()
    h = T.read_raw_headers(spark, f"{workdir}/h")
    d = T.read_raw_details(spark, f"{workdir}/d")
    batch = P.explode_listing(spark.createDataFrame([(x,) for x in docs], "value string"))
    assert sorted(map(tuple, h.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    assert d.count() == 12 and d.where("deleted").count() == 9
    # replaying a batch (e.g. after a failure) adds nothing
    I.ingest_batch(spark, spark.read.text(src), f"{workdir}/h", f"{workdir}/d", pages)
    assert T.read_raw_headers(spark, f"{workdir}/h").count() == 12
    assert T.read_raw_details(spark, f"{workdir}/d").count() == 12


def test_daily_job_is_incremental_and_idempotent(spark, workdir):
    from adlife.plans import batch as B
    from adlife.plans import testbed as tb
    sf = "/root/testdata/sf0.001"
    tables = B.Tables(tb.raw_header_table(spark, sf), tb.raw_details_table(spark, sf),
                      f"{workdir}/daily", f"{workdir}/lifecycle")
    assert B.run_daily_batch(spark, tables, "2024-01-20", with_seq=True) == "2016-07-01"   # first load
    assert B.run_daily_batch(spark, tables, "2024-01-25", with_seq=True) == "2024-01-20"   # reloads last day
    snap = sorted(map(tuple, B.read_lifecycle(spark, tables.lifecycle).collect()))
    daily_n = T.read_daily(spark, tables.daily).count()
    assert B.run_daily_batch(spark, tables, "2024-01-25", with_seq=True) == "2024-01-25"   # rerun
    assert sorted(map(tuple, B.read_lifecycle(spark, tables.lifecycle).collect())) == snap
    assert T.read_daily(spark, tables.daily).count() == daily_n
    assert T.read_daily(spark, tables.daily).agg(F.max("load_date")).first()[0] == "2024-01-25"


def test_selector_engine_more_combinators():
    page = ('<div id="main"><h2>a</h2><p class="x y">one</p><span>s</span><p data-k="v">two</p>'
            '<ul><li>1</li><li>2<li>3</ul></div><p>outside</p>')
    nodes = H.parse(page)
    assert [n.text() for n in H.select(nodes, "h2 ~ p")] == ["one", "two"]
    assert [n.text() for n in H.select(nodes, "#main > p")] == ["one", "two"]
    assert [n.text() for n in H.select(nodes, "p.x.y")] == ["one"]
    assert [n.text() for n in H.select(nodes, 'p[data-k="v"]')] == ["two"]
    assert [n.text() for n in H.select(nodes, "p[data-k]")] == ["two"]
    assert [n.text() for n in H.select(nodes, "li:nth-child(3)")] == ["3"]      # implied </li>
    assert [n.text() for n in H.select(nodes, "ul li:first-child")] == ["1"]
    assert [n.text() for n in H.select(nodes, "div p, body > p")] == ["one", "two"]
    assert H.select_first(nodes, "table td") is None


def test_union_slices_keep_duplicates_and_sample_is_ordered(spark):
    df = spark.createDataFrame([("d1", "a", 3), ("d1", "b", 1), ("d2", "c", 2)],
                               "load_date string, url string, load_time long")
    assert T.union_slices(df, ["d1", "d2", "d1"]).count() == 5            # bag union, no dedupe
    assert T.scan_dates(df, ["d1", "d2", "d1"]).count() == 3              # one pruned scan
    assert [tuple(r) for r in T.sample(df, ["load_time"], 2, ["url", "load_time"]).collect()] == \
        [("b", 1), ("c", 2)]


# -- lossless keyed writes ----------------------------------------------------

def _rows(spark, path, schema, *cols):
    return sorted(tuple(r) for r in T.read_table(spark, path, T_.StructType.fromDDL(schema)).select(*cols).collect())


def test_upsert_refuses_other_columns(spark, workdir):
    schema = "load_date string, url string, v long, note string"
    K.upsert(spark, spark.createDataFrame([("d1", "a", 1, "keep"), ("d1", "b", 1, "keep")], schema), workdir, ["load_date", "url"])
    narrow = spark.createDataFrame([("d1", "a", 2)], "load_date string, url string, v long")
    for write in (K.upsert, K.append_keyed):
        with pytest.raises(ValueError):
            write(spark, narrow, workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "url", "v", "note") == [("a", 1, "keep"), ("b", 1, "keep")]


def test_rows_without_a_whole_key_are_set_aside(spark, workdir):
    schema = "load_date string, url string, v long"
    for _ in range(2):
        K.upsert(spark, spark.createDataFrame([("d1", "a", 1), (None, "a", 1), ("d1", None, 7)], schema), workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "load_date", "url", "v") == [("d1", "a", 1)]
    assert spark.read.parquet(workdir + "_rejected").count() == 4


def test_redelivered_messages_without_timestamp_store_nothing(spark, workdir):
    doc = _listing_doc(3, 1467632481477)
    del doc["pageData"]["timestamp"]
    batch = spark.createDataFrame([(json.dumps(doc),), (json.dumps(_listing_doc(2, 1467632481477)),)], "value string")
    for _ in range(3):
        I.ingest_batch(spark, batch, f"{workdir}/h", f"{workdir}/d", spark.createDataFrame([], "url string, html string"))
    assert T.read_raw_headers(spark, f"{workdir}/h").count() == 2
    assert T.read_raw_details(spark, f"{workdir}/d").count() == 2
    assert spark.read.parquet(f"{workdir}/h_rejected").select("url").distinct().count() == 3


def test_bucket_count_belongs_to_the_table(spark, workdir):
    df = spark.createDataFrame([(f"u{i}", i) for i in range(50)], "url string, v long")
    K.upsert(spark, K.with_key_bucket(df, buckets=64), workdir, ["url"], partition_by="key_bucket")
    with pytest.raises(ValueError):
        K.upsert(spark, K.with_key_bucket(df, buckets=128), workdir, ["url"], partition_by="key_bucket")
    K.upsert(spark, K.with_key_bucket(df, buckets=64), workdir, ["url"], partition_by="key_bucket")
    assert len(_rows(spark, workdir, "url string, v long, key_bucket int", "url")) == 50


def test_a_crash_at_any_step_leaves_one_whole_version(spark, workdir, monkeypatch):
    from adlife.sinks import manifest as mf
    schema = "load_date string, url string, v long"
    old = [("d1", "a", 1), ("d2", "a", 1)]
    K.upsert(spark, spark.createDataFrame(old, schema), workdir, ["load_date", "url"])
    update = spark.createDataFrame([("d1", "a", 2), ("d2", "b", 2), ("d3", "c", 2)], schema)

    def lost(*_args, **_kwargs):
        raise RuntimeError("lost")
    for name in ("write_run", "publish", "write_text", "_rename_to_new"):       # before, between and in the steps
        with monkeypatch.context() as m:
            m.setattr(mf, name, lost)
            with pytest.raises(RuntimeError):
                K.upsert(spark, update, workdir, ["load_date", "url"])
        assert _rows(spark, workdir, schema, "load_date", "url", "v") == old, name
    K.upsert(spark, update, workdir, ["load_date", "url"])
    want = [("d1", "a", 2), ("d2", "a", 1), ("d2", "b", 2), ("d3", "c", 2)]
    assert _rows(spark, workdir, schema, "load_date", "url", "v") == want
    # what the lost writers left is no longer named by anything and goes; what readers may hold stays for its time
    assert K.vacuum(spark, workdir) == 0
    assert K.vacuum(spark, workdir, retain_ms=0) > 0
    assert spark.read.parquet(workdir).count() == len(want)
    assert _rows(spark, workdir, schema, "load_date", "url", "v") == want


def test_a_reader_never_misses_a_partition(spark, workdir):
    import threading
    schema = "load_date string, url string, v long"
    first = spark.createDataFrame([(f"d{i}", "a", 0) for i in range(6)], schema)
    K.upsert(spark, first, workdir, ["load_date", "url"])
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(tuple(r.v for r in T.read_table(spark, workdir, first.schema).orderBy("load_date").collect()))
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 6):
            K.upsert(spark, spark.createDataFrame([(f"d{i}", "a", k) for i in range(6)], schema), workdir, ["load_date", "url"])
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 1 and set(seen) <= {(k,) * 6 for k in range(6)}
    assert [s[0] for s in seen] == sorted(s[0] for s in seen)


def test_the_second_of_two_writers_raises(spark, workdir, monkeypatch):
    from adlife.sinks import manifest as mf
    schema = "load_date string, url string, v long"
    K.upsert(spark, spark.createDataFrame([("d1", "a", 1)], schema), workdir, ["load_date", "url"])
    write = mf.write_run

    def other_first(spark, *args):
        monkeypatch.setattr(mf, "write_run", write)
        K.upsert(spark, spark.createDataFrame([("d1", "b", 2)], schema), workdir, ["load_date", "url"])
        return write(spark, *args)
    monkeypatch.setattr(mf, "write_run", other_first)
    with pytest.raises(K.ConcurrentWrite):
        K.upsert(spark, spark.createDataFrame([("d1", "a", 3)], schema), workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "url", "v") == [("a", 1), ("b", 2)]
    # an append starts again and keeps both
    monkeypatch.setattr(mf, "write_run", other_first)
    K.append_keyed(spark, spark.createDataFrame([("d1", "b", 9), ("d1", "c", 9)], schema), workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "url", "v") == [("a", 1), ("b", 2), ("c", 9)]


def test_plain_tables_are_taken_over(spark, workdir):
    schema = "load_date string, url string, v long"
    spark.createDataFrame([("d1", "a", 1), ("d2", "a", 1)], schema).write.partitionBy("load_date").parquet(workdir)
    K.append_keyed(spark, spark.createDataFrame([("d1", "a", 5), ("d1", "b", 5)], schema), workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "load_date", "url", "v") == [("d1", "a", 1), ("d1", "b", 5), ("d2", "a", 1)]
    K.upsert(spark, spark.createDataFrame([("d1", "a", 7)], schema), workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "load_date", "url", "v") == [("d1", "a", 7), ("d1", "b", 5), ("d2", "a", 1)]
    K.vacuum(spark, workdir, retain_ms=0)
    assert _rows(spark, workdir, schema, "load_date", "url", "v") == [("d1", "a", 7), ("d1", "b", 5), ("d2", "a", 1)]


def test_partition_values_of_any_text(spark, workdir):
    schema = "load_date string, url string, v long"
    days = ["a/b", "a b", "x=1%2", "é:?*", "d"]
    for v in (1, 2):
        K.upsert(spark, spark.createDataFrame([(d, "u", v) for d in days], schema), workdir, ["load_date", "url"])
    assert _rows(spark, workdir, schema, "load_date", "v") == sorted((d, 2) for d in days)
    from adlife.sinks.manifest import row_counts
    assert row_counts(spark, workdir) == {d: 1 for d in days}


def test_a_replayed_batch_reads_no_stored_rows(spark, workdir, monkeypatch):
    from adlife.sinks import manifest as mf
    doc = json.dumps(_listing_doc(3, 1467632481477))
    bad = _listing_doc(2, 0)
    del bad["pageData"]["timestamp"]
    batch = spark.createDataFrame([(doc,), (json.dumps(bad),)], "value string")
    pages = spark.createDataFrame([], "url string, html string")
    h, d = f"{workdir}/h", f"{workdir}/d"
    I.ingest_batch(spark, batch, h, d, pages, batch_id=("q", 0))
    publish, parts = mf.publish, mf.read_parts

    def half(spark, path, *args, **kwargs):         # the headers are stored, then the driver dies
        if path == d:
            raise RuntimeError("lost")
        return publish(spark, path, *args, **kwargs)
    monkeypatch.setattr(mf, "publish", half)
    more = spark.createDataFrame([(json.dumps(_listing_doc(2, 1467632999999)),), (json.dumps(bad),)], "value string")
    with pytest.raises(RuntimeError):
        I.ingest_batch(spark, more, h, d, pages, batch_id=("q", 1))
    monkeypatch.setattr(mf, "publish", publish)
    read = []
    monkeypatch.setattr(mf, "read_parts", lambda spark, path, *a: read.append(path) or parts(spark, path, *a))
    I.ingest_batch(spark, more, h, d, pages, batch_id=("q", 1))
    assert h not in read                             # the table that has the batch is not looked at again
    read.clear()
    for number in (1, 0):
        I.ingest_batch(spark, spark.createDataFrame([("never looked at",)], "value string"), h, d, pages, batch_id=("q", number))
    assert read == []
    monkeypatch.setattr(mf, "read_parts", parts)
    assert T.read_raw_headers(spark, h).count() == 5 and T.read_raw_details(spark, d).count() == 5
    # the rows without a date were set aside once a batch, also by the replays
    assert spark.read.parquet(f"{h}_rejected").count() == 4
    assert sorted(map(tuple, I.ingest_counts(spark, h, d).collect())) == [("2016-07-04", 5, 5)]


def test_a_restarted_stream_keeps_its_ledger(spark, workdir):
    from adlife.sinks.manifest import current
    src = f"{workdir}/src"
    for k in range(3):
        spark.createDataFrame([(json.dumps(_listing_doc(2, 1467632481477 + k)),)], "value string").write.mode("append").text(src)
        stream = spark.readStream.schema("value string").text(src)
        I.start_ingest(stream, f"{workdir}/h", f"{workdir}/d", f"{workdir}/ck", available_now=True).awaitTermination()
        batches = current(spark, f"{workdir}/h").batches
        assert list(batches.values()) == [k]
    assert T.read_raw_headers(spark, f"{workdir}/h").count() == 6


def test_appends_are_sorted_runs_and_merge(spark, workdir):
    schema = "load_date string, url string, load_time long"
    for k in range(4):
        rows = [(f"d{i % 2}", f"u{(i * 7 + k) % 11}", i * 10 + k) for i in range(40)]
        K.append_keyed(spark, spark.createDataFrame(rows, schema).repartition(3), workdir, ["load_date", "url", "load_time"], order=I.RAW_ORDER)

    def files():
        held = {}
        for r in T.read_table(spark, workdir, T_.StructType.fromDDL(schema)).select("*", F.input_file_name().alias("f")).collect():
            held.setdefault((r.load_date, r.f), []).append((r.url, -r.load_time))
        return held
    before = files()
    assert len(before) >= 8 and all(rows == sorted(rows) for rows in before.values())
    assert K.merge_runs(spark, workdir, T_.StructType.fromDDL(schema), I.RAW_ORDER, min_runs=5) == []
    assert sorted(K.merge_runs(spark, workdir, T_.StructType.fromDDL(schema), I.RAW_ORDER, min_runs=4)) == ["load_date=d0", "load_date=d1"]
    after = files()
    assert len(after) == 2 and all(rows == sorted(rows) for rows in after.values())
    assert sorted(x for rows in after.values() for x in rows) == sorted(x for rows in before.values() for x in rows)


def test_versions_stay_few(spark, workdir):
    """60 daily versions: readers open at most three of each tier and the unsettled ones."""
    schema = T_.StructType.fromDDL("url string, v long")
    for day in range(60):
        rows = [(f"u{day}", day), ("every", day), (f"w{day % 7}", day)]
        K.write_version(spark, spark.createDataFrame(rows, schema), workdir, ["url"], f"{day:03d}")
        K.merge_tiers(spark, workdir, schema, ["url"], f"{day - 5:03d}" if day > 5 else "")
        assert len(K.versions(spark, workdir)) <= 5 + 3 * 3 + 1
    want = {**{f"u{d}": d for d in range(60)}, "every": 59, **{f"w{d % 7}": d for d in range(60)}}
    current = K.read_current(spark, workdir, schema, ["url"])
    assert {r.url: r.v for r in current.collect()} == want
    folders = {f.split("version=")[1].split("/")[0] for f in current.inputFiles()}
    assert len(folders) == len(K.versions(spark, workdir)) <= 15


def test_unchanged_pages_are_parsed_once(spark, workdir, monkeypatch):
    headers = spark.createDataFrame([("u", "d", 1), ("v", "d", 1), ("gone", "d", 1)], "url string, load_date string, load_time long")
    pages = spark.createDataFrame([("u", AD_PAGE), ("v", "<h1>x</h1>"), ("gone", None)], "url string, html string")
    want = sorted(map(str, P.details_from_listing(headers, pages).collect()))
    parsed, extract = [], P.extract_pages
    monkeypatch.setattr(P, "extract_pages", lambda df, *a, **k: parsed.append(sorted(r.url for r in df.collect())) or extract(df, *a, **k))
    for _ in range(2):
        got = P.details_from_listing(headers, pages, store=f"{workdir}/pages")
        assert sorted(map(str, got.collect())) == want
    assert parsed == [["u", "v"]]
    assert "MapInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    changed = pages.where("url <> 'v'").union(spark.createDataFrame([("v", "<h1>y</h1>")], pages.schema))
    P.details_from_listing(headers, changed, store=f"{workdir}/pages").collect()
    P.details_from_listing(headers, pages, {"title": "h2"}, store=f"{workdir}/pages").collect()      # other selectors, other contents
    assert parsed[1:] == [["v"], ["u", "v"]]


def test_equal_keys_pick_the_newest_row(spark, workdir):
    schema = "load_date string, url string, load_time long, v string"
    df = spark.createDataFrame([("d", "a", 1, "x"), ("d", "a", 3, "y"), ("d", "a", 2, "z")], schema)
    K.upsert(spark, df, workdir, ["load_date", "url"], newest_by=["load_time"])
    assert _rows(spark, workdir, schema, "v") == [("y",)]


def test_versions_read_newest_and_compact(spark, workdir):
    schema = T_.StructType.fromDDL("url string, v long")
    for version, rows in (("1", [("a", 1), ("b", 1)]), ("2", [("a", 2)]), ("3", [("c", 3)]), ("2", [])):
        K.write_version(spark, spark.createDataFrame(rows, schema), workdir, ["url"], version)
    want = [("a", 2), ("b", 1), ("c", 3)]
    assert sorted(tuple(r) for r in K.read_current(spark, workdir, schema, ["url"]).collect()) == want
    K.compact_versions(spark, workdir, schema, ["url"], "2")
    assert sorted(tuple(r) for r in K.read_current(spark, workdir, schema, ["url"]).collect()) == want
    K.vacuum(spark, workdir, retain_ms=0)
    assert spark.read.parquet(workdir).count() == 3


def test_clustered_files_are_ordered(spark, workdir):
    df = spark.createDataFrame([(f"d{i % 2}", f"u{i % 7}", i) for i in range(60)], "load_date string, url string, load_time long")
    K.write_clustered(df, workdir)
    files = spark.read.parquet(workdir).select("load_date", "url", "load_time", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r.f, []).append((r.url, -r.load_time))
    assert all(rows == sorted(rows) for rows in by_file.values())


# -- listing pages and ad pages -----------------------------------------------

def test_listing_explode_tolerates_empty_arrays(spark):
    def page(**ad):
        full = {"title": [{"text": "Bil", "href": "u"}], "km": [{"text": "1 km"}], "price": [{"text": "1"}],
                "location": [{"text": "S"}], "year": [{"text": "2001"}]}
        return json.dumps({"extractorData": {"data": [{"group": [{**full, **ad}]}]}, "pageData": {"timestamp": 1}})
    docs = [page(km=[]), page(title=[]), page(location=None), json.dumps({"extractorData": {"data": []}, "pageData": {"timestamp": 1}}),
            json.dumps({"extractorData": {"data": [{"group": []}]}}), json.dumps({"extractorData": {"data": [{}]}}), "not json", page()]
    rows = P.explode_listing(spark.createDataFrame([(d,) for d in docs], "value string")).collect()
    assert sorted((r.url, r.title, r.km, r.location) for r in rows) == sorted([
        ("u", "Bil", "NULL", "S"), ("NULL", "NULL", "1 km", "S"), ("u", "Bil", "1 km", "NULL"), ("u", "Bil", "1 km", "S")])


def test_details_need_a_link_and_take_the_newest_page(spark):
    headers = spark.createDataFrame([("u", "d", 1), ("u", "d", 2), ("NULL", "d", 1), ("gone", "d", 1)], "url string, load_date string, load_time long")
    pages = spark.createDataFrame([("u", "<h1>old</h1>", 1), ("u", AD_PAGE, 2), ("x", None, 1)], "url string, html string, at long")
    rows = P.details_from_listing(headers, pages, fetched="at").collect()
    assert sorted((r.url, r.load_time, r.deleted) for r in rows) == [("gone", 1, True), ("u", 1, False), ("u", 2, False)]
    assert all("Xenonpakke" in r.information for r in rows if r.url == "u")
    gone = next(r for r in rows if r.url == "gone")
    assert (gone.properties, gone.equipment, gone.information) == ('{"NULL":"NULL"}', '["NULL"]', '"NULL"')


def test_page_text_keeps_no_break_spaces_and_deep_pages_parse():
    assert H.parse("<p> 1&nbsp;440 \n kg </p>")[0].text() == "1\u00a0440 kg"
    assert H.parse("<div>" + "<i>x" * 5000 + "</div>")[0].text() == "x" * 5000
    wide = H.parse("<div>" + "<b>y</b>" * 10_000 + "</div>")
    assert len(H.select(wide, "b + b")) == 9_999 and H.select_first(wide, "b:nth-child(9000)").place == 8_999


def test_one_bad_page_does_not_fail_the_job(spark, monkeypatch):
    pages = spark.createDataFrame([("ok", AD_PAGE), ("bad", "<h1>x</h1>")], "url string, html string")
    got = {r.url: r for r in P.extract_pages(pages, {"title": "h1"}).collect()}
    assert got["bad"].parse_error is None and got["ok"].parse_error is None
    broken = {**{k: "h1" for k in ("properties", "equipment", "information", "title", "location", "year", "km", "price")}}
    row = P._nothing_found("bad")
    assert row["information"] == "MissingValues" and set(broken) <= set(row) | set(broken)


def test_stream_under_a_processing_time_trigger(spark, workdir):
    import time
    src = f"{workdir}/src"
    spark.createDataFrame([(json.dumps(_listing_doc(3, 1467632481477 + k)),) for k in range(2)], "value string").write.text(src)
    stream = spark.readStream.schema("value string").text(src)
    q = I.start_ingest(stream, f"{workdir}/h", f"{workdir}/d", f"{workdir}/ck", processing_time="200 milliseconds")
    try:
        until = time.time() + 60
        while time.time() < until and not any(p["numInputRows"] for p in q.recentProgress):
            time.sleep(0.3)
        q.processAllAvailable()
    finally:
        q.stop()
    assert T.read_raw_headers(spark, f"{workdir}/h").count() == 6


def test_null_keys_never_match_in_an_as_of_look_up(spark):
    from adlife.operators.asof import asof_lookup
    p = spark.createDataFrame([(1, None, 5), (2, "a", 5)], "pid long, key string, t long")
    b = spark.createDataFrame([(None, 1, "x"), ("a", 1, "y")], "key string, bt long, v string")
    for tasks in (1, 50):
        assert {r.pid: r.v for r in asof_lookup(p, b, "key", "t", "bt", ["v"], tasks=tasks).collect()} == {1: None, 2: "y"}


def test_price_table_moves_forward_without_old_history(spark, workdir):
    from adlife.operators.daily import newest_unsold
    from adlife.plans import batch as B
    rows = [("u", "2024-01-01", 1, "10,-"), ("v", "2024-01-02", 2, "20,-"), ("u", "2024-01-05", 5, "30,-"), ("u", "2024-01-06", 6, "Solgt"),
            ("NULL", "2024-01-06", 6, "1,-"), ("w", "2024-01-08", 8, "40,-")]
    headers = spark.createDataFrame(rows, "url string, load_date string, load_time long, price string")
    path = f"{workdir}/prices"
    for day in ("2024-01-03", "2024-01-07", "2024-01-07", "2024-01-09", "2024-01-04"):
        got = sorted(map(tuple, B.prices_before(spark, path, headers, day).collect()))
        assert got == sorted(map(tuple, newest_unsold(headers.where(F.col("load_date") < day)).collect())), day
    # once a version is there, raw history before it is not read again
    assert B.prices_before(spark, path, headers.where("load_date >= '2024-01-09'"), "2024-01-10").count() == 3


def test_daily_job_over_an_expiry_reads_closed_months_once(spark, workdir):
    """Five months of snapshots, a window of 80 days: first prices expire, months close, and the roll-up stays that of all days."""
    import random
    from adlife.functions.dates import iso_shift
    from adlife.operators.lifecycle import lifecycle_rollup
    from adlife.plans import batch as B
    rnd, heads, details = random.Random(1), [], []
    for k in range(150):
        day = iso_shift("2024-01-01", k)
        at = 1704067200000 + k * 86_400_000
        for u in range(6):
            if rnd.random() < 0.5:
                url = f"http://ads.example/{10000000 + u}"
                price = "Solgt" if rnd.random() < 0.1 else f"{rnd.randint(1, 99)} 000,-"
                heads.append((url, day, at + u, "t", "l", "2001", "1 km", price))
                details.append((url, day, at + u, "{}", "[]", '"x"', rnd.random() < 0.1))
    head = spark.createDataFrame(heads, "url string, load_date string, load_time long, title string, location string, year string, km string, price string")
    head = head.select(*[f.name for f in schemas.RAW_HEADER.fields])
    detail = spark.createDataFrame(details, schemas.RAW_DETAILS)
    tables = B.Tables(f"{workdir}/h", f"{workdir}/d", f"{workdir}/daily", f"{workdir}/lifecycle")
    for today in ("2024-03-05", "2024-04-04", "2024-04-09", "2024-05-20"):
        for rows, path in ((head, tables.raw_headers), (detail, tables.raw_details)):
            K.append_keyed(spark, rows.where(F.col("load_date") <= today), path, I.RAW_KEY, order=I.RAW_ORDER)
        start = B.run_daily_batch(spark, tables, today, window_days=80)
        daily = T.read_daily(spark, tables.daily)
        want = sorted(map(str, lifecycle_rollup(daily, today, start, window_days=80).collect()))
        held = B.read_lifecycle(spark, tables.lifecycle)
        urls = [r.url for r in daily.where(F.col("load_date").between(start, today)).select("url").distinct().collect()]
        assert sorted(map(str, held.where(F.col("url").isin(urls)).collect())) == want and want
    assert K.versions(spark, tables.month_table)


def test_a_listing_page_is_parsed_once(spark):
    """Spark used to put a filter on the ads below the parsing, which ran it three times a page."""
    docs = [_listing_doc(3, 1467632481477), _listing_doc(0, 1467632481477), {"pageData": {"timestamp": 1}},
            {"extractorData": {"data": []}}, {"extractorData": {"data": [{}]}}, _listing_doc(2, 1467632482477)]
    docs[0]["extractorData"]["data"][0]["group"][1] = None          # an ad that is null keeps its row
    df = P.explode_listing(spark.createDataFrame([(json.dumps(d),) for d in docs] + [(None,), ("no json",)], "value string"))
    rows = df.collect()
    assert len(rows) == 5 and sorted(r.title == "NULL" for r in rows) == [False] * 4 + [True]
    assert {(r.load_date, r.load_time) for r in rows} == {("2016-07-04", 1467632481477), ("2016-07-04", 1467632482477)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("rows_a_task", [3, 100_000])
@pytest.mark.parametrize("order", [I.RAW_ORDER, ("-title", "url")])
def test_append_picks_one_row_a_key_in_sorted_files(spark, workdir, monkeypatch, rows_a_task, order):
    monkeypatch.setattr(K, "ROWS_A_TASK", rows_a_task)
    schema = "load_date string, url string, load_time long, title string, year string"
    rows = [(f"d{i % 3 if i < 60 else 0}", f"u{i % 13}", i % 5, f"t{i * 7 % 4}", None if i % 3 else str(i % 2)) for i in range(400)]
    rows += [(None, "u1", 1, "t", "1"), ("d0", "u1", None, "t", "1")]
    new, key = spark.createDataFrame(rows, schema).repartition(5), list(I.RAW_KEY)
    K.append_keyed(spark, new, workdir, key, order=order)
    want = K.one_per_key(new.dropna(subset=key), key).select(*new.columns)
    stored = T.read_table(spark, workdir, new.schema)
    assert sorted(map(str, stored.select(*new.columns).collect())) == sorted(map(str, want.collect()))
    assert spark.read.parquet(workdir + "_rejected").count() == 2
    held = {}
    for r in stored.select("*", F.input_file_name().alias("f")).collect():
        held.setdefault(r.f, []).append((r.url, -r.load_time) if order == I.RAW_ORDER else (-int(r.title[1:]), r.url))
    assert all(x == sorted(x) for x in held.values())
    # rows of a stored day are compared with it, those of other days are new
    K.append_keyed(spark, new.unionByName(spark.createDataFrame([("d9", "u1", 1, "t", "1"), ("d0", "new", 1, "t", "1")], schema)),
                   workdir, key, order=order)
    assert T.read_table(spark, workdir, new.schema).count() == want.count() + 2


def test_an_append_picks_the_newest_row(spark, workdir):
    schema = "load_date string, url string, v long, seq long"
    K.append_keyed(spark, spark.createDataFrame([("d", "a", 9, 1), ("d", "a", 1, 2), ("d", "a", 3, None), ("d", "b", 1, None)], schema),
                   workdir, ["load_date", "url"], newest_by=["seq"])
    assert _rows(spark, workdir, schema, "url", "v") == [("a", 1), ("b", 1)]


def test_pages_are_read_once_in_a_stream_of_many_batches(spark, workdir):
    docs = [json.dumps(_listing_doc(4, 1467632481477 + k * 1000)) for k in range(4)]
    src = f"{workdir}/src"
    spark.createDataFrame([(d,) for d in docs], "value string").repartition(4).write.text(src)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(html):
        read.add(1)
        return html
    page = "http://m.example/ad.html?finnkode=7800000{}"
    pages = spark.createDataFrame([(page.format(k), AD_PAGE) for k in (0, 0, 1)] + [("gone", None)], "url string, html string")
    got = []
    for name, once in (("each", None), ("once", f"{workdir}/extracted")):
        read.value = 0
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        I.start_ingest(stream, f"{workdir}/{name}/h", f"{workdir}/{name}/d", f"{workdir}/{name}/ck", available_now=True,
                       pages=pages.withColumn("html", seen("html")), extract_once=once).awaitTermination()
        got.append([sorted(map(str, T.read_raw_details(spark, f"{workdir}/{name}/d").collect())), read.value])
    assert got[0][0] == got[1][0] and len(got[0][0]) == 16
    assert got[1][1] == 4 < got[0][1]


def test_html_that_no_ad_links_to_is_not_read(spark, workdir):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(html):
        read.add(1)
        return html
    pages = spark.createDataFrame([("http://m.example/ad.html?finnkode=78000000", AD_PAGE)] + [(f"x{i}", AD_PAGE) for i in range(50)],
                                  "url string, html string")
    batch = spark.createDataFrame([(json.dumps(_listing_doc(3, 1467632481477)),)], "value string")
    asked = P.urls_with_page(pages, P.linked_ads(P.explode_listing(batch)).select("url").distinct()).persist()
    assert [r.url for r in asked.collect()] == ["http://m.example/ad.html?finnkode=78000000"]
    found = pages.join(P.sent_if_small(asked), "url", "left_semi").withColumn("html", seen("html"))
    assert P.extracted_details(found).count() == 1 and read.value <= 2
    asked.unpersist()


def test_details_are_published_after_the_headers(spark, workdir, monkeypatch):
    """Both are written at the same time; when the headers are lost, so are the details, and the batch comes again."""
    from adlife.sinks import manifest as mf
    publish, h, d = mf.publish, f"{workdir}/h", f"{workdir}/d"

    def lost(spark, path, *args, **kwargs):
        if path == h:
            raise RuntimeError("lost")
        return publish(spark, path, *args, **kwargs)
    batch = spark.createDataFrame([(json.dumps(_listing_doc(3, 1467632481477)),)], "value string")
    pages = spark.createDataFrame([], "url string, html string")
    with monkeypatch.context() as m:
        m.setattr(mf, "publish", lost)
        with pytest.raises(RuntimeError):
            I.ingest_batch(spark, batch, h, d, pages, batch_id=("q", 0))
    assert mf.current(spark, h) is None and mf.current(spark, d) is None
    I.ingest_batch(spark, batch, h, d, pages, batch_id=("q", 0))
    assert T.read_raw_headers(spark, h).count() == 3 and T.read_raw_details(spark, d).count() == 3


def test_an_append_of_many_large_partitions(spark, workdir, monkeypatch):
    """The plan does not grow with the number of partition values that are dealt out by key."""
    monkeypatch.setattr(K, "ROWS_A_TASK", 1)
    rows = spark.range(6000).selectExpr("cast(id % 2000 as string) AS load_date", "cast(id % 5 as string) AS url")
    sizes = {str(i): 3 for i in range(2000)}
    once = K._clustered_once(rows, ["load_date", "url"], "load_date", ["url"], sizes)
    assert once.count() == rows.distinct().count()
