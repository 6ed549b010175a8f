"""Relational operators: per-key picks, as-of look-up, daily build, lifecycle roll-up."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlife import schemas
from adlife.operators import daily as D
from adlife.operators import lifecycle as lc
from adlife.operators import records as R
from adlife.operators.asof import asof_lookup
from tests import fixtures as fx


def test_first_and_last_record(spark):
    daily = fx.daily_frame(spark)
    first = {r.finnkode: r.load_date for r in R.first_record(daily, "url").collect()}
    last = {r.finnkode: r.load_date for r in R.last_record(daily, "url").collect()}
    assert first[79021972] == "2016-07-15" and last[79021972] == "2016-07-18"
    sold = {r.finnkode: r.load_date for r in R.first_record(daily, "url", where=F.col("sold")).collect()}
    assert sold == {79021972: "2016-07-16"}


def test_latest_per_key_uses_tiebreak(spark):
    df = spark.createDataFrame([("d", "u", 5, 1, "a"), ("d", "u", 5, 2, "b"), ("d", "u", 4, 9, "c")],
                               "load_date string, url string, load_time long, seq long, v string")
    assert R.latest_per_key(df).first().v == "b"
    assert R.first_record(df, "url").first().v == "c"


def _brute_asof(probes, builds, inclusive):
    out = {}
    for pid, key, t in probes:
        best = None
        for bid, bkey, bt, v in builds:
            if bkey == key and (bt <= t if inclusive else bt < t):
                if best is None or (bt, bid) > (best[0], best[1]):
                    best = (bt, bid, v)
        out[pid] = best[2] if best else None
    return out


@settings(max_examples=12, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.booleans(), st.sampled_from([None, 1, 4, 40]))
def test_asof_matches_brute_force(spark, seed, inclusive, tasks):
    rnd = random.Random(seed)
    keys = ["a", "b", "c"]
    probes = [(i, rnd.choice(keys), rnd.randint(0, 120)) for i in range(40)]
    builds = [(i, rnd.choice(keys), rnd.randint(0, 120), f"v{i}") for i in range(60)]
    # one hot key with many rows, cut into segments when there are many tasks
    builds += [(100 + i, "a", rnd.randint(0, 120), f"h{i}") for i in range(80)]
    p = spark.createDataFrame(probes, "pid long, key string, t long")
    b = spark.createDataFrame(builds, "bid long, key string, bt long, v string")
    got = {r.pid: r.v for r in asof_lookup(p, b, "key", "t", "bt", ["v"], build_tiebreak="bid",
                                           inclusive=inclusive, segments=tasks is not None, tasks=tasks).collect()}
    assert got == _brute_asof(probes, builds, inclusive)


def test_a_hot_key_and_moment_spreads_over_the_tasks(spark):
    """One url holds a third of all rows, nearly all within one day: no task gets over twice the median."""
    from adlife.operators.asof import segment_of, timeline_segments
    rnd, tasks = random.Random(3), 24
    rows = [(f"u{rnd.randint(0, 4000)}", rnd.randint(0, 90 * 86_400_000)) for _ in range(40_000)]
    rows += [("hot", 40 * 86_400_000 + rnd.randint(0, 86_400_000)) for _ in range(20_000)] + [("hot", 5), ("hot", 89 * 86_400_000)]
    df = spark.createDataFrame(rows, "url string, t long")
    segments = timeline_segments([(df, "t")], "url", tasks)
    assert [r.url for r in segments.collect()] == ["hot"] and segments.first().bounds == sorted(set(segments.first().bounds))
    cut = df.join(F.broadcast(segments), "url", "left").withColumn("s", segment_of(F.col("t"), F.col("bounds")))
    in_order = cut.where("url = 'hot'").groupBy("s").agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy("s").collect()
    assert all(x.b < y.a for x, y in zip(in_order, in_order[1:])) and len(in_order) > tasks
    sizes = sorted(r[0] for r in cut.repartition(tasks, "url", "s").groupBy(F.spark_partition_id()).count().select("count").collect())
    assert len(sizes) == tasks and sizes[-1] <= 2 * sizes[tasks // 2]
    assert timeline_segments([(df.where("url <> 'hot'"), "t")], "url", tasks) is None
    assert timeline_segments([(df.limit(0), "t")], "url", tasks) is None


def test_segments_of_a_single_moment(spark):
    from adlife.operators.asof import asof_lookup, timeline_segments
    p = spark.createDataFrame([(i, "a", 7) for i in range(50)] + [(99, "b", 7)], "pid long, key string, t long")
    b = spark.createDataFrame([("a", 7, "x"), ("a", 6, "w"), ("b", 8, "y")], "key string, bt long, v string")
    assert timeline_segments([(p, "t")], "key", 10).count() == 1
    for inclusive, want in ((True, "x"), (False, "w")):
        got = {r.pid: r.v for r in asof_lookup(p, b, "key", "t", "bt", ["v"], inclusive=inclusive, tasks=10).collect()}
        assert got == {**{i: want for i in range(50)}, 99: None}


def test_asof_details_merge_picks_newest_live_details(spark):
    headers = fx.raw_header_frame(spark)
    details = fx.raw_details_frame(spark)
    merged = {(r.finnkode, r.load_time): r for r in D.merge_header_details(headers, details).collect()}
    third = merged[(78866263, 1451604800000)]
    # the deleted details row at the same time is skipped; raw text is copied (Q6)
    assert third.information == "First text, second version" and third.deleted is False
    assert third.properties == {"Salgsform": "Bruktbil til salgs", "Girkasse": "Automat", "Antall seter": "5"}
    assert merged[(-1, 1451604800000)].information == "Other text"       # 7-digit code -> -1


def test_last_known_price(spark):
    rows = [("u", "d1", 1, "t", "l", "2000", "1 km", "100 000,-"),
            ("u", "d1", 2, "t", "l", "2000", "1 km", "Ring oss"),
            ("u", "d2", 3, "t", "l", "2000", "1 km", "Solgt"),
            ("v", "d1", 1, "t", "l", "2000", "1 km", "90 000,-"),
            ("v", "d2", 5, "t", "l", "2000", "1 km", "Solgt"),
            ("w", "d2", 5, "t", "l", "2000", "1 km", "Solgt")]
    df = spark.createDataFrame(rows, "url string, load_date string, load_time long, title string, location string, year string, km string, price string")
    got = {(r.url, r.load_time): r.price_value for r in D.with_last_known_price(df, df).collect()}
    # newest unsold row before u's sale is unparsable -> -1 (no further look-back)
    assert got == {("u", 1): 100000, ("u", 2): -1, ("u", 3): -1, ("v", 1): 90000, ("v", 5): 90000, ("w", 5): -1}


def test_build_daily_from_raw_fixture(spark):
    daily = D.build_daily(fx.raw_header_frame(spark), fx.raw_details_frame(spark)).collect()
    by = {r.finnkode: r for r in daily}
    assert set(by) == {78866263, -1}
    vw = by[78866263]
    assert vw.price == 145000 and vw.deleted is True and vw.properties == {"NULL": "NULL"}
    assert vw.equipment == ["NULL"] and vw.information == "NULL"
    assert by[-1].information == "Other text" and by[-1].km == 10


def test_lifecycle_matches_reference_expectations(spark):
    out = {r.finnkode: r for r in lc.lifecycle_rollup(fx.daily_frame(spark), "2016-07-18", "2016-07-15").collect()}
    assert set(out) == set(fx.EXPECTED)
    for code, exp in fx.EXPECTED.items():
        r = out[code]
        got = (r.price_first, r.price_last, r.sold, r.sold_date, r.load_date_first, r.load_date_latest,
               r.automatgir, r.hengerfeste, r.skinninterior, r.drivstoff, r.sylindervolum, r.effekt,
               r.regnsensor, r.farge, r.cruisekontroll, r.parkeringsensor, r.antall_eiere, r.navigasjon,
               r.servicehefte, r.vekt)
        assert got == exp, code
        assert r.price_delta == r.price_last - r.price_first
        assert r.lead_time_sold == (1 if code == 79021972 else -1)
        assert (r.deleted_date, r.lead_time_deleted, r.kommune, r.fylke, r.last_updated) == \
            ("1900-01-01", -1, "NULL", "NULL", "1900-01-01")
        assert (r.sportsseter, r.tilstandsrapport, r.xenon) == (False, False, False)


def test_lifecycle_only_delta_urls_and_window(spark):
    daily = fx.daily_frame(spark)
    out = lc.lifecycle_rollup(daily, "2016-07-18", "2016-07-18").collect()
    assert {r.finnkode for r in out} == {79166971, 79021972, 79030138, 79154538, 79032583}
    volvo = [r for r in out if r.finnkode == 79021972][0]
    assert (volvo.price_first, volvo.load_date_first) == (23538, "2016-07-15")   # first over the window
    short = lc.lifecycle_rollup(daily, "2016-07-18", "2016-07-18", window_days=1).collect()
    volvo = [r for r in short if r.finnkode == 79021972][0]
    assert volvo.load_date_first == "2016-07-18"


def _daily_rows(spark, rows):
    from adlife import schemas
    full = [(u, d, 1, "t", "l", 2000, 1, price, {"Effekt": "1 Hk"}, ["x"], "i", sold, deleted, t)
            for u, d, t, price, sold, deleted in rows]
    return spark.createDataFrame(full, schemas.DAILY)


def test_quirks_price_delta_and_sold_date(spark):
    daily = _daily_rows(spark, [
        ("u", "2024-01-01", 1, -1, False, False),      # unparsable first price
        ("u", "2024-01-02", 2, 500, True, False),      # sold ...
        ("u", "2024-01-03", 3, 400, False, True),      # ... relisted unsold, then deleted
    ])
    r = lc.lifecycle_rollup(daily, "2024-01-03", "2024-01-03").first()
    assert (r.price_first, r.price_last, r.price_delta) == (-1, 400, 401)          # Q7: computed anyway
    assert (r.sold, r.sold_date, r.lead_time_sold) == (False, "2024-01-02", 1)     # Q8: first sale kept
    assert (r.deleted, r.deleted_date, r.lead_time_deleted) == (True, "2024-01-03", 2)


def test_two_phase_price_lookup_equals_whole_history(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        url = f"u{rnd.randint(0, 12)}"
        t = rnd.randint(0, 20 * 86_400_000)
        day = f"2024-01-{1 + t // 86_400_000:02d}"
        price = rnd.choice(["Solgt", "Solgt", "1 000,-", "2 500,-", "ukjent"])
        rows.append((url, day, t, "t", "l", "2000", "1 km", price, i))
    df = spark.createDataFrame(rows, "url string, load_date string, load_time long, title string, "
                                     "location string, year string, km string, price string, seq long")
    whole = {(r.seq, r.price_value) for r in D.with_last_known_price(df, df).collect()}
    for cut in ("2024-01-05", "2024-01-15", "2024-01-21"):
        late = F.col("load_date") >= cut
        split = {(r.seq, r.price_value) for r in D.with_last_known_price(
            df.where(late), df.where(late), older=D.newest_unsold(df.where(~late))).collect()}
        assert split == {(seq, v) for seq, v in whole if rows[seq][1] >= cut}, cut


def _random_days(seed: int, urls: int, days: list[str]):
    rnd, rows = random.Random(seed), []
    for u in range(urls):
        first = rnd.randrange(len(days))
        for k, d in enumerate(days[first:first + rnd.randint(1, len(days))]):
            if rnd.random() < 0.25:
                rows.append((f"u{u}", d, rnd.randint(1, 90) * 1000, rnd.random() < 0.04, rnd.random() < 0.03, (first + k) * 86_400_000 + rnd.randint(0, 9999)))
    return rows


def test_rollup_over_closed_months_equals_the_rollup_over_days(spark):
    from adlife.functions.dates import iso_shift
    from adlife.operators import lifecycle as lc
    days = [iso_shift("2023-03-10", k) for k in range(330)]
    rows = _random_days(4, 60, days)
    daily = spark.createDataFrame(rows, "url string, load_date string, price int, sold boolean, deleted boolean, load_time long").select(
        *[F.col(f.name) if f.name in ("url", "load_date", "price", "sold", "deleted", "load_time") else F.lit(None).cast(f.dataType).alias(f.name)
          for f in schemas.DAILY.fields]).cache()
    months = lc.month_partials(daily).cache()
    closed = sorted(r[0] for r in months.select("month").distinct().collect())
    for as_of, start in (("2024-01-20", "2024-01-01"), ("2023-12-31", "2023-12-20"), ("2023-05-02", "2023-05-02")):
        for window in (365, 200, 40, 3):
            want = sorted(map(str, lc.lifecycle_rollup(daily, as_of, start, window_days=window).collect()))
            got = sorted(map(str, lc.lifecycle_rollup(daily, as_of, start, window_days=window, months=months, closed=closed).collect()))
            assert got == want and (want or window == 3), (as_of, window)
    assert lc.day_ranges("2023-01-10", "2023-04-05", ["2023-02", "2023-03"]) == [("2023-01-10", "2023-01-31"), ("2023-04-01", "2023-04-05")]
    assert lc.day_ranges("2023-02-01", "2023-02-28", ["2023-02"]) == []
