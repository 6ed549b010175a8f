"""Hot-key check for the as-of look-up.

Derives from the driver's ``events`` a header history in which every 'view'
snapshot belongs to one listing (about a third of all header rows), then runs
the sold-price look-up with its timeline cut into segments and with a plain
per-key window, checks both give the same prices, and reports the largest
group one window task must sort (per key vs per key and segment) and the
wall time of each.

Usage: python scripts/skew_check.py [/root/testdata/sf0.1]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from adlife.operators.asof import segment_of, timeline_segments  # noqa: E402
from adlife.operators.daily import with_last_known_price  # noqa: E402
from adlife.plans import testbed as tb  # noqa: E402
from adlife.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    events = tb.read_table(spark, sf_dir, "events")
    hot = F.when(F.col("event_type") == "view", F.lit(0)).otherwise(F.col("user_id"))
    headers = tb.headers_from_events(events.withColumn("user_id", hot)).cache()
    total = headers.count()
    by_key = headers.groupBy("url").count().agg(F.max("count")).first()[0]
    segments = timeline_segments([(headers, "load_time")], "url")
    cut = headers.join(F.broadcast(segments), "url", "left")
    by_segment = cut.groupBy("url", segment_of(F.col("load_time"), F.col("bounds"))).count().agg(F.max("count")).first()[0]
    out = {"rows": total, "hot_key_rows": by_key, "largest_group_per_key": by_key,
           "largest_group_per_key_and_segment": by_segment}
    results = {}
    for label, parts in (("segments", segments), ("single_level", None)):
        df = with_last_known_price(headers, headers, segments=parts).select("seq", "price_value")
        df.write.format("noop").mode("overwrite").save()          # warm
        t0 = time.time()
        rows = {r.seq: r.price_value for r in df.collect()}
        out[f"sec_{label}"] = round(time.time() - t0, 2)
        results[label] = rows
    out["same_prices"] = results["segments"] == results["single_level"]
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
