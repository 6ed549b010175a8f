"""adlife: listing snapshots -> daily rows -> lifecycle rows, on Spark.

Main entry points (all take and return DataFrames unless noted):

* ``operators.daily.build_daily`` / ``merge_header_details`` / ``with_last_known_price``
* ``operators.lifecycle.lifecycle_rollup`` / ``event_dates``
* ``operators.asof.asof_lookup`` — skew-safe left as-of look-up
* ``operators.records.latest_per_key`` / ``first_record`` / ``last_record``
* ``operators.pages.explode_listing`` / ``extract_pages`` / ``details_from_listing``
* ``sources.tables`` — pruned scans, ``latest_load_date``, ``delta_dates``
* ``sinks.tables`` — ``append_keyed``, ``upsert``, ``write_version``, ``read_current``, ``export_delimited``, ``write_clustered``
* ``streaming.ingest.start_ingest`` — Structured Streaming ingest (returns a StreamingQuery)
* ``plans.batch.run_daily_batch`` — the incremental daily job
"""

__version__ = "0.1.0"
