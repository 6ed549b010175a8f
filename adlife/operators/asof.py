"""Left as-of lookup: for every probe row, the newest build row of the same key
whose time is at or before the probe's.

PySpark has no as-of join. Probe and build rows are unioned and a running
``last(..., ignorenulls=True)`` in time order picks the match: one shuffle of the
rows, no join, nothing collected.

A plain window per key would send a hot key's whole history to one task. So
:func:`timeline_segments` looks first, in one narrow pass (key and time, counted
map-side), for keys that hold more rows than a task's fair share; there are fewer
of them than tasks. The timeline of such a key is cut at quantiles of its times,
wherever its rows are dense, into pieces of a fraction of a fair share. The window then
runs per (key, segment), and a segment starts with the newest match of the ones before
it: one row per segment, found by a map-side combined aggregation of the hot keys' build
rows. Keys that are not hot keep one segment and cost nothing more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Segments of a hot key per fair share of a task: small pieces spread evenly by hash.
PIECES = 8


def _whole(keys: Sequence[str]) -> Column:
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return whole


def timeline_segments(frames: Sequence[tuple[DataFrame, str]], on: str | Sequence[str],
                      tasks: int | None = None) -> DataFrame | None:
    """(keys, ``bounds``): the times that cut the timelines of hot keys, or None when no key is hot.

    ``frames``: the (frame, time column) whose rows are to be looked up. A key is hot if it holds more than
    1 / ``tasks`` of all rows (default: the session's shuffle partitions). The result has fewer rows than
    ``tasks`` and at most ``PIECES * tasks`` bounds in all, whatever the data, so it may be broadcast.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spark = frames[0][0].sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = None
    for df, time in frames:
        part = df.where(_whole(keys)).select(*keys, F.col(time).cast("long").alias("__t"))
        rows = part if rows is None else rows.unionByName(part)
    seen = Observation()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).observe(seen, F.sum("__n").alias("total"))
    top = counts.orderBy(F.desc("__n")).limit(tasks).collect()
    total = seen.get["total"] or 0
    hot = [(*[r[k] for k in keys], -(-r["__n"] * tasks * PIECES // total)) for r in top if r["__n"] * tasks > total]
    if not hot:
        return None
    key_fields = [T.StructField(k, rows.schema[k].dataType) for k in keys]
    pieces = spark.createDataFrame(hot, T.StructType([*key_fields, T.StructField("__pieces", T.LongType())]))
    grid = max(h[-1] for h in hot)
    quantiles = F.percentile_approx("__t", [i / grid for i in range(1, grid)] or [0.5], max(10_000, 4 * grid))
    cuts = (rows.join(F.broadcast(pieces), keys).groupBy(*keys, "__pieces").agg(quantiles.alias("__q"))
            .select(*keys, F.array_distinct(F.transform(
                F.sequence(F.lit(1), F.greatest(F.col("__pieces") - 1, F.lit(1))),
                lambda i: F.get("__q", F.floor(i * grid / F.col("__pieces")).cast("int") - 1))).alias("bounds")))
    found = [(*[r[k] for k in keys], sorted(b for b in r["bounds"] if b is not None)) for r in cuts.collect()]
    return spark.createDataFrame(found, T.StructType([*key_fields, T.StructField("bounds", T.ArrayType(T.LongType()))]))


def segment_of(time: Column, bounds: Column) -> Column:
    """How many bounds lie before ``time`` (0 without bounds): rows of one time share a segment.

    Two steps over about the square root of the bounds each, not over all of them.
    """
    step = F.ceil(F.sqrt(F.size(bounds))).cast("int")
    rough = F.size(F.filter(F.sequence(step, F.size(bounds), step), lambda i: F.get(bounds, (i - 1).cast("int")) < time)) * step
    near = F.size(F.filter(F.slice(bounds, rough + 1, step), lambda b: b < time))
    return F.when(F.size(bounds) > 0, rough + near).otherwise(0)


def asof_lookup(
    probe: DataFrame,
    build: DataFrame,
    on: str | Sequence[str],
    probe_time: str,
    build_time: str,
    values: Sequence[str] | Mapping[str, str],
    *,
    build_tiebreak: str | None = None,
    inclusive: bool = True,
    segments: DataFrame | None | bool = True,
    tasks: int | None = None,
    matched_col: str | None = None,
) -> DataFrame:
    """Return ``probe`` with the ``values`` columns of its as-of build row.

    ``values`` is a list of build columns or a mapping ``{output_name: build_column}``.
    Build rows with ``build_time <= probe_time`` qualify (``<`` when ``inclusive``
    is false); among them the newest by ``(build_time, build_tiebreak)`` wins.
    Probes without a match, or with a null key, get nulls (and ``matched_col`` false).

    ``segments``: what :func:`timeline_segments` gave for these rows (a caller that looks up twice computes
    it once); True finds them here, None or False takes every key for small. It decides only where rows
    go, never the result. ``tasks`` is passed on.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not isinstance(values, Mapping):
        values = {c: c for c in values}
    probe_cols = list(probe.columns)
    build_side, probe_side = (0, 1) if inclusive else (1, 0)
    if segments is True:
        segments = timeline_segments([(probe, probe_time), (build, build_time)], keys, tasks)

    build = build.where(_whole(keys))      # a null key matches nothing
    p = probe.select(*keys, F.col(probe_time).cast("long").alias("__t"),
                     F.struct(*probe_cols).alias("__p"),
                     F.lit(probe_side).alias("__side"))
    tb = F.col(build_tiebreak).cast("long") if build_tiebreak else F.lit(0).cast("long")
    b = build.select(*keys, F.col(build_time).cast("long").alias("__t"), tb.alias("__tb"),
                     F.struct(*[F.col(src).alias(dst) for dst, src in values.items()]).alias("__v"),
                     F.lit(build_side).alias("__side"))
    rows = p.unionByName(b, allowMissingColumns=True)

    parts = list(keys)
    if segments is not None and segments is not False:
        parts.append("__s")
        cut = segments.select(*keys, F.col("bounds").alias("__b"))
        at = segment_of(F.col("__t"), F.col("__b")).alias("__s")
        rows = rows.join(F.broadcast(cut), keys, "left").select(*keys, "__t", "__p", "__side", "__tb", "__v", at)
        last = (b.join(F.broadcast(cut), keys).select(*keys, at, "__t", "__tb", "__v").groupBy(*keys, "__s")
                .agg(F.max_by("__v", F.struct("__t", "__tb")).alias("__v")))
        every = cut.select(*keys, F.posexplode(F.concat(F.array(F.lit(None).cast("long")), "__b")).alias("__s", "__t"))
        earlier = Window.partitionBy(*keys).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
        # a segment begins after the bound before it, so the carried row stands first
        carried = (every.join(last, [*keys, "__s"], "left")
                   .select(*keys, "__s", "__t", F.last("__v", ignorenulls=True).over(earlier).alias("__v"))
                   .where(F.col("__v").isNotNull()).withColumn("__side", F.lit(build_side)))
        rows = rows.unionByName(carried, allowMissingColumns=True)

    running = Window.partitionBy(*parts).orderBy("__t", "__side", "__tb").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    matched = (rows.withColumn("__m", F.last("__v", ignorenulls=True).over(running))
                   .where(F.col("__p").isNotNull()))
    out = [F.col("__p")[c].alias(c) for c in probe_cols]
    out += [F.col("__m")[c].alias(c) for c in values]
    if matched_col:
        out.append(F.col("__m").isNotNull().alias(matched_col))
    return matched.select(*out)
