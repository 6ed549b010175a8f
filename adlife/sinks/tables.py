"""Keyed, idempotent writes to Parquet tables (no table format needed).

* :func:`append_keyed` — raw snapshots: rows whose key is already stored are
  dropped, so re-delivering rows is a no-op. A streaming batch goes with its
  (query, number); a batch that the table has already is skipped unread.
* :func:`merge_runs` — the files that appends left in a partition become one
  sorted set again.
* :func:`upsert` — replace rows by key inside the touched partitions only.
* :func:`write_version` / :func:`read_current` — a table of row versions: a run
  writes only its own rows, readers take the newest version per key;
  :func:`merge_tiers` keeps the number of versions logarithmic.
* :func:`export_delimited` — ``;``-joined text lines, ``null`` for nulls.
* :func:`write_clustered` — partitioned by date, each file sorted by
  ``url`` then newest first (the raw tables' clustering order).

All but the last two write a run folder of their own and publish it in the table's
manifest (:mod:`adlife.sinks.manifest`) by one rename: readers (:func:`stored_table`,
``sources.tables.read_table``) always see one whole version, a crash at any point
leaves the version before it, and of two concurrent writers the second raises
(appends try again). A table remembers its columns, its partition column and its bucket
count; a write that disagrees raises instead of dropping columns or storing keys twice.
Rows with a null in a key column cannot be told from one another, so both keyed
writers set them aside in ``<path>_rejected``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlife.sinks import manifest as mf
from adlife.sinks.manifest import ConcurrentWrite, Manifest, vacuum

__all__ = ["ConcurrentWrite", "append_keyed", "check_layout", "compact_versions", "delimited_lines", "export_delimited",
           "merge_runs", "merge_tiers", "one_per_key", "read_current", "rebalanced", "register_view", "stored_table",
           "upsert", "vacuum", "with_key_bucket", "write_clustered", "write_version"]

#: Run folders of a partition from which on merge_runs rewrites it.
MERGE_RUNS = 8
#: Versions of one tier that are merged into one of the next.
FANOUT = 4
#: Columns of raw tables by which single histories are read.
POINT_READS = ("url",)
#: Times that an append starts again after another writer was first.
APPEND_TRIES = 5
#: Rows of one partition value that an append sorts in one task; a partition with more is dealt out by key as well.
ROWS_A_TASK = 100_000


def _layout(df: DataFrame, partition_by: str) -> dict:
    return {"columns": {f.name: f.dataType.simpleString() for f in df.schema.fields}, "partition_by": partition_by,
            "buckets": df.schema[partition_by].metadata.get("buckets")}


def check_layout(spark: SparkSession, df: DataFrame, path: str, partition_by: str, stored: Manifest | None) -> dict:
    """The layout of ``df``; raises unless it has the columns, partition column and bucket count of what is stored."""
    new = _layout(df, partition_by)
    if stored is None:
        return new
    if stored.layout is not None:
        if dict(stored.layout) != new:
            raise ValueError(f"{path} is stored as {stored.layout}, the rows to write are {new}")
    else:                                            # written by someone else: its files have the names
        names = set(spark.read.parquet(path).columns)
        if names != set(df.columns):
            raise ValueError(f"{path} has the columns {sorted(names)}, the rows to write have {sorted(df.columns)}")
    return new


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The newest version of the table at ``path`` read with ``schema``, or None when nothing is stored yet.

    Only a missing path, or one without data folders and files, counts as nothing; any other fault is raised.
    """
    version = mf.current(spark, path)
    if version is not None and version.version:
        return mf.read_parts(spark, path, version, schema)
    if any(not s.getPath().getName().startswith(("_", ".")) for s in mf.list_folder(spark, path)):
        return spark.read.schema(schema).parquet(path)
    return None


# -- keyed writes -----------------------------------------------------------

def rebalanced(df: DataFrame, partition_by: str) -> DataFrame:
    """Shuffle rows by the partition column before a partitioned write.

    AQE sizes the result: small partitions are merged and a hot partition
    value is split over several tasks, so each directory gets a few
    well-sized files instead of one file per task per value.
    """
    return df.hint("rebalance", partition_by)


def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, then by the row's text (so reruns pick the same)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    order = F.struct(*[F.col(c) for c in newest_by], F.to_json(F.struct(*rest)))
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
            .select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns))


def _whole(keys: Sequence[str]) -> Column:
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return whole


def _set_aside(rejected: DataFrame, path: str, batch: str | None = None) -> None:
    """Rows without a whole key go to ``<path>_rejected``, those of a batch once."""
    rejected.write.mode("overwrite").parquet(f"{path.rstrip('/')}_rejected/batch={batch or uuid.uuid4().hex}")


def _complete_keys(new: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """The rows with a whole key; the others go to ``<path>_rejected``."""
    rejected = new.where(~_whole(keys))
    if not rejected.isEmpty():
        _set_aside(rejected, path)
    return new.where(_whole(keys))


def _sizes(new: DataFrame, keys: Sequence[str], partition_by: str) -> tuple[dict, bool]:
    """Rows with a whole key by partition value, and whether there are others, in one pass."""
    found = new.groupBy(partition_by).agg(F.count_if(_whole(keys)), F.count_if(~_whole(keys))).collect()
    return {r[0]: r[1] for r in found if r[1]}, any(r[2] for r in found)


def _touched(stored: DataFrame, new: DataFrame, partition_by: str) -> tuple[DataFrame, list]:
    """The stored rows of the partitions of ``new``, by literal values so that the scan prunes.

    The values are the directories about to be written: never more than the table's partition list.
    """
    values = [r[0] for r in new.select(partition_by).distinct().collect()]
    return stored.where(F.col(partition_by).isin(values)), values


def _touched_parts(spark: SparkSession, path: str, version: Manifest | None, new: DataFrame,
                   partition_by: str) -> tuple[list[str], DataFrame | None]:
    """The partition folders that ``new`` touches and their stored rows; no other folder is listed."""
    if version is None or not version.partitions:
        return [], None
    names = version.of_values(r[0] for r in new.select(partition_by).distinct().collect())
    return names, mf.read_parts(spark, path, version, new.schema, names) if names else None


def clustered(rows: DataFrame, partition_by: str, order: Sequence[str]) -> DataFrame:
    """``rows`` dealt by partition value, every file to be written sorted by ``order`` (``-name``: descending)."""
    by = [F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in order]
    return rebalanced(rows, partition_by).sortWithinPartitions(partition_by, *by)


def _clustered_once(rows: DataFrame, keys: Sequence[str], partition_by: str, order: Sequence[str],
                    sizes: dict, newest_by: Sequence[str] = (), by_key: bool = False) -> DataFrame:
    """The rows of :func:`one_per_key`, dealt and sorted as by :func:`clustered`, in one shuffle and one sort.

    Rows are dealt by partition value, those of a value with many rows (``sizes``) also by key, so equal keys
    meet where the files are sorted and written. ``by_key`` states that rows of one key are equal (made from it).
    """
    rest = [] if by_key else [c for c in rows.columns if c not in keys]
    share, pick = "__share", "__pick"
    large: dict[int, list] = {}                      # by powers of two: a few cases, however many values are large
    for value, n in sizes.items():
        if n > ROWS_A_TASK:
            large.setdefault(1 << ((n - 1) // ROWS_A_TASK).bit_length(), []).append(value)
    shares = F.coalesce(*[F.when(F.col(partition_by).isin(values), n) for n, values in large.items()], F.lit(1))
    by = [k for k in keys if k != partition_by]
    dealt = rows.withColumn(share, F.pmod(F.xxhash64(*by), shares) if by else F.lit(0)).repartition(partition_by, share)
    # a window sorts upwards by its partition: the bits of a whole number turned round sort it downwards
    types = dict(rows.dtypes)
    as_stored = sorted(c.lstrip("-") for c in order) == sorted(by) and all(
        types.get(c[1:]) in ("tinyint", "smallint", "int", "bigint") for c in order if c.startswith("-"))
    terms = [F.bitwise_not(c[1:]) if c.startswith("-") else F.col(c) for c in order] if as_stored else [F.col(k) for k in by]
    best = ([] if by_key else [F.desc(c) for c in newest_by]) + ([F.desc(pick)] if rest else [F.desc(partition_by)])
    dealt = dealt.withColumn(pick, F.to_json(F.struct(*rest))) if rest else dealt
    window = Window.partitionBy(partition_by, *terms, share).orderBy(*best)
    once = dealt.withColumn("__place", F.row_number().over(window)).where(F.col("__place") == 1).select(*rows.columns)
    if as_stored:
        return once
    return once.sortWithinPartitions(partition_by, *[F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in order])


def _not_stored(rows: DataFrame, stored: DataFrame | None, keys: Sequence[str], partition_by: str, held: Sequence) -> DataFrame:
    """The rows whose key is not among the ``stored`` ones; rows of partitions other than ``held`` are not compared."""
    if stored is None:
        return rows
    there = F.col(partition_by).isin(list(held))
    return rows.where(there).join(stored.select(*keys), list(keys), "left_anti").select(*rows.columns).unionByName(rows.where(~there))


def _order(keys: Sequence[str], partition_by: str, order: Sequence[str] | None) -> list[str]:
    return list(order) if order is not None else [k for k in keys if k != partition_by]


def _with_runs(version: Manifest | None, run: str, counts: dict[str, int], instead: bool) -> dict:
    """The manifest entries of a new run beside (or ``instead`` of) the partitions' other runs."""
    partitions = dict(version.partitions) if version else {}
    rows = dict(version.rows) if version else {}
    for name, n in counts.items():
        partitions[name] = [run] if instead else [*partitions.get(name, ()), run]
        rows[name] = {run: n} if instead else {**rows.get(name, {}), run: n}
    return {"partitions": partitions, "rows": rows}


def append_keyed(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str],
                 partition_by: str = "load_date", newest_by: Sequence[str] = (),
                 batch: tuple[str, int] | None = None, order: Sequence[str] | None = None,
                 derive: Callable[[DataFrame], DataFrame] | None = None,
                 before_publish: Callable[[], None] | None = None) -> None:
    """Append ``new`` rows whose key is not yet in the table at ``path`` (partition column among the keys).

    ``batch``: (id of a streaming query, number of its batch). A number that the table has stored for the
    query, or an earlier one, is skipped without reading anything. ``order`` sorts each file (default: the keys).
    ``derive`` makes the rows to store from rows of ``new``, one of each and with its key; then only those are made
    that are not stored yet, and ``new``, which is read several times, should be cached or cheap. ``before_publish``
    is called when the rows are written, before readers can see them; what it raises leaves the table as it was.
    """
    if partition_by not in keys:
        raise ValueError("the partition column must be part of the key")
    keys, order = list(keys), _order(keys, partition_by, order)
    version = mf.current(spark, path)
    if batch is not None and version is not None and version.batches.get(batch[0], -1) >= batch[1]:
        return
    kept = new.is_cached or derive is not None
    new = new if kept else new.persist(StorageLevel.MEMORY_AND_DISK)
    made = derive or (lambda rows: rows)
    try:
        sizes = None
        for attempt in range(APPEND_TRIES):
            layout = check_layout(spark, made(new), path, partition_by, version)
            if sizes is None:
                sizes, rejected = _sizes(new, keys, partition_by)
                if rejected:
                    _set_aside(made(new.where(~_whole(keys))), path, batch and f"{batch[0]}-{batch[1]}")
            names = version.of_values(sizes) if version else []
            stored = mf.read_parts(spark, path, version, made(new).schema, names) if names else None
            there = {mf.partition_value(n) for n in names}
            rows = _not_stored(new.where(_whole(keys)), stored, keys, partition_by, [v for v in sizes if str(v) in there])
            rows = _clustered_once(made(rows), keys, partition_by, order, sizes, newest_by,
                                   by_key=derive is not None and set(new.columns) == set(keys))
            run, counts = mf.write_run(spark, rows, path, partition_by, POINT_READS)
            batches = {**(version.batches if version else {}), **({batch[0]: batch[1]} if batch else {})}
            if before_publish is not None:
                before_publish()
            try:
                mf.publish(spark, path, version, layout=layout, batches=batches, **_with_runs(version, run, counts, instead=False))
                return
            except ConcurrentWrite:
                if attempt == APPEND_TRIES - 1:
                    raise
                version = mf.current(spark, path)
    finally:
        if not kept:
            new.unpersist()


def merge_runs(spark: SparkSession, path: str, schema: T.StructType, order: Sequence[str],
               partition_by: str = "load_date", min_runs: int = MERGE_RUNS) -> list[str]:
    """Rewrite the partitions that hold ``min_runs`` run folders or more as one sorted run each; their names."""
    version = mf.current(spark, path)
    names = [n for n, runs in version.partitions.items() if len(runs) >= min_runs] if version else []
    if names:
        rows = mf.read_parts(spark, path, version, schema, names)
        run, counts = mf.write_run(spark, clustered(rows, partition_by, order), path, partition_by, POINT_READS)
        mf.publish(spark, path, version, **_with_runs(version, run, counts, instead=True))
    return names


def upsert(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str],
           partition_by: str = "load_date", unique_keys: bool = False, newest_by: Sequence[str] = (),
           order: Sequence[str] | None = None) -> None:
    """Insert or replace ``new`` rows by ``keys`` in the table at ``path``.

    Only partitions present in ``new`` are rewritten; inside them, stored
    rows whose key is not in ``new`` are kept. The partition column belongs to
    the key or is a function of it. ``unique_keys`` states that ``new`` already
    holds one row per key (e.g. it was grouped by them), which saves the
    de-duplication shuffle. Raises :class:`ConcurrentWrite`, with nothing changed, if another
    writer published a version meanwhile.
    """
    keys, order = list(keys), _order(keys, partition_by, order)
    version = mf.current(spark, path)
    # the new rows feed several branches (touched partitions, replaced keys, the rows
    # themselves); keep them for the one write instead of computing them again
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        layout = check_layout(spark, new, path, partition_by, version)
        rows = _complete_keys(new, path, [*keys, *([] if partition_by in keys else [partition_by])])
        if not unique_keys:
            rows = one_per_key(rows, keys, newest_by)
        _, stored = _touched_parts(spark, path, version, rows, partition_by)
        if stored is not None:
            rows = stored.join(rows.select(*keys), keys, "left_anti").unionByName(rows)
        run, counts = mf.write_run(spark, clustered(rows, partition_by, order), path, partition_by)
    finally:
        new.unpersist()
    levels = {n: k for n, k in (version.levels if version else {}).items() if n not in counts}
    mf.publish(spark, path, version, layout=layout, levels=levels, **_with_runs(version, run, counts, instead=True))


# -- tables of row versions --------------------------------------------------

def write_version(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], version: str,
                  name: str = "version") -> None:
    """Store ``rows`` (one per key) as the version ``version`` (sortable text) of their keys.

    Only this version's own partition is read and merged (a rerun may bring fewer keys); nothing
    that other runs wrote is touched.
    """
    upsert(spark, rows.withColumn(name, F.lit(version)), path, [*keys, name], partition_by=name, unique_keys=True)


def versions(spark: SparkSession, path: str, upto: str | None = None) -> list[str]:
    """The stored versions up to ``upto``, oldest first; from the manifest, without reading rows."""
    version = mf.current(spark, path)
    found = sorted(v for v in version.values().values() if v is not None) if version else []
    return [v for v in found if upto is None or v <= upto]


def _newest(rows: DataFrame, schema: T.StructType, keys: Sequence[str], name: str) -> DataFrame:
    rest = [f.name for f in schema.fields if f.name not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), name).alias("__row"))
    return newest.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*[f.name for f in schema.fields])


def read_current(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 name: str = "version", upto: str | None = None) -> DataFrame:
    """The newest version of each key, among the versions up to ``upto`` if that is given."""
    full = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    version = mf.current(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    names = version.of_values(versions(spark, path, upto))
    return _newest(mf.read_parts(spark, path, version, full, names), schema, keys, name)


def _merge_versions(spark: SparkSession, path: str, version: Manifest, schema: T.StructType, keys: Sequence[str],
                    names: list[str], name: str, level: int) -> Manifest:
    """The versions in the folders ``names`` (oldest first) become one, under the newest one's name."""
    full = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    into = mf.partition_value(names[-1])
    rows = _newest(mf.read_parts(spark, path, version, full, names), schema, keys, name).withColumn(name, F.lit(into))
    run, counts = mf.write_run(spark, clustered(rows, name, list(keys)), path, name)
    left = Manifest(partitions={n: r for n, r in version.partitions.items() if n not in names},
                    rows={n: r for n, r in version.rows.items() if n not in names})
    levels = {n: k for n, k in version.levels.items() if n not in names}
    return mf.publish(spark, path, version, levels={**levels, names[-1]: level}, **_with_runs(left, run, counts, instead=True))


def compact_versions(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], upto: str,
                     name: str = "version") -> None:
    """Merge all versions up to ``upto`` into the newest of them, so that readers stop reading replaced rows."""
    version = mf.current(spark, path)
    names = [n for v in versions(spark, path, upto) for n in version.of_values([v])]
    if len(names) > 1:
        _merge_versions(spark, path, version, schema, keys, names, name, 1 + max(version.levels.get(n, 0) for n in names))


def merge_tiers(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], upto: str,
                name: str = "version", fanout: int = FANOUT) -> int:
    """Merge ``fanout`` neighbouring versions of one tier into one of the next, while there are such; how many merges.

    Versions after ``upto`` stay as they are (a rerun may still replace them). A row is rewritten once per
    tier, so n versions cost n log n rows of writing and readers see at most fanout - 1 of each tier.
    """
    merges = 0
    while True:
        version = mf.current(spark, path)
        names = [n for v in versions(spark, path, upto) for n in version.of_values([v])] if version else []
        tier = [version.levels.get(n, 0) for n in names]
        at = next((i for i in range(len(names) - fanout + 1) if len(set(tier[i:i + fanout])) == 1), None)
        if at is None:
            return merges
        _merge_versions(spark, path, version, schema, keys, names[at:at + fanout], name, tier[at] + 1)
        merges += 1


def with_key_bucket(df: DataFrame, key: str = "url", buckets: int = 64,
                    name: str = "key_bucket") -> DataFrame:
    """Add a hash bucket of ``key`` to partition an un-dated table for :func:`upsert`.

    The count goes with the column; a table keeps the count it was made with.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(name, metadata={"buckets": buckets})
    return df.select("*", bucket)


def delimited_lines(df: DataFrame, sep: str = ";", null_text: str = "null") -> DataFrame:
    """One text column ``value``: all columns as text joined by ``sep``."""
    cols = [F.col(c).cast("string") for c in df.columns]
    return df.select(F.array_join(F.array(*cols), sep, null_text).alias("value"))


def export_delimited(df: DataFrame, path: str, sep: str = ";", null_text: str = "null") -> None:
    """Write ``sep``-joined lines (no header, no quoting), one part file per task."""
    delimited_lines(df, sep, null_text).write.mode("overwrite").text(path)


def write_clustered(df: DataFrame, path: str, partition_by: str = "load_date",
                    cluster: Sequence[str] = ("url",), newest_first: str = "load_time") -> None:
    """Partitioned write, each file sorted by ``cluster`` then ``newest_first`` descending."""
    (clustered(df, partition_by, [*cluster, f"-{newest_first}"])
       .write.mode("overwrite").partitionBy(partition_by).parquet(path))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
