"""What belongs to a table just now: immutable run folders and a numbered manifest.

A writer puts its rows into a folder of its own, ``<path>/_run=<id>/<partition>=<value>/``,
and then publishes a manifest ``<path>/_manifest/<version>.json`` that names the run
folders of every partition. Nothing that a published manifest names is ever changed, so a
reader that took a manifest sees that version whole, whatever is written meanwhile. The
one step that readers can see is the rename of the manifest to its number; it fails
if the number is taken, so of two writers that started from one version the
second raises :class:`ConcurrentWrite`. A writer that dies before it leaves only folders
that no manifest names; :func:`vacuum` removes them.

A manifest also keeps, for the writers:

* ``layout``: columns, partition column and bucket count of the table;
* ``rows``: how many rows each run folder holds;
* ``batches``: the last batch number stored of each streaming query;
* ``levels``: how often the rows of a partition have been merged.

A table without a manifest is plain Parquet written by someone else; its partition folders
are taken over as they are (run ``""``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_manifest"
RUN = "_run"
DAY_MS = 86_400_000


class ConcurrentWrite(RuntimeError):
    """Another writer published a version since this one started."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    layout: Mapping | None = None
    partitions: Mapping[str, list[str]] = field(default_factory=dict)     # folder name -> runs
    rows: Mapping[str, Mapping[str, int]] = field(default_factory=dict)   # folder name -> run -> rows
    batches: Mapping[str, int] = field(default_factory=dict)
    levels: Mapping[str, int] = field(default_factory=dict)

    def values(self) -> dict[str, str | None]:
        """Partition folder -> value as text."""
        return {name: partition_value(name) for name in self.partitions}

    def of_values(self, values: Iterable) -> list[str]:
        wanted = {None if v is None else str(v) for v in values}
        return [name for name, value in self.values().items() if value in wanted]


def partition_value(folder: str) -> str | None:
    value = unquote(folder.partition("=")[2])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


# -- files ------------------------------------------------------------------

def fs_of(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def list_folder(spark: SparkSession, path: str) -> list:
    """File statuses of what is in a folder; none if there is no such folder."""
    fs, at = fs_of(spark, path)
    return list(fs.listStatus(at(path))) if fs.exists(at(path)) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = fs_of(spark, path)
    stream = fs.open(at(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = fs_of(spark, path)
    stream = fs.create(at(path), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def _rename_to_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename that fails if ``target`` exists."""
    from py4j.protocol import Py4JJavaError

    sc = spark.sparkContext
    jvm = sc._jvm
    at = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at(target).toUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(at(source), at(target), options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise ConcurrentWrite(f"{target} was published by another writer") from e
        raise


# -- versions -----------------------------------------------------------------

def _published(spark: SparkSession, path: str) -> dict[int, object]:
    found = {}
    for status in list_folder(spark, f"{path}/{FOLDER}"):
        name = status.getPath().getName()
        if name.endswith(".json") and name[:-5].isdigit():
            found[int(name[:-5])] = status
    return found


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest of the table at ``path``; None when nothing is stored there."""
    path = path.rstrip("/")
    versions = _published(spark, path)
    if versions:
        return Manifest(**json.loads(read_text(spark, versions[max(versions)].getPath().toString())))
    names = [s.getPath().getName() for s in list_folder(spark, path) if s.isDirectory()]
    plain = {n: [""] for n in names if "=" in n and not n.startswith(("_", "."))}
    return Manifest(partitions=plain) if plain else None


def publish(spark: SparkSession, path: str, base: Manifest | None, **changes) -> Manifest:
    """Publish ``base`` with ``changes`` as the next version, or raise :class:`ConcurrentWrite`."""
    path = path.rstrip("/")
    new = replace(base or Manifest(), version=(base.version if base else 0) + 1, **changes)
    draft = f"{path}/{FOLDER}/.{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(new.__dict__))
    try:
        _rename_to_new(spark, draft, f"{path}/{FOLDER}/{new.version:010d}.json")
    except ConcurrentWrite:
        fs, at = fs_of(spark, draft)
        fs.delete(at(draft), False)
        raise
    return new


def read_parts(spark: SparkSession, path: str, manifest: Manifest, schema: T.StructType,
               folders: Iterable[str] | None = None) -> DataFrame:
    """The rows of the named partition folders (default: all) in that version, with ``schema``.

    The partition column of the folders is read as ``schema`` says, and filters on it prune folders.
    """
    path = path.rstrip("/")
    names = list(manifest.partitions if folders is None else folders)
    runs = [f"{path}/{RUN}={run}/{n}" for n in names for run in manifest.partitions.get(n, ()) if run]
    plain = [f"{path}/{n}" for n in names if "" in manifest.partitions.get(n, ())]
    own = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    columns = [f.name for f in schema.fields]
    parts = []
    if runs:
        parts.append(spark.read.schema(own).option("basePath", path).parquet(*runs).select(*columns))
    if plain:
        parts.append(spark.read.schema(schema).option("basePath", path).parquet(*plain).select(*columns))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def write_run(spark: SparkSession, rows: DataFrame, path: str, partition_by: str,
              point_reads: Iterable[str] = ()) -> tuple[str, dict[str, int]]:
    """Write ``rows`` as a new run folder; its id and the row count of each of its partition folders.

    Columns named in ``point_reads`` get a Bloom filter in every row group, so that readers of single values skip
    the row groups without them also where the values lie between the group's least and greatest.
    """
    run = uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/{RUN}={run}"
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in point_reads if c in rows.columns}
    sizes = {"parquet.bloom.filter.adaptive.enabled": "true"} if blooms else {}     # as large as the values need
    rows.write.options(**blooms, **sizes).partitionBy(partition_by).parquet(folder)
    names = [s.getPath().getName() for s in list_folder(spark, folder) if s.isDirectory()]
    names = [n for n in names if n.startswith(f"{partition_by}=")]
    if not names:
        return run, {}
    # only the partition column is read: row counts come from the file footers
    kept = T.StructType([T.StructField(partition_by, T.StringType())])
    counts = spark.read.schema(kept).parquet(folder).groupBy(partition_by).count().collect()
    by_value = {r[0]: r[1] for r in counts}
    return run, {n: by_value.get(partition_value(n), 0) for n in names}


def row_counts(spark: SparkSession, path: str) -> dict[str | None, int] | None:
    """Rows by partition value, from the manifest alone; None if it does not know them all."""
    manifest = current(spark, path)
    if manifest is None:
        return {}
    out: dict[str | None, int] = {}
    for name, runs in manifest.partitions.items():
        known = manifest.rows.get(name, {})
        if any(r not in known for r in runs):
            return None
        out[partition_value(name)] = sum(known[r] for r in runs)
    return out


def vacuum(spark: SparkSession, path: str, retain_ms: int = DAY_MS) -> int:
    """Delete run folders and manifests that readers can no longer be using; how many went.

    Kept are the newest version, every version that was the newest within the last ``retain_ms``, and
    folders younger than that (a writer may be about to publish them).
    """
    path = path.rstrip("/")
    versions = _published(spark, path)
    if not versions:
        return 0
    limit = time.time() * 1000 - retain_ms
    numbers = sorted(versions)
    # a version was the newest until its successor came
    old = [v for v, successor in zip(numbers, numbers[1:]) if versions[successor].getModificationTime() < limit]
    keep = [json.loads(read_text(spark, versions[v].getPath().toString())) for v in numbers if v not in set(old)]
    named = {(name, run) for m in keep for name, runs in m["partitions"].items() for run in runs}
    fs, at = fs_of(spark, path)
    gone = 0
    for status in list_folder(spark, path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{RUN}=") and status.getModificationTime() < limit:
            run, parts = name.partition("=")[2], [s for s in fs.listStatus(status.getPath()) if s.isDirectory()]
            dead = [s for s in parts if (s.getPath().getName(), run) not in named]
            if len(dead) == len(parts):
                fs.delete(status.getPath(), True)
            else:
                for s in dead:
                    fs.delete(s.getPath(), True)
            gone += len(dead)
        elif status.isDirectory() and "=" in name and not name.startswith(("_", ".")) and (name, "") not in named and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)            # taken over from a plain table, since replaced
            gone += 1
    for v in old:
        fs.delete(versions[v].getPath(), False)
    return gone
