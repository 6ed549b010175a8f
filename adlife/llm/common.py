"""Shared helpers of the corpus operators: tables, scratch space, modules for workers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import ExitStack, contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from adlife.session import ship_package, table_path

__all__ = ["documents", "drop_scratch", "fresh", "give_back", "materialized", "portions", "scratch_path", "scratch_scope", "ship_package", "table", "worker_cache"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


_SCOPES: list[str] = []


def _scratch(spark: SparkSession) -> str:
    return table_path(spark, "llm", spark.sparkContext.applicationId, *_SCOPES)


@contextmanager
def scratch_scope(spark: SparkSession):
    """What is written with :func:`materialized` inside goes when the scope ends: nothing lazy may outlive it."""
    _SCOPES.append(uuid.uuid4().hex)
    try:
        yield
    finally:
        drop_scratch(spark)
        _SCOPES.pop()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


CLEANUP, BATCH_ROWS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that are handed to Python at once: a batch is held by the executor and by the worker.
MOST_ROWS = 1000


@contextmanager
def _set(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """The shuffle files of what is written inside go at its end, not when the driver collects its garbage; and
    Python gets ``MOST_ROWS`` at a time, or fewer if the session says so."""
    with ExitStack() as held:
        if spark.conf.isModifiable(CLEANUP):             # else a Spark without that setting
            held.enter_context(_set(spark, CLEANUP, "true"))
        if not 0 < int(spark.conf.get(BATCH_ROWS)) <= MOST_ROWS:
            held.enter_context(_set(spark, BATCH_ROWS, str(MOST_ROWS)))
        yield


def materialized(df: DataFrame, name: str, path: str | None = None, **options) -> DataFrame:
    """Write ``df`` once to the shared folder (or ``path``) and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, not a
    recomputation, and several consumers share one computation.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with _shuffles_dropped(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict[str, object] = {}


def give_back() -> None:
    """Freed memory goes back to the system: workers live on, and those of one executor share its memory; so does the driver's Python."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # glibc has it
    if trim:
        trim(0)


def worker_cache(owner: str, make: Callable[[], object] | None = None):
    """What this Python worker keeps for ``owner`` between tasks; made if it is not there.

    Workers serve the tasks of many operators, one after another: only the last owner's things are kept,
    and an operator that keeps nothing (no ``make``) asks for that at the start of its tasks.
    """
    if owner not in _HELD:
        if _HELD:
            _HELD.clear()
            give_back()
        if make is None:
            return None
        _HELD[owner] = make()
    return _HELD[owner]


def drop_scratch(spark: SparkSession) -> None:
    """Remove every table this application wrote with :func:`materialized` (in the scope, if one is open)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def portions(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that only those are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, prefixed until it clashes with none of ``taken`` (compared without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name
