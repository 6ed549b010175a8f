"""Session construction (for tests, bench and scripts) and the shared work folder.

Library code never builds its own session; it takes the caller's. Written
intermediate tables and checkpoints go to the folder the cluster names in
``spark.checkpoint.dir``; only when that is unset under a local master (tests) a
temporary folder is created and registered as the checkpoint dir. On a cluster
an unset folder is an error: executors would write to their own disks.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, shuffle_partitions: int | None = None,
                  app: str = "adlife", extra: dict | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # local runs shuffle little data: keep several tasks per stage
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("ADLIFE_DRIVER_MEMORY", "16g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables and checkpoints, shared by all executors."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="adlife-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def table_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), "adlife", *parts])


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``adlife`` importable in the Python workers (once per application).

    The package is zipped on the driver and distributed with ``addPyFile``,
    the same mechanism as ``--py-files``; executors on any host receive it.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, archive = tempfile.mkstemp(prefix="adlife-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
