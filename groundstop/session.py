"""Session-scoped helpers: the shared checkpoint folder and scratch locations.

Library code never builds a session.  It reads the cluster's settings from
the session it is given and only fills gaps when running in local mode
(tests, bench).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_SCRATCH_DB = "groundstop_scratch"


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting it from ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster in
    ``spark.checkpoint.dir``.  Only a ``local[...]`` master gets a private
    temporary folder when nothing is configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a client without a SparkContext (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    if not configured:
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS / object store) before running groundstop jobs"
            )
        configured = tempfile.mkdtemp(prefix="groundstop-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)  # also used by iterative ML (tree checkpointing)
    return sc.getCheckpointDir()


_OPEN_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(path)
    return path


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it lies on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, if there is one, on its file system: all its files appear in the new place at once."""
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at) and not fs.rename(at, to):
        raise OSError(f"{source} was not moved to {target}")


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders handed out inside are removed at the end; results must be published by then."""
    _OPEN_SCOPES.append([])
    try:
        yield
    finally:
        for path in _OPEN_SCOPES.pop():
            remove_scratch(spark, path)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session's settings are ``values`` inside, and what they were before at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """Shuffle files of a query that ends inside go with its end, not with the driver's next collection of garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def scratch_table(spark: SparkSession, name: str) -> str:
    """A unique, fully qualified table name in the scratch database.

    The scratch database lives below the shared checkpoint folder, so its
    managed tables are on shared storage and never in a process's working
    directory.
    """
    if not spark.catalog.databaseExists(_SCRATCH_DB):
        location = checkpoint_dir(spark).rstrip("/") + "/scratch-db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_SCRATCH_DB} LOCATION '{location}'")
    return f"{_SCRATCH_DB}.{name}_{uuid.uuid4().hex[:10]}"


def local_session(app: str = "groundstop", cpus: int | None = None, **conf) -> SparkSession:
    """Session for tests and the bench (local mode only)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="groundstop-wh-"))
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
