"""Session settings, the shared work folder and size-checked joins."""

from __future__ import annotations

import atexit
import io
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

# A table is broadcast only after its rows were counted and found within this bound.
BROADCAST_ROWS = 500_000

# The folder of each application.
_FOLDERS: dict[str, str] = {}


def build_session(app: str = "riskspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Day deltas and date parsing are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between passes: one per application, below what ``spark.checkpoint.dir`` names.

    It is removed when the application ends. Without that setting only a local session gets
    a temporary folder; on a cluster, where executors do not share disks, it is an error.
    """
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = tempfile.mkdtemp(prefix="riskspark-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
        _FOLDERS[application] = f"{base.rstrip('/')}/riskspark-{application}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS[application])
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return _FOLDERS[application]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession, packages: Iterable[str] = ("riskspark", "checks"), modules: Iterable[str] = ()) -> None:
    """Send the Python sources of ``packages`` and top-level ``modules`` to the executors, once per application.

    The zip is built in memory on the driver and written to the shared folder through the
    cluster's file system, so Python workers import the same code however the session was
    started. Packages or modules that are absent (a removed subpackage) are left out.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for package in packages:
            for folder, _, names in os.walk(os.path.join(root, package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, root))
        for module in modules:
            full = os.path.join(root, f"{module}.py")
            if os.path.exists(full):
                archive.write(full, f"{module}.py")
    target = f"{shared_folder(spark)}/code-{uuid.uuid4().hex}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(buffer.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(application)


def materialize(df: DataFrame, tag: str, key: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several passes follow an expensive stage. The written table
    survives the loss of executors, cuts the lineage and, being Parquet, lets
    each later pass read only the columns it needs. With ``key``, the rows and the
    rows without a key are counted while writing (``DataFrame.observe``) and kept as
    ``stats`` of the returned table, so that no later job has to count them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    seen = None
    if key is not None and key in df.columns:
        seen = Observation(f"{tag}-{uuid.uuid4().hex}")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("missing_key"))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    if seen is not None:
        out.stats = {k: int(v) for k, v in seen.get.items()}
        out._stats_key = key
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables that :func:`materialize` wrote, once nothing reads them any more."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def lookup(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written lookup table for broadcast if its counted size allows it."""
    return F.broadcast(table) if is_small(table, limit) else table


def is_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a written table holds at most ``limit`` rows (a count reads no column)."""
    return table.count() <= limit


def in_parallel(spark: SparkSession, tasks: Iterable[Callable[[], T]], parallelism: int = 4) -> list[T]:
    """Run independent Spark actions (such as the fits of several folds) from a few driver threads, in order."""
    with ThreadPool(parallelism) as pool:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), list(tasks))
