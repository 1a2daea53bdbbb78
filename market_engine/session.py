"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

# Settings every job relies on: UTC wall clock for NTZ timestamps, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast promotion), and
# dynamic partition overwrite for idempotent day/hub replaces.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # long-running drivers (streams, many small jobs): bound the retained job / plan history
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.sql.ui.retainedExecutions": "50",
}


def get_session(
    master: str | None = None,
    app: str = "market_engine",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """A session with the engine's settings; master and shuffle partitions are the cluster's unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package's code, once per application: a task that runs Python imports the package
    by name, wherever the driver found it. The driver packs it to one file, which Spark sends to the executors."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="run-package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_fallback(spark: SparkSession) -> str:
    """Where intermediate tables go if ``spark.checkpoint.dir`` is unset: beside the session's tables, in the
    warehouse. A warehouse that nobody named is a folder of the driver's machine, so this holds for local runs
    only; a cluster must name a folder that its executors share."""
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def checkpoint_dir(spark: SparkSession, fallback=None) -> str | None:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    The cluster setting always wins; ``fallback`` (a path, or a callable returning one) is
    applied only when the setting is absent (tests and local runs). Returns the folder in use.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if callable(fallback):
        fallback = fallback()
    if fallback:
        spark.conf.set("spark.checkpoint.dir", fallback)
        spark.sparkContext.setCheckpointDir(fallback)
        return fallback
    return None


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_frames(spark: SparkSession):
    """Frames that ``materialise_frame`` writes inside are removed at the end; what is to outlive them is
    materialised with ``keep=True``."""
    token = _scratch.set([])
    try:
        yield
    finally:
        paths = _scratch.get()
        _scratch.reset(token)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise_frame(df: DataFrame, keep: bool = False) -> DataFrame:
    """Cut a frame's lineage before it is read several times: write it as Parquet in the shared folder and read it
    back. The rows survive lost executors, and every reader takes only the columns and rows that it asks for."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark, lambda: shared_fallback(spark)).rstrip('/')}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path)
    scratch = _scratch.get()
    if scratch is not None and not keep:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)
