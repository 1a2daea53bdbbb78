"""Helpers that several operators share: word splitting, array shifts, shared intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Spark's setting that removes a query's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's limit to the bytes of the Arrow batches that go to Python workers.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_paths: WeakKeyDictionary = WeakKeyDictionary()
_kept: dict[str, Callable[[], None]] = {}
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where that is unset (local
    runs), a folder beside the session's tables in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return base.rstrip("/")


def worker_of(step: str, forget: Callable[[], None] | None = None) -> None:
    """Called in tasks: this Python worker now works for ``step``, and ``forget`` gives up what it keeps for that
    step's next task. What it kept for other steps goes: Spark hands a worker on from step to step, so it would
    hold the tables of all of them beside the present one's."""
    others = [s for s in _kept if s != step]
    for other in others:
        _kept.pop(other)()
    if others:
        gc.collect()  # closures that call themselves are cycles, and hold what they use
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)  # without it the GNU allocator holds most of what was given up
    if forget:
        _kept[step] = forget


def stored(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives lost
    executors, and later readers see only the columns they ask for. Once the table stands nobody reads the
    shuffle files of its query, so Spark is told to remove them at the query's end, not at some later GC.
    ``batch_bytes`` limits the batches that this query's Python workers get, each held by worker and executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    conf = {SHUFFLE_CLEANUP: "true"} | ({BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Remove the tables that ``stored`` wrote for these frames; nothing may read them any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_paths.pop(df))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def pair_shift(a: str, shift: int, f) -> Column:
    """``f(a[i], a[i + shift])`` for every i for which both exist. ``a`` names a stored column: an
    expression would be evaluated again for each use."""
    n = F.greatest(F.size(a) - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + shift), n), f)


def sum_of(a: Column) -> Column:
    """Sum of an array of whole numbers as long."""
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
