"""Table lifecycle: idempotent replaces, appends, layer materialisation, audit.

Replaces are one atomic dynamic-partition overwrite: only the partitions present in the batch
are rewritten, in a single job commit (the reference issues a DELETE and a separate INSERT).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOAD_DATE = "load_date"


def with_load_date(df: DataFrame, ts: str) -> DataFrame:
    """Partition column for day replaces: ``DATE(ts)`` (B-11), stored so deletes prune statically."""
    return df.withColumn(LOAD_DATE, F.to_date(ts))


def replace_partitions(df: DataFrame, target: str, keys: Sequence[str], mode: str = "partitions") -> int:
    """A-9 / A-10 / A-11: replace exactly the ``keys`` partitions present in ``df``.

    ``target`` is a Parquet path (contains '/') or a catalog table partitioned by ``keys``.
    An empty batch is refused (a failed extract must not wipe good data). ``mode="all"``
    replaces the whole table. Returns the number of rows written.
    """
    # one pass computes the batch; the count (row total, empty-batch guard) and the write both
    # read the persisted rows. (Not ``observe``: it leaves a non-serialisable field on the
    # session that breaks later tasks carrying fitted ML models.)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    n = out.count()
    if n == 0:
        out.unpersist()
        raise ValueError(f"refusing to replace partitions of {target} with an empty batch")
    overwrite = "dynamic" if mode == "partitions" else "static"
    if "/" in target:
        (out.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
         .partitionBy(*keys).parquet(target))
    else:
        spark = df.sparkSession
        if spark.catalog.tableExists(target):
            cols = spark.table(target).columns
            prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", overwrite)
            try:
                out.select(*cols).write.insertInto(target, overwrite=True)
            finally:
                spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
        else:
            out.write.mode("overwrite").partitionBy(*keys).format("parquet").saveAsTable(target)
    out.unpersist()
    return n


def merge_partitions(df: DataFrame, target: str, keys: Sequence[str], row_key: Sequence[str],
                     newest: str = "loaded_at") -> int:
    """A-22: merge ``df`` into the ``keys`` partitions it touches (Parquet path or catalog table).

    The stored rows of those partitions are read (pruned by the range of each partition key, one
    aggregate row; then matched null-safe) and written again together with the batch. Per
    ``row_key`` the row with the latest ``newest`` stays, of equal stamps the batch's, so a partition
    may arrive in parts and a replayed batch changes nothing. Returns the rows now in the partitions.
    """
    spark = df.sparkSession
    try:
        old = spark.read.schema(df.schema).parquet(target) if "/" in target else spark.table(target)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise
        old = None
    rows = df.withColumn("_new", F.lit(1))
    if old is not None:
        span = df.agg(*[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for k in keys:
            old = old.filter(F.col(k).between(F.lit(span[f"lo_{k}"]), F.lit(span[f"hi_{k}"])) | F.col(k).isNull())
        touched = df.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        rows = rows.unionByName(old.select(*df.columns).join(touched, same, "left_semi").withColumn("_new", F.lit(0)))
    w = Window.partitionBy(*dict.fromkeys([*keys, *row_key])).orderBy(F.col(newest).desc_nulls_last(), F.desc("_new"))
    kept = rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_new")
    return replace_partitions(kept, target, keys)


def append_to(df: DataFrame, table: str) -> int:
    """A-12: append to an existing table (never creates it); returns rows written, 0 for empty input."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; create it first")
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    n = out.count()
    if n:
        out.select(*spark.table(table).columns).write.insertInto(table)
    out.unpersist()
    return n


LAYERS = ("staging", "intermediate", "mart", "ml", "raw")


def materialise(df: DataFrame, layer: str, name: str, comment: str | None = None,
                partition_by: Sequence[str] = ()) -> str:
    """A-18: staging -> temporary view ``staging_<name>`` (inlined into readers' plans);
    other layers -> a Parquet table ``<layer>.<name>`` in that layer's database."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    spark = df.sparkSession
    if layer == "staging":
        view = f"staging_{name}"
        df.createOrReplaceTempView(view)
        return view
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    full = f"{layer}.{name}"
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(full)
    if comment:
        spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('comment' = '{comment.replace(chr(39), '')}')")
    return full


def table_audit(spark: SparkSession, expected: dict[str, str | None], loaded_col: str = "loaded_at") -> DataFrame:
    """A-20: per expected table: exists, rows, first/last key time, last load time.

    ``expected`` maps table name -> its time column (or None). Each existing table is one
    global aggregate; the results are unioned (one row per table).
    """
    rows = []
    for name, ts in expected.items():
        if not spark.catalog.tableExists(name):
            rows.append(spark.createDataFrame(
                [(name, False, 0, None, None, None)],
                "table_name string, table_exists boolean, row_count bigint, first_time timestamp_ntz, "
                "last_time timestamp_ntz, last_loaded_at timestamp_ntz"))
            continue
        t = spark.table(name)
        tcol = F.col(ts).cast("timestamp_ntz") if ts else F.lit(None).cast("timestamp_ntz")
        lcol = F.col(loaded_col).cast("timestamp_ntz") if loaded_col in t.columns else F.lit(None).cast("timestamp_ntz")
        rows.append(t.agg(F.lit(name).alias("table_name"), F.lit(True).alias("table_exists"),
                          F.count(F.lit(1)).alias("row_count"), F.min(tcol).alias("first_time"),
                          F.max(tcol).alias("last_time"), F.max(lcol).alias("last_loaded_at")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
