"""Batch ledger: what each load did to a table, so that a replay is recognised.

Beside a table lies a small append-only Parquet folder with two rows a batch: one before the write (``begun``: what it
is to do, the partitions it touches, the rows that the table had) and one after it (``done``: the rows written). A
batch is named by its caller (an epoch of a stream, a load date, a file set). ``load`` looks it up first:

* done before: nothing is written, the recorded number is returned;
* begun, not done (the job died in between): replaces and merges are written again, which gives the same partitions
  whatever part of them had been replaced; an append is written again only if the table still has the rows it had
  at the start, else it had been committed (Spark commits a job's files together) and is only marked as done;
* unknown: written.

One writer a table at a time, as for the table itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.sinks.tables import append_to, merge_partitions, replace_partitions

SCHEMA = "batch string, state string, operation string, partitions array<string>, rows long, rows_before long, at timestamp"
OPERATIONS = ("replace", "merge", "append")


def ledger_path(spark: SparkSession, target: str) -> str:
    """The ledger's folder: beside a path, or beside the warehouse folder of a table."""
    if "/" in target:
        return target.rstrip("/") + "__ledger"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target.replace('.', '__')}__ledger"


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """All entries, empty before the first batch."""
    try:
        return spark.read.schema(SCHEMA).parquet(ledger_path(spark, target))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def _note(spark: SparkSession, target: str, batch: str, state: str, operation: str, partitions: DataFrame | None, rows: int, before: int) -> None:
    touched = F.array().cast("array<string>") if partitions is None else F.col("partitions")
    one = spark.range(1) if partitions is None else partitions
    one.select(F.lit(batch).alias("batch"), F.lit(state).alias("state"), F.lit(operation).alias("operation"), touched.alias("partitions"),
               F.lit(rows).cast("long").alias("rows"), F.lit(before).cast("long").alias("rows_before"), F.current_timestamp().alias("at")
               ).coalesce(1).write.mode("append").parquet(ledger_path(spark, target))


def _touched(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the partitions of a batch as ``key=value/...`` names, sorted. Days and hubs of one batch, never its rows."""
    name = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])
    return df.select(name.alias("p")).distinct().agg(F.sort_array(F.collect_list("p")).alias("partitions"))


def _rows_in(spark: SparkSession, target: str) -> int:
    return (spark.read.parquet(target) if "/" in target else spark.table(target)).count()


def load(df: DataFrame, target: str, batch: str, operation: str = "merge", keys: Sequence[str] = (), row_key: Sequence[str] = ()) -> int:
    """Apply ``df`` to ``target`` once for its ``batch`` name: replace its ``keys`` partitions, merge into them on ``row_key``, or append.
    Returns the rows that the write reported."""
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {OPERATIONS}, got {operation!r}")
    spark = df.sparkSession
    known = read_ledger(spark, target).filter(F.col("batch") == batch)
    seen = {r.state: r for r in known.groupBy("state").agg(F.max("rows").alias("rows"), F.max("rows_before").alias("rows_before")).collect()}
    if "done" in seen:
        return seen["done"].rows
    if operation == "append":
        before = seen["begun"].rows_before if "begun" in seen else _rows_in(spark, target)
        if "begun" in seen and _rows_in(spark, target) != before:
            n = _rows_in(spark, target) - before  # committed, the mark was lost
        else:
            if "begun" not in seen:
                _note(spark, target, batch, "begun", operation, None, 0, before)
            n = append_to(df, target)
        _note(spark, target, batch, "done", operation, None, n, before)
        return n
    if "begun" not in seen:
        _note(spark, target, batch, "begun", operation, _touched(df, keys), 0, 0)
    n = replace_partitions(df, target, keys) if operation == "replace" else merge_partitions(df, target, keys, row_key)
    _note(spark, target, batch, "done", operation, _touched(df, keys), n, 0)
    return n
