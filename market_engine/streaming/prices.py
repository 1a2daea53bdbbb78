"""Incremental ingest and streaming roll-ups.

Event time is NTZ (UTC wall clock) in storage; watermarks need a zoned timestamp, so the
stream converts each NTZ value to the instant it denotes in UTC on the way in and back to UTC
wall clock at the sink. Neither step uses the session time zone, so hour windows are the same
in any session.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from market_engine.functions import clean_key, exact_avg, instant_to_utc_ntz, utc_ntz_to_instant
from market_engine.operators.stress import spike_flag, stress_severity
from market_engine.sinks.tables import merge_partitions


#: What identifies a 5-minute price row.
PRICE_KEY = ("interval_start", "trading_hub", "market", "source_system")


def stream_ingest(spark: SparkSession, source: str, schema, target: str, keys, checkpoint: str,
                  fmt: str = "parquet", transform: Callable[[DataFrame], DataFrame] | None = None,
                  available_now: bool = True, row_key=PRICE_KEY, newest: str = "loaded_at") -> StreamingQuery:
    """A-22: newly landed files -> merge into the touched partitions per micro-batch.

    The file source tracks which files were processed in ``checkpoint``; a rerun after a
    failure resumes from the last committed batch. Each batch is merged on ``row_key`` with what
    its partitions already hold (the latest ``newest`` wins), so a partition may arrive in any
    number of batches, and a replayed batch changes nothing.
    """
    src = spark.readStream.schema(schema).format(fmt).load(source)
    if transform is not None:
        src = transform(src)

    def write(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            merge_partitions(batch, target, keys, row_key, newest)

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_table(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """The table ``name`` of a folder as a stream, whether it is one Parquet file or a folder of part files.

    The braces make the path a glob with one match: a stream takes a plain path as a folder, a glob's matches as they are."""
    return spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/{{{name}.parquet}}")


def _zoned(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, utc_ntz_to_instant(col))


def dedupe_intervals(raw: DataFrame, delay: str = "2 hours") -> DataFrame:
    """S-2: drop re-delivered 5-minute rows (same interval, cleaned hub and market) within the watermark."""
    z = _zoned(raw, "interval_start").withColumns({c: clean_key(c) for c in ("trading_hub", "market")})
    z = z.withWatermark("interval_start", delay)
    return z.dropDuplicatesWithinWatermark(["interval_start", "trading_hub", "market"])


def streaming_hourly_prices(raw: DataFrame, delay: str = "2 hours", decimals: int = 5,
                            zoned_input: bool = False) -> DataFrame:
    """S-1: D-1 as a streaming aggregation: tumbling 1-hour windows, rows later than the
    watermark dropped; append mode emits each hour once, when the watermark passes its end."""
    z = raw if zoned_input else _zoned(raw, "interval_start")
    z = z.withWatermark("interval_start", delay)
    g = z.groupBy(F.window("interval_start", "1 hour").alias("w"), clean_key("trading_hub").alias("trading_hub"),
                  clean_key("market").alias("market"), "source_system")
    agg = g.agg(exact_avg("lmp", decimals).alias("lmp_avg"), F.min("lmp").alias("lmp_min"),
                F.max("lmp").alias("lmp_max"), F.stddev_samp("lmp").alias("lmp_stddev"),
                exact_avg("energy_component", decimals).alias("energy_component_avg"),
                exact_avg("congestion_component", decimals).alias("congestion_component_avg"),
                exact_avg("loss_component", decimals).alias("loss_component_avg"),
                F.count(F.lit(1)).alias("interval_count"), F.max("loaded_at").alias("loaded_at"))
    return agg.select(instant_to_utc_ntz(F.col("w.start")).alias("hour_utc"), "trading_hub", "market",
                      "lmp_avg", "lmp_min", "lmp_max", "lmp_stddev", "energy_component_avg",
                      "congestion_component_avg", "loss_component_avg", "interval_count", "source_system",
                      "loaded_at")


def score_stream(hourly: DataFrame, thresholds: DataFrame) -> DataFrame:
    """S-3: arriving hours against stored per-hub thresholds (stream-static join; the static
    side has one row per hub and is broadcast by size)."""
    j = hourly.join(F.broadcast(thresholds), "trading_hub", "left")
    lmp = F.col("lmp_avg")
    return j.select("hour_utc", "trading_hub", "market", "lmp_avg", "lmp_p95_threshold", "lmp_p99_threshold",
                    spike_flag(lmp, F.col("lmp_p95_threshold")).alias("price_spike_flag"),
                    stress_severity(lmp, F.col("lmp_p95_threshold"), F.col("lmp_p99_threshold"),
                                    F.col("lmp_historical_mean"), F.col("lmp_historical_stddev"))
                    .alias("stress_severity"))


def run_to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drive a streaming frame to completion over what has landed (availableNow) into a memory
    table and return it as a batch DataFrame (tests and small reports)."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drive a streaming frame over what has landed into a Parquet file sink (exactly-once,
    restartable from ``checkpoint``) and return the sink's contents as a batch DataFrame."""
    q = (df.writeStream.format("parquet").option("path", path).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(path)


@dataclass
class Progress:
    """What a run did: micro-batches that ended, rows read, rows that came after the watermark and were left out."""

    batches: int
    rows: int
    late_rows: int


def drive(df: DataFrame, path: str, checkpoint: str, stop_after: int | None = None) -> Progress:
    """Drive a streaming frame over what has landed into a Parquet file sink and say what was done with it.

    ``stop_after``: stop once so many micro-batches have ended (as a lost driver would, also in the middle of the next
    one). State, offsets and the sink's commits lie in ``checkpoint`` and beside the sink, so the next run with the same folders goes
    on where the last committed batch ended; state keeps the number of partitions that it was begun with, whatever
    the session's setting and the input's files are then."""
    q = (df.writeStream.format("parquet").option("path", path).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        while not q.awaitTermination(0.1):
            if stop_after and len([p for p in q.recentProgress if p["numInputRows"]]) >= stop_after:
                break
    finally:
        q.stop()
    done = q.recentProgress
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in done for op in p["stateOperators"])
    return Progress(len(done), sum(p["numInputRows"] for p in done), late)
