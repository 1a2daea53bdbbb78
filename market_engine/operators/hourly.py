"""Hourly roll-up of 5-minute prices, long->wide pivots, staging of operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.constants import OPS_CODES, PRICE_ITEMS
from market_engine.functions import clean_key, exact_avg, hour_bucket, try_double
from market_engine.schemas import LMP_5MIN


def _avg(c: str, decimals: int | None):
    return F.avg(c) if decimals is None else exact_avg(c, decimals)


def hourly_prices(raw: DataFrame, decimals: int | None = 5) -> DataFrame:
    """D-1: 5-minute prices -> one row per (hour, hub, market, source_system).

    One hash aggregate with map-side partial aggregation: each task pre-aggregates its rows
    before the shuffle, so shuffle volume is bounded by groups per task, not input rows.
    ``decimals`` selects the exact fixed-point average (default) or a float ``avg`` (None).
    """
    src = raw.filter(F.col("interval_start").isNotNull() & F.col("trading_hub").isNotNull())
    return (
        src.groupBy(
            hour_bucket("interval_start").alias("hour_utc"),
            clean_key("trading_hub").alias("trading_hub"),
            clean_key("market").alias("market"),
            F.col("source_system"),
        )
        .agg(
            _avg("lmp", decimals).alias("lmp_avg"),
            F.min("lmp").alias("lmp_min"),
            F.max("lmp").alias("lmp_max"),
            F.stddev_samp("lmp").alias("lmp_stddev"),
            _avg("energy_component", decimals).alias("energy_component_avg"),
            _avg("congestion_component", decimals).alias("congestion_component_avg"),
            _avg("loss_component", decimals).alias("loss_component_avg"),
            F.count(F.lit(1)).alias("interval_count"),
            F.max("loaded_at").alias("loaded_at"),
        )
        .select("hour_utc", "trading_hub", "market", "lmp_avg", "lmp_min", "lmp_max", "lmp_stddev",
                "energy_component_avg", "congestion_component_avg", "loss_component_avg",
                "interval_count", "source_system", "loaded_at")
    )


def _pivot_first(long: DataFrame, keys: Sequence[str], code_col: str, value_col: str, seq_col: str,
                 codes: Mapping[str, str]) -> DataFrame:
    """First non-NULL value per (keys, code), by ``seq_col``; one column per known code.

    Unknown codes and NULL / unparsable values are dropped first, so a group whose values are
    all NULL disappears (as in a pivot table). Explicit pivot values avoid a distinct-values job.
    """
    v = try_double(value_col)
    src = (long.filter(F.col(code_col).isin(list(codes)))
           .select(*keys, F.col(code_col).alias("_code"), v.alias("_v"), F.col(seq_col).alias("_seq"))
           .filter(F.col("_v").isNotNull()))
    wide = src.groupBy(*keys).pivot("_code", list(codes)).agg(F.min_by("_v", "_seq"))
    return wide.select(*keys, *[F.col(f"`{k}`").alias(name) for k, name in codes.items()])


def pivot_prices(long: DataFrame, item_col: str = "item", value_col: str = "value", seq_col: str = "seq",
                 keys: Sequence[str] = ("interval_start", "interval_end", "trading_hub")) -> DataFrame:
    """D-3: long price items (LMP, MCE, MCC, MCL) -> one row per interval with four columns."""
    return _pivot_first(long, list(keys), item_col, value_col, seq_col, PRICE_ITEMS)


def pivot_ops(long: DataFrame, type_col: str = "type", value_col: str = "value", seq_col: str = "seq",
              keys: Sequence[str] = ("period", "respondent")) -> DataFrame:
    """D-4: long operations codes (D, DF, NG, TI) -> one row per (period, respondent).

    Keyed on the respondent as well as the period, so several balancing authorities in one
    input stay separate rows.
    """
    return _pivot_first(long, list(keys), type_col, value_col, seq_col, OPS_CODES)


def staged_ops(raw_ops: DataFrame) -> DataFrame:
    """Staging of operations: clean key, derived gap and forecast error, NULL keys dropped (B-3..B-6)."""
    return (
        raw_ops.filter(F.col("period").isNotNull() & F.col("balancing_authority").isNotNull())
        .select(
            F.col("period").alias("hour_utc"),
            clean_key("balancing_authority").alias("balancing_authority"),
            "demand_mwh", "demand_forecast_mwh", "net_generation_mwh", "interchange_mwh",
            (F.col("demand_mwh") - F.col("net_generation_mwh")).alias("demand_supply_gap_mwh"),
            (F.col("demand_mwh") - F.col("demand_forecast_mwh")).alias("demand_forecast_error_mwh"),
            "source_system", "loaded_at",
        )
    )


def union_frames(spark: SparkSession, frames: Sequence[DataFrame], schema=LMP_5MIN) -> DataFrame:
    """G-1: union-all by name of per-hub frames; no frames -> empty frame with ``schema``."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def time_rollup(df: DataFrame, ts: str, width: str, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Generic fixed-width time grain roll-up (D-1's shape for any table): ``measures`` maps
    output name -> SQL aggregate expression."""
    return df.groupBy(hour_bucket(ts, width).alias("bucket_start"), *keys).agg(
        *[F.expr(e).alias(n) for n, e in measures.items()])
