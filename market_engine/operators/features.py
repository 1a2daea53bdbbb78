"""Hourly feature table: prices joined with operations, lags, calendar parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from market_engine.constants import DEFAULT_BA, DEFAULT_LAGS, DEFAULT_MARKET
from market_engine.functions import calendar_columns
from market_engine.operators.ranking import distributed_row_number, with_neighbours
from market_engine.session import materialise_frame

PRICE_COLS = ["lmp_avg", "lmp_min", "lmp_max", "lmp_stddev",
              "energy_component_avg", "congestion_component_avg", "loss_component_avg"]
OPS_COLS = ["demand_mwh", "demand_forecast_mwh", "net_generation_mwh", "interchange_mwh",
            "demand_supply_gap_mwh", "demand_forecast_error_mwh"]


def join_ops(prices: DataFrame, ops: DataFrame, on: str = "hour_utc") -> DataFrame:
    """C-1: prices LEFT JOIN operations on the hour (many hubs : one operations row).

    No hint: the planner broadcasts the operations side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time); otherwise both sides
    are hash-partitioned on the hour.
    """
    p = prices.select(on, "trading_hub", *PRICE_COLS)
    o = ops.select(on, *OPS_COLS)
    return p.join(o, on, "left")


def lag_name(n: int, value: str = "lmp_avg") -> str:
    return f"{value.replace('_avg', '')}_lag_{n}h"


def add_lags(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, value: str = "lmp_avg",
             key: str = "trading_hub", order: str = "hour_utc", mode: str = "rows",
             method: str = "join", stored: bool = False) -> DataFrame:
    """E-1 / C-4: previous values of ``value`` per ``key``.

    ``mode="rows"`` (reference semantics): offset by rows; a missing hour shifts every lag.
      ``method="join"``: exact distributed row numbers (bucketed by day), then ``lag`` over blocks of row numbers
      that hold copies of the rows before them; no task holds a whole hub. The input is materialised once. ``method="window"``: ``lag`` over one
      shared window per hub (one sort, one task per hub; fine for short histories).
    ``mode="time"``: exact ``order - n hours`` via one exploded equi join on (key, hour). Should
    an hour hold several rows (two source systems, T5), its largest value is taken instead of
    multiplying the target rows.
    """
    if mode == "rows" and method == "window":
        w = Window.partitionBy(key).orderBy(order)
        return df.withColumns({lag_name(n, value): F.lag(value, n).over(w) for n in lags})
    if mode == "rows" and method == "join":
        # the input is read twice (counts a day, rows); materialise it once so the upstream roll-up is not
        # recomputed per branch
        df = df if stored else materialise_frame(df)
        ranked = distributed_row_number(df, [key], F.to_date(order), [F.col(order)], "_rn")
        rows, w, own = with_neighbours(ranked, [key], back=max(lags))
        out = rows.select("*", *[F.lag(value, n).over(w).alias(lag_name(n, value)) for n in lags]).filter(own)
        return out.select(*df.columns, *[lag_name(n, value) for n in lags])
    if mode == "time":
        # each hour offers its value to the hours n later; aggregated on (key, target hour), whose
        # hash partitioning is what the join back needs. The input is read twice: materialise it.
        df = df if stored else materialise_frame(df)
        offers = df.select(key, F.col(value).alias("_v"), F.explode(F.array(
            *[F.struct(F.timestamp_add("HOUR", F.lit(n), F.col(order)).alias("_t"), F.lit(n).alias("_n"))
              for n in lags])).alias("_o"))
        lagged = offers.groupBy(key, F.col("_o._t").alias(order)).agg(
            *[F.max(F.when(F.col("_o._n") == n, F.col("_v"))).alias(lag_name(n, value)) for n in lags])
        out = df.join(lagged, [key, order], "left")
        return out.select(*df.columns, *[lag_name(n, value) for n in lags])
    raise ValueError(f"unsupported lag mode/method {mode!r}/{method!r}")


def add_calendar(df: DataFrame, ts: str = "hour_utc", week_start: str = "monday") -> DataFrame:
    """H-2, H-3: hour_of_day, day_of_week, is_weekend, month, year."""
    return df.withColumns(calendar_columns(ts, week_start))


def joined_prices(stg_prices: DataFrame, stg_ops: DataFrame, market: str = DEFAULT_MARKET,
                  balancing_authority: str = DEFAULT_BA) -> DataFrame:
    """Prices of ``market`` with the operations of the authority. Filters (B-7) sit below the join and are pushed into the
    scans by Catalyst."""
    return join_ops(stg_prices.filter(F.col("market") == market), stg_ops.filter(F.col("balancing_authority") == balancing_authority))


def market_features(stg_prices: DataFrame, stg_ops: DataFrame, market: str = DEFAULT_MARKET,
                    balancing_authority: str = DEFAULT_BA, lags: Sequence[int] = DEFAULT_LAGS,
                    lag_mode: str = "rows", week_start: str = "monday", lag_method: str = "join") -> DataFrame:
    """Intermediate feature table: one row per (hour, hub) of ``market``."""
    return features_of(joined_prices(stg_prices, stg_ops, market, balancing_authority), lags, lag_mode, week_start, lag_method)


def features_of(joined: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, lag_mode: str = "rows", week_start: str = "monday",
                lag_method: str = "join", stored: bool = False) -> DataFrame:
    """The feature table of joined rows; ``stored``: they are a table already."""
    lagged = add_lags(joined, lags, mode=lag_mode, method=lag_method, stored=stored)
    out = add_calendar(lagged, week_start=week_start)
    lag_cols = [lag_name(n) for n in lags]
    return out.select("hour_utc", "trading_hub", *PRICE_COLS, *OPS_COLS, *lag_cols,
                      "hour_of_day", "day_of_week", "is_weekend", "month", "year")
