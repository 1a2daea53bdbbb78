"""Validation and reporting queries over the raw tables and the mart.

All are aggregations or filters planned by Catalyst; scalars such as "latest hour" are
scalar subqueries (computed once, no join). Sorting happens only where the sort is the
feature (samples, top-N); everything else leaves order to the reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_engine.constants import SEVERITIES
from market_engine.functions import ratio, round_half_away, stable

SEVERITY_RANK = {s: i for i, s in enumerate(SEVERITIES)}


def severity_rank(c="stress_severity") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    expr = F.when(col == SEVERITIES[0], 0)
    for s, i in list(SEVERITY_RANK.items())[1:]:
        expr = expr.when(col == s, i)
    return expr


def severity_label(rank: Column) -> Column:
    expr = F.when(rank == 0, SEVERITIES[0])
    for s, i in list(SEVERITY_RANK.items())[1:]:
        expr = expr.when(rank == i, s)
    return expr


# ---------------------------------------------------------------- validation worksheet
def row_count(df: DataFrame) -> DataFrame:
    """D-5."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def coverage(df: DataFrame, key: str, ts: str, prefix: str = "") -> DataFrame:
    """D-6 / D-7: per key: row count, earliest and latest timestamp."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"),
                               F.min(ts).alias(f"earliest{prefix}"), F.max(ts).alias(f"latest{prefix}"))


def mart_summary(stress: DataFrame) -> DataFrame:
    """D-8: per hub: rows, rounded avg/min/max price, spike hours, distinct severities."""
    return stress.groupBy("trading_hub").agg(
        F.count(F.lit(1)).alias("row_count"),
        round_half_away(F.avg("lmp_avg"), 2).alias("avg_lmp"),
        round_half_away(F.min("lmp_avg"), 2).alias("min_lmp"),
        round_half_away(F.max("lmp_avg"), 2).alias("max_lmp"),
        F.sum("price_spike_flag").cast("bigint").alias("spike_hours"),
        F.countDistinct("stress_severity").alias("severity_levels"),
    )


def severity_distribution(stress: DataFrame, ordered: bool = False) -> DataFrame:
    """D-9 + E-3 (+ F-3 when ``ordered``): hours per severity and share of all hours (1 dp).

    The share uses an unpartitioned window over the aggregated rows (at most 4), not the input.
    """
    g = stress.groupBy("stress_severity").agg(F.count(F.lit(1)).alias("hour_count"))
    total = F.sum("hour_count").over(Window.partitionBy())
    out = g.select("stress_severity", "hour_count",
                   round_half_away(F.col("hour_count") * 100.0 / total, 1).alias("pct_of_total"))
    return out.orderBy(F.col("hour_count").desc(), "stress_severity") if ordered else out


def sample_rows(df: DataFrame, order: Sequence[str], n: int, cols: Sequence[str] | None = None) -> DataFrame:
    """F-1: first ``n`` rows by ``order`` (TakeOrderedAndProject: per-task top-n, then merge).

    Callers pass a tie-break so the sample is deterministic.
    """
    out = df.orderBy(*order).limit(n)
    return out.select(*cols) if cols else out


def top_hours(stress: DataFrame, n: int = 10) -> DataFrame:
    """E-6 / R-9: the ``n`` highest-price hours with their rank (ties broken by hour, hub)."""
    top = stress.orderBy(F.col("lmp_avg").desc(), "hour_utc", "trading_hub").limit(n)
    w = Window.orderBy(F.col("lmp_avg").desc(), "hour_utc", "trading_hub")
    return top.select(F.row_number().over(w).alias("rank"), "hour_utc", "trading_hub", "lmp_avg",
                      "stress_severity")


# ---------------------------------------------------------------- market overview
def last_days(stress: DataFrame, days: int = 7) -> DataFrame:
    """R-1: hourly prices per hub over the last ``days`` days of data."""
    latest = stress.select(F.max("hour_utc")).scalar()
    cut = F.timestamp_add("DAY", F.lit(-days), latest)
    return stress.filter(F.col("hour_utc") > cut).select("hour_utc", "trading_hub", "lmp_avg")


def current_vs_threshold(stress: DataFrame) -> DataFrame:
    """R-2: each hub's latest hour against its p95 threshold."""
    g = stress.groupBy("trading_hub").agg(
        F.max("hour_utc").alias("latest_hour"),
        F.max_by("lmp_avg", "hour_utc").alias("current_lmp"),
        F.max("lmp_p95_threshold").alias("lmp_p95_threshold"),
    )
    return g.select("*", (F.col("current_lmp") >= F.col("lmp_p95_threshold")).alias("above_threshold"))


def daily_average(stress: DataFrame) -> DataFrame:
    """R-3: daily average price per hub."""
    return stress.groupBy(F.to_date("hour_utc").alias("day"), "trading_hub").agg(
        F.avg("lmp_avg").alias("avg_lmp"), F.count(F.lit(1)).alias("hours"))


def component_breakdown(stress: DataFrame) -> DataFrame:
    """R-4: average price components per hour across hubs, as long rows (component, value)."""
    g = stress.groupBy("hour_utc").agg(F.avg("energy_component_avg").alias("energy"),
                                       F.avg("congestion_component_avg").alias("congestion"),
                                       F.avg("loss_component_avg").alias("loss"))
    return g.selectExpr("hour_utc", "stack(3, 'energy', energy, 'congestion', congestion, 'loss', loss) "
                                    "as (component, component_value)")


def freshness(stg_prices: DataFrame) -> DataFrame:
    """R-5: last load time and last hour per hub and market."""
    return stg_prices.groupBy("trading_hub", "market").agg(F.max("loaded_at").alias("last_loaded_at"),
                                                           F.max("hour_utc").alias("last_hour"))


def apply_filters(df: DataFrame, hubs: Sequence[str] | None = None, start: str | None = None,
                  end: str | None = None, severities: Sequence[str] | None = None,
                  weekend: bool | None = None, markets: Sequence[str] | None = None) -> DataFrame:
    """R-6: the dashboards' common filters, AND-ed; absent filters are no-ops."""
    conds = []
    if hubs is not None:
        conds.append(F.col("trading_hub").isin(list(hubs)))
    if start is not None:
        conds.append(F.col("hour_utc") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        conds.append(F.col("hour_utc") < F.timestamp_add("DAY", F.lit(1), F.lit(end).cast("timestamp_ntz")))
    if severities is not None:
        conds.append(F.col("stress_severity").isin(list(severities)))
    if weekend is not None:
        conds.append(F.col("is_weekend") == F.lit(weekend))
    if markets is not None:
        conds.append(F.col("market").isin(list(markets)))
    for c in conds:
        df = df.filter(c)
    return df


# ---------------------------------------------------------------- stress monitor
def spike_calendar(stress: DataFrame) -> DataFrame:
    """R-7: day x hour-of-day grid of the worst severity across hubs (24 pivoted columns)."""
    g = stress.select(F.to_date("hour_utc").alias("day"), "hour_of_day", severity_rank().alias("_r"))
    wide = g.groupBy("day").pivot("hour_of_day", list(range(24))).agg(F.max("_r"))
    return wide.select("day", *[severity_label(F.col(f"`{h}`")).alias(f"h{h:02d}") for h in range(24)])


def flag_series(stress: DataFrame) -> DataFrame:
    """R-8: spike flag time series with severity and its ordinal."""
    return stress.select("hour_utc", "trading_hub", "lmp_avg", "price_spike_flag", "stress_severity",
                         severity_rank().alias("severity_rank"))


def congestion_during_spikes(stress: DataFrame) -> DataFrame:
    """R-10: congestion share of the price in spike hours, per hub."""
    s = stress.filter(F.col("price_spike_flag") == 1)
    return s.groupBy("trading_hub").agg(
        F.count(F.lit(1)).alias("spike_hours"),
        F.avg("congestion_component_avg").alias("avg_congestion"),
        F.avg(ratio(F.col("congestion_component_avg"), F.col("lmp_avg"))).alias("avg_congestion_share"),
    )


def demand_vs_generation(stress: DataFrame) -> DataFrame:
    """R-11: demand, net generation and their gap, spike vs non-spike hours, per hub."""
    return stress.groupBy("trading_hub", "price_spike_flag").agg(
        F.count(F.lit(1)).alias("hours"),
        F.avg("demand_mwh").alias("avg_demand_mwh"),
        F.avg("net_generation_mwh").alias("avg_net_generation_mwh"),
        F.avg("demand_supply_gap_mwh").alias("avg_gap_mwh"),
    )


def spike_heatmap(stress: DataFrame) -> DataFrame:
    """R-12: spike frequency by hour of day x day of week."""
    return stress.groupBy("hour_of_day", "day_of_week").agg(
        F.avg("price_spike_flag").alias("spike_rate"), F.count(F.lit(1)).alias("hours"))


# ---------------------------------------------------------------- forecasting panels
def seasonal_naive(stress: DataFrame, lag_col: str = "lmp_lag_24h") -> DataFrame:
    """R-13: predicted (same hour yesterday) vs actual price."""
    return stress.select("hour_utc", "trading_hub", F.col("lmp_avg").alias("actual_lmp"),
                         F.col(lag_col).alias("predicted_lmp"),
                         (F.col("lmp_avg") - F.col(lag_col)).alias("forecast_error"))


def probability_by_hour(predictions: DataFrame) -> DataFrame:
    """R-14: average predicted spike probability per hour of day."""
    return predictions.groupBy(F.hour("hour_utc").alias("hour_of_day")).agg(
        F.avg("predicted_spike_probability").alias("avg_spike_probability"), F.count(F.lit(1)).alias("rows"))


def error_histogram(errors: DataFrame, width: float = 5.0, col: str = "forecast_error") -> DataFrame:
    """R-15: histogram of actual - predicted in buckets of ``width``."""
    b = (F.floor(F.col(col) / width) * width).cast("double")
    return errors.filter(F.col(col).isNotNull()).groupBy(b.alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("n"))


def lag_trend(stress: DataFrame) -> DataFrame:
    """R-16: price and its lags as long rows (series, value); NULL lags kept."""
    return stress.selectExpr(
        "hour_utc", "trading_hub",
        "stack(4, 'lmp_avg', lmp_avg, 'lmp_lag_1h', lmp_lag_1h, 'lmp_lag_24h', lmp_lag_24h, "
        "'lmp_lag_168h', lmp_lag_168h) as (series, series_value)")


# ---------------------------------------------------------------- recommendations
def recurring_patterns(stress: DataFrame) -> DataFrame:
    """R-17: per hub, the hour of day and the month with the highest spike rate (ties -> earliest)."""
    def peak(dim: str) -> DataFrame:
        g = stress.groupBy("trading_hub", dim).agg(F.avg("price_spike_flag").alias("rate"))
        w = Window.partitionBy("trading_hub").orderBy(F.col("rate").desc(), F.col(dim))
        return (g.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
                .select("trading_hub", F.col(dim).alias(f"peak_{dim}"), F.col("rate").alias(f"peak_{dim}_rate")))
    return peak("hour_of_day").join(peak("month"), "trading_hub")


def stress_correlations(stress: DataFrame) -> DataFrame:
    """R-18: per hub, correlation of forecast error and supply gap with the spike flag."""
    flag = F.col("price_spike_flag").cast("double")
    return stress.groupBy("trading_hub").agg(
        F.corr("demand_forecast_error_mwh", flag).alias("corr_forecast_error_spike"),
        F.corr("demand_supply_gap_mwh", flag).alias("corr_gap_spike"))


def cost_premium(stress: DataFrame) -> DataFrame:
    """R-19: average price in spike vs non-spike hours, and the premium."""
    spike = F.col("price_spike_flag") == 1
    g = stress.groupBy("trading_hub").agg(
        F.avg(F.when(spike, F.col("lmp_avg"))).alias("avg_lmp_spike"),
        F.avg(F.when(~spike, F.col("lmp_avg"))).alias("avg_lmp_normal"))
    return g.select("*", (F.col("avg_lmp_spike") - F.col("avg_lmp_normal")).alias("premium"),
                    ratio(F.col("avg_lmp_spike"), F.col("avg_lmp_normal")).alias("premium_ratio"))


def hedging_windows(stress: DataFrame, min_rate: float = 0.1) -> DataFrame:
    """R-20: (hub, hour of day) whose historical spike frequency is at least ``min_rate``."""
    g = stress.groupBy("trading_hub", "hour_of_day").agg(
        F.avg("price_spike_flag").alias("spike_rate"), F.count(F.lit(1)).alias("hours"))
    return g.filter(F.col("spike_rate") >= min_rate)


def notable_hours(stress: DataFrame, z: float = 3.0) -> DataFrame:
    """R-21: hours whose price is at least ``z`` historical standard deviations from the hub mean."""
    s = stress.select("hour_utc", "trading_hub", "lmp_avg", F.try_divide(
        F.col("lmp_avg") - F.col("lmp_historical_mean"), F.col("lmp_historical_stddev")).alias("z_score"))
    return s.filter(F.abs(F.col("z_score")) >= z)


def highest_risk(stress: DataFrame) -> DataFrame:
    """R-22: the (hub, hour of day) with the highest spike rate (ties -> hub, then hour)."""
    g = stress.groupBy("trading_hub", "hour_of_day").agg(F.avg("price_spike_flag").alias("spike_rate"))
    return g.orderBy(F.col("spike_rate").desc(), "trading_hub", "hour_of_day").limit(1)


def coverage_stats(stress: DataFrame) -> DataFrame:
    """R-23: per hub: hours, first and last hour, distinct days."""
    return stress.groupBy("trading_hub").agg(
        F.count(F.lit(1)).alias("hours"), F.min("hour_utc").alias("first_hour"),
        F.max("hour_utc").alias("last_hour"), F.countDistinct(F.to_date("hour_utc")).alias("days"))


def stabilise(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: stable(c, digits) for c in cols})
