"""Dashboard projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.functions import round_half_away


def pct_above_threshold(lmp: Column, p95: Column) -> Column:
    """B-15: percent above the p95 threshold, 1 dp; NULL unless the threshold is positive."""
    return F.when(p95 > 0, round_half_away((lmp - p95) / p95 * 100, 1))


def dashboard_view(stress: DataFrame) -> DataFrame:
    """B-14 + B-16: BI-ready columns; prices 2 dp, MWh 0 dp, half away from zero; NULL prices dropped.

    No ORDER BY here: a stored table's order is not a guarantee, so readers sort.
    """
    r2 = lambda c, a=None: round_half_away(c, 2).alias(a or c)
    r0 = lambda c: round_half_away(c, 0).alias(c)
    return stress.filter(F.col("lmp_avg").isNotNull()).select(
        "hour_utc", "year", "month", "hour_of_day", "day_of_week", "is_weekend", "trading_hub",
        r2("lmp_avg", "lmp_avg_usd_mwh"), r2("lmp_min", "lmp_min_usd_mwh"), r2("lmp_max", "lmp_max_usd_mwh"),
        r2("lmp_stddev", "lmp_stddev_usd_mwh"), r2("lmp_p95_threshold", "spike_threshold_p95"),
        r2("lmp_p99_threshold", "spike_threshold_p99"),
        r2("energy_component_avg"), r2("congestion_component_avg"), r2("loss_component_avg"),
        "price_spike_flag", "stress_severity",
        r0("demand_mwh"), r0("demand_forecast_mwh"), r0("net_generation_mwh"), r0("interchange_mwh"),
        r0("demand_supply_gap_mwh"), r0("demand_forecast_error_mwh"),
        r2("lmp_lag_1h"), r2("lmp_lag_24h"), r2("lmp_lag_168h"),
        pct_above_threshold(F.col("lmp_avg"), F.col("lmp_p95_threshold")).alias("pct_above_spike_threshold"),
    )
