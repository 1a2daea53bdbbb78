"""D-2 without reading the history again: a quantile sketch per hub and day, stored and merged.

A day's prices of a hub become one row: their number, mean, sum of squared deviations, and a KLL sketch (a built-in,
mergeable aggregate whose size depends on ``k`` and only logarithmically on the rows). Days are partitions, so a new or
rerun day writes its own rows and nothing else; thresholds merge the stored rows of any range of days.

A sketch's quantile is a stored value whose rank is off by at most ``rank_error(k)`` (99 % confidence, the sketch's
published bound); a hub with fewer values than about k keeps all of them. Mean and standard deviation are merged exactly
(up to floating point) by the parallel formula. NULL prices are ignored; a hub whose prices are all NULL has NULL thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.operators.stress import _qname
from market_engine.sinks.tables import replace_partitions

DAY = "price_day"
SKETCH_K = 1024


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of a merged sketch's rank error, as a share of the rows (published for KLL sketches)."""
    return 2.296 / k ** 0.9723


def daily_sketches(rows: DataFrame, value: str = "lmp_avg", key: str = "trading_hub", order: str = "hour_utc", k: int = SKETCH_K) -> DataFrame:
    """One row per hub and day: n, mean, m2 and the sketch of its prices."""
    x = F.col(value).cast("double")
    return rows.groupBy(key, F.to_date(order).alias(DAY)).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.kll_sketch_agg_double(x, k).alias("sketch"))


def store_days(rows: DataFrame, path: str, **names) -> int:
    """Sketch the days that ``rows`` hold, whole days of all hubs, and replace just those in the store."""
    return replace_partitions(daily_sketches(rows, **names), path, [DAY])


def thresholds_from(spark: SparkSession, path: str, quantiles: Sequence[float] = (0.95, 0.99), key: str = "trading_hub",
                    first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The columns of ``stress.hub_thresholds`` from the stored days (of a range, read by partition), plus ``n``."""
    days = spark.read.parquet(path)
    if first_day:
        days = days.filter(F.col(DAY) >= F.lit(first_day).cast("date"))
    if last_day:
        days = days.filter(F.col(DAY) <= F.lit(last_day).cast("date"))
    total = days.groupBy(key).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("_sum"),
                                  F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("_all"))
    mean = F.try_divide("_sum", "n")
    # deviations of the days' means from the hub's: one row a hub is joined back to one row a hub and day
    spread = days.join(total.select(key, mean.alias("_mean")), key).groupBy(key).agg(
        F.sum(F.coalesce(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2, F.lit(0.0))).alias("_m2"))
    any_price = F.col("n") > 0
    at = [F.when(any_price, F.kll_sketch_get_quantile_double("_all", F.lit(float(q)))).alias(_qname(q)) for q in quantiles]
    return total.join(spread, key).select(
        key, *at, mean.alias("lmp_historical_mean"), F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1))).alias("lmp_historical_stddev"), "n")


def within_bound(rows: DataFrame, thresholds: DataFrame, quantiles: Sequence[float] = (0.95, 0.99), value: str = "lmp_avg",
                 key: str = "trading_hub", k: int = SKETCH_K) -> DataFrame:
    """Per hub and quantile whether the threshold's rank among ``rows`` (between the share of values below it and the share not
    above it) is off by no more than the bound and one row."""
    long = thresholds.select(key, F.explode(F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.col(_qname(q)).alias("threshold")) for q in quantiles])
                                            ).alias("t")).select(key, "t.*")
    x = F.col(value)
    seen = rows.filter(x.isNotNull()).select(key, value).join(long, key).groupBy(key, "quantile").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(x < F.col("threshold")).alias("below"), F.count_if(x <= F.col("threshold")).alias("upto"))
    slack = F.lit(rank_error(k)) * F.col("n") + 1
    return seen.select(key, "quantile", "n", ((F.col("below") - slack <= F.col("quantile") * F.col("n")) & (
        F.col("quantile") * F.col("n") <= F.col("upto") + slack)).alias("within_bound"))
