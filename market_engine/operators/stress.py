"""Per-hub thresholds and hour classification."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.operators.features import OPS_COLS, PRICE_COLS
from market_engine.session import materialise_frame


def _qname(q: float) -> str:
    return f"lmp_p{round(q * 100):d}_threshold"


def hub_thresholds(features: DataFrame, quantiles: Sequence[float] = (0.95, 0.99), value: str = "lmp_avg",
                   key: str = "trading_hub", exact: bool = True, accuracy: int = 10000,
                   method: str = "distributed") -> DataFrame:
    """D-2: per-hub percentile thresholds (interpolated, like ``percentile_cont``), mean, stddev.

    ``method="aggregate"``: ``percentile(x, array(...))``, one buffer per hub holding its
    distinct values (partial-aggregated per task, merged per hub).
    ``method="distributed"``: the same exact values without a per-hub buffer
    (``exact_percentiles``).
    ``exact=False``: the mergeable sketch ``percentile_approx``, state bounded by ``accuracy``.
    """
    stats = features.groupBy(key).agg(F.avg(value).alias("lmp_historical_mean"),
                                      F.stddev_samp(value).alias("lmp_historical_stddev"))
    if exact and method == "distributed":
        q = exact_percentiles(features, quantiles, value, key)
        # every hub stays: one whose prices are all NULL has NULL thresholds
        return stats.join(q, key, "left").select(key, *[_qname(x) for x in quantiles],
                                         "lmp_historical_mean", "lmp_historical_stddev")
    qs = F.array(*[F.lit(float(q)) for q in quantiles])
    pct = F.percentile(value, qs) if exact else F.percentile_approx(value, qs, accuracy)
    agg = features.groupBy(key).agg(
        pct.alias("_q"),
        F.avg(value).alias("lmp_historical_mean"),
        F.stddev_samp(value).alias("lmp_historical_stddev"),
    )
    return agg.select(key, *[F.col("_q")[i].cast("double").alias(_qname(q)) for i, q in enumerate(quantiles)],
                      "lmp_historical_mean", "lmp_historical_stddev")


def exact_percentiles(df: DataFrame, quantiles: Sequence[float], value: str, key: str,
                      buckets: int = 256) -> DataFrame:
    """Exact interpolated percentiles per key with no per-key buffer or sort.

    1. distinct (key, value) with counts: a value repeated a million times is one row;
    2. rows before each distinct value (``ranking.distributed_running_count`` over ``buckets`` value ranges per key,
       cut by a quantile sketch so that each holds about as many distinct values, see ``ranking.with_range``);
    3. for each quantile the two order statistics around position (n-1)q are the distinct
       values whose count range covers floor/ceil of the position; they are interpolated with
       weights (ceil - pos), (pos - floor) — the same arithmetic as Spark's ``percentile``.
    """
    from market_engine.operators.ranking import distributed_running_count, with_range
    v = materialise_frame(df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_c")))
    v = with_range(v, [key], value, F.sum("_c").alias("_n"), buckets=buckets)
    ranked = distributed_running_count(v, [key], "_bkt", [F.col(value)], "_c", "_before")
    cols = []
    for i, q in enumerate(quantiles):
        pos = (F.col("_n") - 1) * float(q)
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        covers = lambda idx: (F.col("_before") <= idx) & (idx < F.col("_before") + F.col("_c"))
        cols += [F.max(F.when(covers(lo_i), F.col(value))).alias(f"_lo{i}"),
                 F.max(F.when(covers(hi_i), F.col(value))).alias(f"_hi{i}"),
                 F.max(pos).alias(f"_pos{i}")]
    picked = ranked.groupBy(key).agg(*cols)
    out = []
    for i, q in enumerate(quantiles):
        lo, hi, pos = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_pos{i}")
        interp = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        out.append(F.when((F.floor(pos) == F.ceil(pos)) | (lo == hi), lo).otherwise(interp).alias(_qname(q)))
    return picked.select(key, *out)


def spike_flag(lmp: Column, p95: Column) -> Column:
    """B-12: 1 when the hour's price is at or above the hub's p95 (``>=``), else 0; NULL -> 0."""
    return F.when(lmp >= p95, F.lit(1)).otherwise(F.lit(0))


def stress_severity(lmp: Column, p95: Column, p99: Column, mean: Column, stddev: Column) -> Column:
    """B-13: ordered CASE; a NULL comparison falls through (NULL stddev never gives ELEVATED)."""
    return (F.when(lmp >= p99, "EXTREME")
            .when(lmp >= p95, "SPIKE")
            .when(lmp >= mean + stddev, "ELEVATED")
            .otherwise("NORMAL"))


def attach_thresholds(features: DataFrame, thresholds: DataFrame, key: str = "trading_hub") -> DataFrame:
    """C-2: features LEFT JOIN thresholds on the hub.

    The threshold side is an aggregate keyed by hub: one row per hub, a bound set by the hub
    dimension (a few to thousands of rows of five numbers), not by the length of the history.
    It is broadcast, so the feature table is joined where it lies, without a shuffle (left to
    AQE, the hub shuffle of the features would already have run before AQE saw the real size).
    """
    return features.join(F.broadcast(thresholds), key, "left")


def classify(features: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Mart: each hour and hub with thresholds, spike flag and severity label."""
    j = attach_thresholds(features, thresholds)
    lmp = F.col("lmp_avg")
    lag_cols = [c for c in features.columns if c.startswith("lmp_lag_")]
    return j.select(
        "hour_utc", "trading_hub", *PRICE_COLS,
        "lmp_p95_threshold", "lmp_p99_threshold", "lmp_historical_mean", "lmp_historical_stddev",
        spike_flag(lmp, F.col("lmp_p95_threshold")).alias("price_spike_flag"),
        stress_severity(lmp, F.col("lmp_p95_threshold"), F.col("lmp_p99_threshold"),
                        F.col("lmp_historical_mean"), F.col("lmp_historical_stddev")).alias("stress_severity"),
        *OPS_COLS, *lag_cols,
        "hour_of_day", "day_of_week", "is_weekend", "month", "year",
    )


def market_stress(features: DataFrame, quantiles: Sequence[float] = (0.95, 0.99), exact: bool = True,
                  method: str = "distributed", prices: DataFrame | None = None) -> DataFrame:
    """D-2 -> C-2 -> B-12/B-13 over the feature table (static thresholds over the full history). ``prices``: rows with
    the same hubs and prices that are cheaper to read than the features, for the thresholds."""
    return classify(features, hub_thresholds(features if prices is None else prices, quantiles, exact=exact, method=method))


def rolling_threshold(features: DataFrame, days: int = 30, q: float = 0.95, value: str = "lmp_avg",
                      key: str = "trading_hub", order: str = "hour_utc", method: str = "sorted") -> DataFrame:
    """E-7: time-aware threshold: percentile of the hub's last ``days`` days (RANGE frame, incl. the row and its peers).

    Rows are partitioned by (hub, block of ``days`` days); each row is also copied into the next block, so every frame is
    complete inside one (hub, block) group, a group holds two frames, and no task holds a hub.
    ``method="sorted"``: a group keeps its frame's values in order; moving on by one row adds and removes the difference, so
    the cost is linear in the rows. ``"halo"``: the same groups with Spark's windowed ``percentile``, which counts each
    row's frame anew; ``"window"``: one window per hub. Both serve comparison.
    """
    out_name = f"rolling_p{round(q * 100):d}_{days}d"
    # RANGE frames with an interval bound are expressed in SQL; the DataFrame API only takes numbers.
    def frame(part: str) -> F.Column:
        return F.expr(f"percentile({value}, {float(q)}) OVER (PARTITION BY {part} ORDER BY {order} "
                      f"RANGE BETWEEN INTERVAL {int(days)} DAYS PRECEDING AND CURRENT ROW)")
    if method == "window":
        return features.select(key, order, value, frame(key).alias(out_name))
    if method not in ("halo", "sorted"):
        raise ValueError(f"method must be 'sorted', 'halo' or 'window', got {method!r}")
    span = days * 86400
    secs = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(order))
    own = F.floor(secs / span)
    # the next block's frames reach back ``days`` days: rows in the last ``days`` of a block are
    # exactly the whole block when block length == frame length, so copy every row once
    rows = features.select(key, order, value, own.alias("_own"))
    both = rows.select(key, order, value, "_own", F.explode(F.array(F.col("_own"), F.col("_own") + 1)).alias("_blk"))
    if method == "halo":
        res = both.select(key, order, value, "_own", "_blk", frame(f"{key}, _blk").alias(out_name))
        return res.filter(F.col("_own") == F.col("_blk")).select(key, order, value, out_name)
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(order))
    schema = features.select(key, order, value).schema.add(out_name, "double")
    return both.withColumn("_at", at).groupBy(key, "_blk").applyInPandas(
        _rolling_group(key, order, value, out_name, span * 1_000_000, float(q)), schema)


def sliding_percentiles(times: Sequence[int], values: Sequence[float | None], span: int, q: float) -> list[float | None]:
    """For each row, in time order, the interpolated percentile of the values at times within ``span`` before it and up to its own."""
    held: list[float] = []
    out: list[float | None] = []
    begin = end = 0
    for t in times:
        while end < len(times) and times[end] <= t:
            if values[end] is not None:
                insort(held, values[end])
            end += 1
        while times[begin] < t - span:
            if values[begin] is not None:
                del held[bisect_left(held, values[begin])]
            begin += 1
        if not held:
            out.append(None)
            continue
        pos = (len(held) - 1) * q
        lo, hi = held[math.floor(pos)], held[math.ceil(pos)]
        out.append(lo if lo == hi else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi)
    return out


def _rolling_group(key: str, order: str, value: str, name: str, span: int, q: float):
    def work(group):
        group = group.sort_values("_at", kind="stable")
        values = [None if x is None or x != x else float(x) for x in group[value].tolist()]
        group[name] = sliding_percentiles(group["_at"].tolist(), values, span, q)
        return group.loc[group["_own"] == group["_blk"], [key, order, value, name]]
    return work
