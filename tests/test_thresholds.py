"""Value ranges, stored threshold sketches, sliding percentiles, lags over blocks of row numbers."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from market_engine.operators import features as FE
from market_engine.operators import ranking, stress
from market_engine.operators import threshold_history as TH


@pytest.fixture(scope="module")
def pareto(spark):
    """Heavy-tailed values: equal-width ranges would put nearly all of them into one."""
    rng = np.random.default_rng(3)
    rows = [(h, float(v)) for h in ("A", "B") for v in (rng.pareto(0.7, 6000) + 1) * (1 if h == "A" else -5)]
    return spark.createDataFrame(rows + [("C", 1.0), ("D", None)], "trading_hub string, lmp_avg double").cache()


def test_no_range_is_over_twice_the_mean_on_a_pareto_column(pareto):
    v = pareto.filter("lmp_avg is not null").distinct()
    out = ranking.with_range(v, ["trading_hub"], "lmp_avg", buckets=64)
    sizes = out.groupBy("trading_hub", "_bkt").count().collect()
    for hub in ("A", "B"):
        own = [r["count"] for r in sizes if r.trading_hub == hub]
        assert max(own) <= 2 * 6000 / 64 and len(own) >= 60
    # ranges follow the values
    edges = sorted((r.trading_hub, r._bkt, r.lo, r.hi) for r in out.groupBy("trading_hub", "_bkt").agg(
        F.min("lmp_avg").alias("lo"), F.max("lmp_avg").alias("hi")).collect())
    assert all(a[3] < b[2] for a, b in zip(edges, edges[1:]) if a[0] == b[0])
    with pytest.raises(ValueError):
        ranking.splitters(v, [], "lmp_avg", buckets=100)


@pytest.mark.parametrize("few", [True, False])
def test_exact_percentiles_on_a_skewed_column(pareto, monkeypatch, few):
    if not few:
        monkeypatch.setattr(ranking, "BROADCAST_CUTS", 0)
    got = {r.trading_hub: r for r in stress.exact_percentiles(pareto, [0.05, 0.95, 0.99], "lmp_avg", "trading_hub").collect()}
    want = {r.trading_hub: r.q for r in pareto.groupBy("trading_hub").agg(
        F.percentile("lmp_avg", F.array(F.lit(0.05), F.lit(0.95), F.lit(0.99))).alias("q")).collect()}
    assert set(got) == {"A", "B", "C"}
    for hub, r in got.items():
        assert [r.lmp_p5_threshold, r.lmp_p95_threshold, r.lmp_p99_threshold] == want[hub]


def test_stored_sketches_follow_new_and_rerun_days(spark, pareto, tmp_path_run):
    path = os.path.join(tmp_path_run, "days")
    hours = F.timestamp_add("HOUR", F.pmod(F.xxhash64("lmp_avg"), F.lit(240)), F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = pareto.withColumn("hour_utc", hours).cache()
    first = F.col("hour_utc") < "2024-01-05"
    TH.store_days(rows.filter(first).withColumn("lmp_avg", F.col("lmp_avg") * 3), path, k=256)
    TH.store_days(rows.filter(~first), path, k=256)
    before = {r.trading_hub: r.lmp_p95_threshold for r in TH.thresholds_from(spark, path).collect()}
    TH.store_days(rows.filter(first), path, k=256)                      # the early days are corrected
    out = TH.thresholds_from(spark, path)
    assert out.columns == ["trading_hub", "lmp_p95_threshold", "lmp_p99_threshold", "lmp_historical_mean", "lmp_historical_stddev", "n"]
    judged = TH.within_bound(rows, out, k=256).collect()
    assert len(judged) == 6 and all(r.within_bound for r in judged) and before["A"] != {r.trading_hub: r for r in out.collect()}["A"].lmp_p95_threshold
    want = {r.trading_hub: r for r in stress.hub_thresholds(rows).collect()}
    for r in out.collect():
        w = want[r.trading_hub]
        for c in ("lmp_historical_mean", "lmp_historical_stddev"):
            assert (r[c] is None and w[c] is None) or r[c] == pytest.approx(w[c], rel=1e-9), (r.trading_hub, c)
    d = {r.trading_hub: r for r in out.collect()}["D"]
    assert d.n == 0 and d.lmp_p95_threshold is None
    assert TH.thresholds_from(spark, path, first_day="2024-01-02", last_day="2024-01-03").agg(F.sum("n")).first()[0] == rows.filter(
        "hour_utc >= '2024-01-02' and hour_utc < '2024-01-04' and lmp_avg is not null").count()


def test_sliding_percentiles_against_numpy():
    rng = random.Random(9)
    times = sorted(rng.randrange(200) for _ in range(150))              # with peers
    values = [None if rng.random() < 0.2 else rng.choice([1.0, 2.5, rng.gauss(0, 10)]) for _ in times]
    got = stress.sliding_percentiles(times, values, 25, 0.95)
    for i, t in enumerate(times):
        own = [v for u, v in zip(times, values) if t - 25 <= u <= t and v is not None]
        assert got[i] == (pytest.approx(np.percentile(own, 95)) if own else None), i


def test_rolling_forms_agree(spark):
    rng = random.Random(2)
    rows = [(f"H{h}", h, t, None if rng.random() < 0.1 else rng.gauss(30, 40)) for h in range(3) for t in sorted(rng.sample(range(0, 24 * 40), 300))]
    df = spark.createDataFrame(rows, "trading_hub string, x int, t int, lmp_avg double").select(
        "trading_hub", "lmp_avg", F.timestamp_add("HOUR", "t", F.lit("2023-12-20").cast("timestamp_ntz")).alias("hour_utc"))
    forms = [sorted(tuple(r) for r in stress.rolling_threshold(df, days=5, method=m).select("trading_hub", "hour_utc", "rolling_p95_5d").collect())
             for m in ("sorted", "halo", "window")]
    assert forms[0] == forms[1] == forms[2] and len(forms[0]) == 900


def test_lags_and_leads_over_blocks_equal_one_window(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(k, i, rng.random()) for k in "ab" for i in range(1, 1 + rng.randrange(60, 90))], "k string, _rn long, v double")
    rows, w, own = ranking.with_neighbours(df, ["k"], back=7, ahead=2, size=16)
    got = rows.select("k", "_rn", F.lag("v", 7).over(w).alias("a"), F.lead("v", 2).over(w).alias("b")).filter(own)
    one = Window.partitionBy("k").orderBy("_rn")
    want = df.select("k", "_rn", F.lag("v", 7).over(one).alias("a"), F.lead("v", 2).over(one).alias("b"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert FE.lag_name(24) == "lmp_lag_24h"
