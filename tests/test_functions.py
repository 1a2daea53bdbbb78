import math
import pytest
from pyspark.sql import functions as F

from market_engine import functions as MF
from market_engine.operators import clean
from market_engine.operators.hourly import union_frames
from market_engine.schemas import LMP_5MIN, OPS_HOURLY


def test_parsing_is_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10T02", "2024-03-10T02:30:00-08:00"), ("bad", "2024-01-15T08:05:00")],
                                   "p string, iso string")
        r = df.select(MF.parse_hour_period("p").alias("p"), MF.parse_iso_utc("iso").alias("i")).collect()
        assert str(r[0].p) == "2024-03-10 02:00:00" and str(r[0].i) == "2024-03-10 10:30:00"
        assert r[1].p is None and str(r[1].i) == "2024-01-15 08:05:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ids_windows_and_numeric_parse(spark):
    df = spark.createDataFrame([("2024-01-15", "n/a", "12.5")], "d string, bad string, good string")
    s, e = MF.request_window(F.col("d"), F.col("d"))
    r = df.select(s.alias("s"), e.alias("e"), MF.try_double("bad").alias("b"), MF.try_double("good").alias("g"),
                  MF.version_id("price_spike_logreg", F.lit("2024-01-15 08:09:10").cast("timestamp_ntz")).alias("v")
                  ).first()
    assert (r.s, r.e) == ("20240115T00:00-0000", "20240115T23:55-0000")
    assert r.b is None and r.g == 12.5 and r.v == "price_spike_logreg_20240115_080910"


def test_conform_ensure_union_and_hub_map(spark):
    df = spark.createDataFrame([("2024-01-15 00:00:00", "CISO", "1.5")], "PERIOD string, ba string, d string")
    out = clean.conform(df.withColumn("PERIOD", F.col("PERIOD").cast("timestamp_ntz")), OPS_HOURLY,
                        {"PERIOD": "period", "ba": "balancing_authority", "d": "demand_mwh"})
    assert out.columns == OPS_HOURLY.names and out.first().demand_mwh == 1.5 and out.first().interchange_mwh is None
    assert "x" in clean.ensure_columns(df, ["x"]).columns
    empty = union_frames(spark, [])
    assert empty.count() == 0 and empty.schema == LMP_5MIN
    hubs = spark.createDataFrame([("np15",), ("XX",)], "h string")
    assert [r.n for r in hubs.select(clean.map_hub("h", strict=False).alias("n")).collect()] == ["TH_NP15_GEN-APND", None]
    with pytest.raises(Exception):
        hubs.select(clean.map_hub("h").alias("n")).collect()


def test_exact_avg_leaves_nothing_out(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("x",), ("2.5",)], "v string")
    vals = [r.v for r in df.select(MF.try_double("v").alias("v")).collect()]
    assert vals == [1.5, None, None, 2.5]
    avg = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x double").agg(
        MF.exact_avg("x").alias("a")).first().a
    assert avg(1.0, None, 3.0) == 2.0 and avg(None, None) is None
    # what is no number of five decimals is averaged as it is, never left out
    assert math.isnan(avg(1.0, float("nan"), 3.0))
    assert avg(0.000004, 0.000004, 1e14) == pytest.approx(1e14 / 3)
    assert avg(1.0, 1e300) == pytest.approx(5e299)
    assert avg(9e13, 9e13) == 9e13


def test_exact_avg_is_the_correctly_rounded_mean(spark):
    import random
    from fractions import Fraction
    rng = random.Random(11)
    rows = [(g, round(rng.uniform(-500, 2000), rng.choice([0, 2, 5]))) for g in range(40) for _ in range(rng.randint(1, 30))]
    df = spark.createDataFrame(rows, "g int, x double")
    want = {}
    for g, x in rows:
        want.setdefault(g, []).append(Fraction(round(x * 10 ** 5), 10 ** 5))
    want = {g: float(sum(v) / len(v)) for g, v in want.items()}        # exact mean, rounded once
    for parts in (1, 7):
        got = {r.g: r.a for r in df.repartition(parts).groupBy("g").agg(MF.exact_avg("x").alias("a")).collect()}
        assert got == want


def test_round_half_away_matches_decimal_on_binary_values(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal
    rng = random.Random(5)
    xs = [rng.uniform(-1000, 1000) for _ in range(2000)] + [2.5, -2.5, 0.125, -0.125, 1.005]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(MF.round_half_away("x", 2).alias("r")).collect()]
    for x, r in zip(xs, got):
        scaled = abs(x) * 100 + 0.5                      # the documented rule, in binary arithmetic
        ref = (1 if x > 0 else -1 if x < 0 else 0) * float(int(scaled // 1)) / 100
        assert r == ref
        # and within one unit of the last place of decimal half-up rounding of the printed value
        assert abs(r - float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))) <= 0.0100001
