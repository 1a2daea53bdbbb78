import pytest
from pyspark.sql import functions as F

from helpers import SF01, lmp_rows
from market_engine.operators import quality as Q
from market_engine.operators.hourly import hourly_prices
from market_engine.plans import market


def test_schema_suite_counts_26_and_passes(spark):
    suite = Q.schema_suite()
    kinds = [c.kind for cs in suite.values() for c in cs]
    assert kinds.count("not_null") == 19 and kinds.count("accepted_values") == 7
    lay = market.from_testdata(spark, SF01)
    rep = Q.run_checks(lay.stress, suite["mart_hourly_market_stress"], "mart_hourly_market_stress")
    assert {r.status for r in rep.collect()} == {"pass"}
    Q.assert_checks(rep)


def test_severity_warn_does_not_raise_and_error_does(spark):
    df = spark.createDataFrame([("NP15", 1), ("XX15", None), (None, 2)], "trading_hub string, price_spike_flag int")
    checks = [Q.accepted_values("trading_hub", ["NP15"], severity="warn"), Q.not_null("trading_hub"),
              Q.accepted_values("price_spike_flag", [0, 1])]
    rep = {r.test_name: r for r in Q.run_checks(df, checks, "t").collect()}
    assert rep["accepted_values_t_trading_hub"].failing_rows == 1      # NULL is not a violation
    assert rep["accepted_values_t_trading_hub"].status == "warn"
    assert rep["not_null_t_trading_hub"].status == "fail"
    assert rep["accepted_values_t_price_spike_flag"].failing_rows == 1
    with pytest.raises(AssertionError):
        Q.assert_checks(Q.run_checks(df, checks, "t"))
    Q.assert_checks(Q.run_checks(df, checks[:1], "t"))


def test_missing_hours_and_uniqueness(spark):
    lmp = lmp_rows(spark, [(0, "NP15", 1.0), (60, "NP15", 2.0), (240, "NP15", 3.0), (0, "SP15", 1.0)])
    h = hourly_prices(lmp)
    miss = sorted(r.hour_utc.hour for r in Q.missing_hours(h).collect())
    assert miss == [2, 3]
    dup = h.unionByName(h.filter("trading_hub = 'SP15'"))
    s = Q.uniqueness_summary(dup, ["trading_hub", "hour_utc"]).first()
    assert (s.distinct_keys, s.duplicated_keys, s.duplicated_rows) == (4, 1, 2)
    assert Q.check_unique(dup, ["trading_hub", "hour_utc"]).count() == 1
    c = {r.trading_hub: (r.complete_hours, r.incomplete_hours) for r in Q.complete_hours(h).collect()}
    assert c == {"NP15": (0, 3), "SP15": (0, 1)}


def test_components_sum_to_price(spark):
    from market_engine.sources import adapters
    r = Q.component_mismatches(adapters.lmp_5min(spark, SF01)).first()
    assert r.rows == 10000 and r.component_mismatch_rows == 0
