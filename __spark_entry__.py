"""

Every query reads the shared test tables (through the adapters in
``market_engine.sources.adapters``) over their whole extent. Float aggregates whose last
bits depend on the engine's summation order (stddev, means of means, correlations) are
reported at 6 dp with the same half-away-from-zero rounding on both sides; averages of
prices are exact fixed-point averages and percentiles are interpolated with one formula, so
neither needs rounding.
"""

from __future__ import annotations

import functools
import os
import sys
import uuid
from collections.abc import Callable

# the package and the oracle module live next to this file; make them importable however the
# driver loads it (by path, from another working directory)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_sql as O
from market_engine.constants import MODEL_VERSION_PREFIX, NUMERIC_FEATURES, PRICE_ITEMS, SEVERITIES
from market_engine.functions import day_window, instant_to_utc_ntz, on_date, round_half_away, stable
from market_engine.operators import clean, hourly, ml, ml_outputs, preprocess as PP, quality, reports as R, stress as ST, threshold_history as TH
from market_engine.plans import market
from market_engine.session import checkpoint_dir, materialise_frame, shared_fallback, ship_package
from market_engine.sinks.ledger import load
from market_engine.sinks.tables import merge_partitions, with_load_date
from market_engine.streaming import prices as SP
from market_engine.sources import adapters, tables
from market_engine.sources import pages as PG
from market_engine.sources import prices as PR

SF_SMOKE = "/root/testdata/sf0.001"
_Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def reg(name: str, sql: str | None):
    def deco(fn):
        _Q[name] = (fn, None if sql is None else O.with_ctes(sql))
        return fn
    return deco


def _stable(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: stable(c) for c in cols if c in df.columns})


def _r6(cols) -> str:
    return ", ".join(f"{O.r(c, 6)} as {c}" for c in cols)


def L(spark: SparkSession, sf: str, **kw) -> market.MarketLayers:
    return market.from_testdata(spark, sf, market.MarketParams(**kw))


_INEXACT = ["lmp_stddev", "lmp_historical_mean", "lmp_historical_stddev"]
_FRAME_NUM = [c for c in NUMERIC_FEATURES]


# =============================================================== landings
def _folder(spark, name: str) -> str:
    base = checkpoint_dir(spark, lambda: shared_fallback(spark))
    return f"{base.rstrip('/')}/{name} {uuid.uuid4().hex}"


_PRICE_COLS = list(PRICE_ITEMS.values())
_FIRST = ", ".join(f"min({c}) as {c}" for c in _PRICE_COLS)
_BAD_LOSS = "case when strftime(interval_start, '%H:%M:%S.%f') like '%:00:0%' then null else loss_component end as loss_component"
_LANDED = f"""
select interval_start, interval_end, upper(trim(trading_hub)) as trading_hub, cast(lmp as varchar) as lmp, lmp as lmp_x,
  energy_component, congestion_component, {_BAD_LOSS}
from lmp_5min"""


@reg("a01_price_archives", f"""
select interval_start, interval_end, trading_hub, {_FIRST.replace('min(lmp)', 'min(lmp_x)')}, 'RTM' as market, 'landing' as source_system
from ({_LANDED}) l where day(interval_start) not in (13, 17) group by interval_start, interval_end, trading_hub""")
def q_a01(spark, sf):
    raw, _ = PR.prices_of(PR.decode_files(adapters.price_archives(spark, sf)), source_system="landing")
    return raw.drop("loaded_at")


@reg("a01_quarantine", """
select distinct '/landing/' || upper(trim(trading_hub)) || '/' || strftime(interval_start, '%Y-%m-%d') || '.zip' as source_file,
  case day(interval_start) when 13 then 'bad_zip' else 'no_csv' end as status
from lmp_5min where day(interval_start) in (13, 17)""")
def q_a01q(spark, sf):
    _, bad = PR.prices_of(PR.decode_files(adapters.price_archives(spark, sf)))
    return bad.select("source_file", "status")


_CSV_OK = "not (dayofyear(interval_start) % 3 = 1 and day(interval_start) % 7 = 0)"


@reg("a02_price_csv", f"""
select interval_start, interval_end, trading_hub, {_FIRST.replace('min(lmp)', 'min(lmp_x)')}, 'RTM' as market, 'landing' as source_system
from ({_LANDED}) l where {_CSV_OK} group by interval_start, interval_end, trading_hub""")
def q_a02(spark, sf):
    folder = _folder(spark, "landing of day")
    adapters.land_price_csv(spark, sf, folder)
    raw, _ = PR.read_price_csv(spark, folder, source_system="landing")
    return raw.drop("loaded_at")


@reg("a02_quarantine", f"""
select trading_hub, 'ragged_row' as status, 5 * count(*)::bigint as lines
from (select distinct interval_start, interval_end, upper(trim(trading_hub)) as trading_hub from lmp_5min where not ({_CSV_OK})) d
group by trading_hub""")
def q_a02q(spark, sf):
    folder = _folder(spark, "landing of day")
    adapters.land_price_csv(spark, sf, folder)
    _, bad = PR.read_price_csv(spark, folder)
    hub = F.regexp_extract("source_file", "trading_hub=([^/]+)/", 1).alias("trading_hub")
    return bad.groupBy(hub, "status").agg(F.count(F.lit(1)).alias("lines"))


_PAGED = """
select *, '/landing/' || respondent || '/' || period[1:10] as request, cast(period[9:10] as int) as d,
  count(*) over (partition by respondent, period[1:10]) as total,
  (row_number() over (partition by respondent, period[1:10] order by seq) - 1) // 40 as page
from ops_long"""
_GOOD_PAGES = f"select * from ({_PAGED}) p where not (page = 0 and d in (5, 9)) and not (d = 11 and seq % 5 = 0)"


@reg("a03_ops_pages", f"""
select try_strptime(period, '%Y-%m-%dT%H') as period, respondent as balancing_authority,
  min_by(v, seq) filter (where type = 'D') as demand_mwh, min_by(v, seq) filter (where type = 'DF') as demand_forecast_mwh,
  min_by(v, seq) filter (where type = 'NG') as net_generation_mwh, min_by(v, seq) filter (where type = 'TI') as interchange_mwh,
  'landing' as source_system
from (select *, try_cast(value as double) as v from ({_GOOD_PAGES}) g where type in ('D', 'DF', 'NG', 'TI')) s
where v is not null group by period, respondent""")
def q_a03(spark, sf):
    ops, _, _ = PG.ops_of(PG.parse_pages(adapters.ops_pages(spark, sf)), "landing")
    return ops.drop("loaded_at")


@reg("a04_rejected_pages", f"""
select distinct request || '/p00000.json' as page_file, request, case d when 5 then 'unreadable page' else 'over the limit' end as error
from ({_PAGED}) p where page = 0 and d in (5, 9)""")
def q_a04(spark, sf):
    return PG.reject_error_pages(PG.parse_pages(adapters.ops_pages(spark, sf)))[1]


@reg("a05_page_totals", f"""
select request, max(total)::bigint as reported_total, count(*)::bigint as received_rows, count(distinct page)::bigint as pages,
  max(total) = count(*) as complete
from ({_GOOD_PAGES}) g group by request""")
def q_a05(spark, sf):
    good, _ = PG.reject_error_pages(PG.parse_pages(adapters.ops_pages(spark, sf)))
    return PG.check_page_totals(good)


# =============================================================== sinks
def _keyed_prices(spark, sf):
    """One row an interval, hub and market, with the partition columns of the raw table."""
    raw = adapters.lmp_5min(spark, sf).select("interval_start", F.upper(F.trim("trading_hub")).alias("trading_hub"),
                                              F.upper(F.trim("market")).alias("market"), "lmp")
    return with_load_date(raw.groupBy("interval_start", "trading_hub", "market").agg(F.min("lmp").alias("lmp")), "interval_start")


_KEYED = """(select interval_start, upper(trim(trading_hub)) as trading_hub, upper(trim(market)) as market, min(lmp) as lmp,
  cast(interval_start as date) as load_date from lmp_5min group by all)"""
_DAY_HUB, _ROW = ["load_date", "trading_hub"], ["interval_start", "trading_hub", "market"]
_KEYED_COLS = ["interval_start", "trading_hub", "market", "lmp"]


@reg("a09_replace_days", f"""
select interval_start, trading_hub, market, case when day(load_date) <= 10 and trading_hub <> 'ZP26' then lmp + 1 else lmp end as lmp
from {_KEYED} k""")
def q_a09(spark, sf):
    rows, target = _keyed_prices(spark, sf), _folder(spark, "raw_lmp")
    load(rows, target, "first", "replace", _DAY_HUB)
    load(rows.filter("day(load_date) <= 10 and trading_hub <> 'ZP26'").withColumn("lmp", F.col("lmp") + 1), target, "rerun", "replace", _DAY_HUB)
    load(rows, target, "first", "replace", _DAY_HUB)        # a replay changes nothing
    return spark.read.parquet(target).select(*_KEYED_COLS)


@reg("a10_replace_day_authority", """
select period, balancing_authority, case when balancing_authority = 'CISO' then demand_mwh * 2 else demand_mwh end as demand_mwh
from ops_hourly where period is not null""")
def q_a10(spark, sf):
    ops = with_load_date(adapters.ops_hourly(spark, sf).filter("period is not null").select("period", "balancing_authority", "demand_mwh"), "period")
    target, keys = _folder(spark, "raw_ops"), ["load_date", "balancing_authority"]
    load(ops, target, "first", "replace", keys)
    load(ops.filter("balancing_authority = 'CISO'").withColumn("demand_mwh", F.col("demand_mwh") * 2), target, "rerun", "replace", keys)
    return spark.read.parquet(target).select("period", "balancing_authority", "demand_mwh")


@reg("a11_replace_model_version", f"""
select v as model_version, trading_hub, day(load_date)::int as day, count(*) as rows, max(lmp + case v when 'm2' then 7 else 0 end) as top
from {_KEYED} k, (values ('m1'), ('m2')) as t(v) group by 1, 2, 3""")
def q_a11(spark, sf):
    out, target = _keyed_prices(spark, sf).drop("market"), _folder(spark, "predictions")
    of = lambda v, more: out.select(F.lit(v).alias("model_version"), "trading_hub", "load_date", (F.col("lmp") + more).alias("lmp"))
    load(of("m1", 0).unionByName(of("m2", 0)), target, "train", "replace", ["model_version"])
    load(of("m2", 7), target, "retrain", "replace", ["model_version"])
    return spark.read.parquet(target).groupBy("model_version", "trading_hub", F.dayofmonth("load_date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("lmp").alias("top"))


@reg("a12_append", f"""
select trading_hub, market, count(*) as rows, sum(cast(round(lmp * 100) as bigint))::bigint as cents
from (select * from {_KEYED} k union all select * from {_KEYED} k where market = 'DAM') a group by all""")
def q_a12(spark, sf):
    rows, name = _keyed_prices(spark, sf), f"appended_{uuid.uuid4().hex}"
    rows.limit(0).write.format("parquet").saveAsTable(name)
    load(rows, name, "all", "append")
    load(rows.filter("market = 'DAM'"), name, "more", "append")
    load(rows, name, "all", "append")                       # a replay adds nothing
    return spark.table(name).groupBy("trading_hub", "market").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.round(F.col("lmp") * 100).cast("bigint")).alias("cents"))


@reg("a22_merge_in_parts", f"""
select interval_start, trading_hub, market, case when minute(interval_start) % 10 = 0 then lmp + 5 else lmp end as lmp
from {_KEYED} k""")
def q_a22(spark, sf):
    rows, target = _keyed_prices(spark, sf), _folder(spark, "raw_lmp")
    at = lambda df, t: df.withColumn("loaded_at", F.lit(f"2024-02-0{t} 00:00:00").cast("timestamp_ntz"))
    late = F.minute("interval_start") % 3 == 0
    first = at(rows.filter(~late), 1)
    fixed = rows.filter(F.minute("interval_start") % 10 == 0).withColumn("lmp", F.col("lmp") + 5)
    second = at(rows.filter(late & (F.minute("interval_start") % 10 != 0)).unionByName(fixed), 2)
    load(first, target, "epoch 1", "merge", _DAY_HUB, _ROW)
    merge_partitions(second.filter("trading_hub = 'NP15'"), target, _DAY_HUB, _ROW)     # a part of epoch 2 was written when its job died
    for _ in range(2):
        load(second, target, "epoch 2", "merge", _DAY_HUB, _ROW)
    load(first, target, "epoch 1", "merge", _DAY_HUB, _ROW)
    return spark.read.parquet(target).select(*_KEYED_COLS)


# =============================================================== staging, features, mart
@reg("d01_hourly_prices", f"select * replace ({_r6(['lmp_stddev'])}) from stg_lmp")
def q_d01(spark, sf):
    return _stable(L(spark, sf).stg_prices, ["lmp_stddev"])


@reg("d04_ops_pivot", "select * from ops_hourly")
def q_d04(spark, sf):
    return adapters.ops_hourly(spark, sf)


@reg("b04_staged_ops", "select * from stg_ops")
def q_b04(spark, sf):
    return L(spark, sf).stg_ops


@reg("e01_market_features", f"select * replace ({_r6(['lmp_stddev'])}) from features")
def q_e01(spark, sf):
    return _stable(L(spark, sf).features, ["lmp_stddev"])


@reg("e01_market_features_distributed", f"select * replace ({_r6(['lmp_stddev'])}) from features")
def q_e01d(spark, sf):
    return _stable(L(spark, sf, lag_method="join").features, ["lmp_stddev"])


@reg("e01_market_features_window", f"select * replace ({_r6(['lmp_stddev'])}) from features")
def q_e01w(spark, sf):
    return _stable(L(spark, sf, lag_method="window").features, ["lmp_stddev"])


@reg("c04_time_exact_lags", f"select * replace ({_r6(['lmp_stddev'])}) from features_time")
def q_c04(spark, sf):
    return _stable(L(spark, sf, lag_mode="time").features, ["lmp_stddev"])


@reg("d02_hub_thresholds", "select trading_hub, lmp_p95_threshold, lmp_p99_threshold, "
     + _r6(_INEXACT[1:]) + " from thresholds")
def q_d02(spark, sf):
    return _stable(ST.hub_thresholds(L(spark, sf).features), _INEXACT)


@reg("d02_hub_thresholds_distributed", "select trading_hub, lmp_p95_threshold, lmp_p99_threshold, "
     + _r6(_INEXACT[1:]) + " from thresholds")
def q_d02d(spark, sf):
    return _stable(ST.hub_thresholds(L(spark, sf, lag_method="join").features, method="distributed"), _INEXACT)


@reg("b13_market_stress_distributed", f"select * replace ({_r6(_INEXACT)}) from stress")
def q_b13d(spark, sf):
    return _stable(L(spark, sf, lag_method="join", threshold_method="distributed").stress, _INEXACT)


@reg("e07_rolling_threshold_7d_window", f"""
select trading_hub, hour_utc, lmp_avg, {O.interp('v', 'len(v)', 0.95)} as rolling_p95_7d from (
  select trading_hub, hour_utc, lmp_avg, list_sort(list(lmp_avg) over (
    partition by trading_hub order by hour_utc
    range between interval 7 days preceding and current row)) as v from features) x""")
def q_e07w(spark, sf):
    return ST.rolling_threshold(L(spark, sf).features, days=7, q=0.95, method="window")


@reg("d02_hub_thresholds_approx", None)
def q_d02a(spark, sf):
    return ST.hub_thresholds(L(spark, sf).features, exact=False)


@reg("b13_market_stress", f"select * replace ({_r6(_INEXACT)}) from stress")
def q_b13(spark, sf):
    return _stable(L(spark, sf).stress, _INEXACT)


@reg("b14_dashboard", "select * from dashboard")
def q_b14(spark, sf):
    return L(spark, sf).dashboard


@reg("e07_rolling_threshold_7d", f"""
select trading_hub, hour_utc, lmp_avg, {O.interp('v', 'len(v)', 0.95)} as rolling_p95_7d from (
  select trading_hub, hour_utc, lmp_avg, list_sort(list(lmp_avg) over (
    partition by trading_hub order by hour_utc
    range between interval 7 days preceding and current row)) as v from features) x""")
def q_e07(spark, sf):
    return ST.rolling_threshold(L(spark, sf).features, days=7, q=0.95)


@reg("e07_rolling_threshold_7d_halo", f"""
select trading_hub, hour_utc, lmp_avg, {O.interp('v', 'len(v)', 0.95)} as rolling_p95_7d from (
  select trading_hub, hour_utc, lmp_avg, list_sort(list(lmp_avg) over (
    partition by trading_hub order by hour_utc
    range between interval 7 days preceding and current row)) as v from features) x""")
def q_e07h(spark, sf):
    return ST.rolling_threshold(L(spark, sf).features, days=7, q=0.95, method="halo")


def _sketch_store(spark, sf):
    """Daily sketches of the hourly prices, loaded in two parts, then one day again."""
    prices, path = L(spark, sf).joined, _folder(spark, "threshold_days")
    early = F.dayofmonth("hour_utc") < 20
    TH.store_days(prices.filter(early), path)
    TH.store_days(prices.filter(~early), path)
    TH.store_days(prices.filter(F.dayofmonth("hour_utc") == 3), path)
    return prices, TH.thresholds_from(spark, path)


@reg("d02_incremental_rank_error", """
select trading_hub, q as quantile, count(lmp_avg)::bigint as n, true as within_bound
from features, (values (0.95::double), (0.99::double)) as t(q) group by trading_hub, q""")
def q_d02i(spark, sf):
    prices, thresholds = _sketch_store(spark, sf)
    return TH.within_bound(prices, thresholds)


@reg("d02_incremental_moments", "select trading_hub, " + _r6(_INEXACT[1:]) + ", (select count(*) from features f where f.trading_hub = t.trading_hub) as n from thresholds t")
def q_d02m(spark, sf):
    _, thresholds = _sketch_store(spark, sf)
    return _stable(thresholds.select("trading_hub", "lmp_historical_mean", "lmp_historical_stddev", "n"), _INEXACT)


# =============================================================== filters and predicates
@reg("b08_filter_codes", "select * from ops_long where type in ('D', 'DF', 'NG', 'TI')")
def q_b08(spark, sf):
    return clean.filter_codes(adapters.ops_long(spark, sf), "type", ["D", "DF", "NG", "TI"])


@reg("b09_hub_nodes", """
select distinct trading_hub, case trading_hub when 'NP15' then 'TH_NP15_GEN-APND'
  when 'SP15' then 'TH_SP15_GEN-APND' when 'ZP26' then 'TH_ZP26_GEN-APND' end as node_id from stg_lmp""")
def q_b09(spark, sf):
    return L(spark, sf).stg_prices.select("trading_hub").distinct().select(
        "trading_hub", clean.map_hub("trading_hub").alias("node_id"))


@reg("b10_day_window", """
select * from lmp_5min where interval_start >= timestamp '2024-01-10 00:00:00'
  and interval_start < timestamp '2024-01-13 00:00:00'""")
def q_b10(spark, sf):
    return adapters.lmp_5min(spark, sf).filter(day_window("interval_start", "2024-01-10", "2024-01-12"))


@reg("b11_on_date", "select * from stg_ops where cast(hour_utc as date) = date '2024-01-15' and balancing_authority = 'CISO'")
def q_b11(spark, sf):
    s = L(spark, sf).stg_ops
    return s.filter(on_date("hour_utc", "2024-01-15") & (F.col("balancing_authority") == "CISO"))


@reg("a15_coerce_timestamps", """
select count(*) as rows, count_if(interval_start is null) as bad_interval_start,
  count(distinct date_trunc('second', interval_start)) as distinct_seconds,
  min(date_trunc('second', interval_start)) as first_second, max(date_trunc('second', interval_start)) as last_second
from lmp_5min""")
def q_a15(spark, sf):
    raw = adapters.lmp_5min(spark, sf).select(F.col("interval_start").cast("string").alias("interval_start"))
    c = tables.coerce_timestamps(raw, ["interval_start"])
    return c.agg(F.count(F.lit(1)).alias("rows"), F.count_if("interval_start__bad").alias("bad_interval_start"),
                 F.countDistinct("interval_start").alias("distinct_seconds"),
                 F.min("interval_start").alias("first_second"), F.max("interval_start").alias("last_second"))


@reg("a20_table_audit", """
select 'staging_stg_lmp_hourly' as table_name, true as table_exists, count(*) as row_count,
  min(hour_utc) as first_time, max(hour_utc) as last_time, max(loaded_at) as last_loaded_at from stg_lmp
union all
select 'staging_stg_ops_hourly', true, count(*), min(hour_utc), max(hour_utc), max(loaded_at) from stg_ops
union all
select 'staging_not_loaded', false, 0, null, null, null""")
def q_a20(spark, sf):
    from market_engine.sinks import tables as SK
    lay = L(spark, sf)
    v1 = SK.materialise(lay.stg_prices, "staging", "stg_lmp_hourly")      # A-18: staging layer = view
    v2 = SK.materialise(lay.stg_ops, "staging", "stg_ops_hourly")
    return SK.table_audit(spark, {v1: "hour_utc", v2: "hour_utc", "staging_not_loaded": None})


# =============================================================== validation worksheet
@reg("d05_row_count_raw_prices", "select count(*) as total_rows from lmp_5min")
def q_d05a(spark, sf):
    return R.row_count(adapters.lmp_5min(spark, sf))


@reg("d05_row_count_raw_ops", "select count(*) as total_rows from ops_hourly")
def q_d05b(spark, sf):
    return R.row_count(adapters.ops_hourly(spark, sf))


@reg("d05_row_count_mart", "select count(*) as total_rows from stress")
def q_d05c(spark, sf):
    return R.row_count(L(spark, sf).stress)


@reg("d06_coverage_raw_prices", """
select trading_hub, count(*) as row_count, min(interval_start) as earliest_interval,
  max(interval_start) as latest_interval from lmp_5min group by trading_hub""")
def q_d06(spark, sf):
    return R.coverage(adapters.lmp_5min(spark, sf), "trading_hub", "interval_start", "_interval")


@reg("d07_coverage_raw_ops", """
select balancing_authority, count(*) as row_count, min(period) as earliest_period,
  max(period) as latest_period from ops_hourly group by balancing_authority""")
def q_d07(spark, sf):
    return R.coverage(adapters.ops_hourly(spark, sf), "balancing_authority", "period", "_period")


@reg("f01_sample_raw_prices", "select * from lmp_5min order by interval_start, trading_hub, lmp limit 10")
def q_f01a(spark, sf):
    return R.sample_rows(adapters.lmp_5min(spark, sf), ["interval_start", "trading_hub", "lmp"], 10)


@reg("f01_sample_raw_ops", "select * from ops_hourly order by period nulls first, balancing_authority limit 10")
def q_f01b(spark, sf):
    return R.sample_rows(adapters.ops_hourly(spark, sf), ["period", "balancing_authority"], 10)


@reg("d08_mart_summary", f"""
select trading_hub, count(*) as row_count, {O.r('avg(lmp_avg)', 2)} as avg_lmp, {O.r('min(lmp_avg)', 2)} as min_lmp,
  {O.r('max(lmp_avg)', 2)} as max_lmp, cast(sum(price_spike_flag) as bigint) as spike_hours,
  count(distinct stress_severity) as severity_levels
from stress group by trading_hub""")
def q_d08(spark, sf):
    return R.mart_summary(L(spark, sf).stress)


_MART_SAMPLE = ["lmp_avg:2", "demand_mwh:0", "demand_forecast_mwh:0", "net_generation_mwh:0", "interchange_mwh:0"]


@reg("f01_sample_mart", "select hour_utc, trading_hub, " + ", ".join(
    f"{O.r(c.split(':')[0], int(c.split(':')[1]))} as {c.split(':')[0]}" for c in _MART_SAMPLE)
    + ", price_spike_flag, stress_severity from stress order by hour_utc, trading_hub limit 20")
def q_f01c(spark, sf):
    top = R.sample_rows(L(spark, sf).stress, ["hour_utc", "trading_hub"], 20)
    return top.select("hour_utc", "trading_hub", *[
        round_half_away(c.split(":")[0], int(c.split(":")[1])).alias(c.split(":")[0]) for c in _MART_SAMPLE],
        "price_spike_flag", "stress_severity")


_DASH_SAMPLE = ["hour_utc", "trading_hub", "lmp_avg_usd_mwh", "spike_threshold_p95", "spike_threshold_p99",
                "price_spike_flag", "stress_severity", "energy_component_avg", "congestion_component_avg",
                "demand_mwh", "demand_forecast_mwh", "net_generation_mwh", "interchange_mwh", "lmp_lag_1h",
                "lmp_lag_24h", "pct_above_spike_threshold"]


@reg("f01_sample_dashboard", "select " + ", ".join(_DASH_SAMPLE) + " from dashboard order by hour_utc, trading_hub limit 20")
def q_f01d(spark, sf):
    return R.sample_rows(L(spark, sf).dashboard, ["hour_utc", "trading_hub"], 20, _DASH_SAMPLE)


@reg("d10_violation_counts", """
select count_if(hour_utc is null) as null_hour_utc_count, count_if(lmp_avg is null) as null_lmp_avg_count,
  count_if(price_spike_flag not in (0, 1)) as invalid_spike_flag_count,
  count_if(demand_mwh is null) as null_demand_mwh_count from stress""")
def q_d10(spark, sf):
    return quality.violation_counts(L(spark, sf).stress)


@reg("d09_severity_distribution", f"""
select stress_severity, count(*) as hour_count,
  {O.r('count(*) * 100.0e0 / sum(count(*)) over ()', 1)} as pct_of_total
from stress group by stress_severity""")
def q_d09(spark, sf):
    return R.severity_distribution(L(spark, sf).stress)


# =============================================================== data-quality suites
_SUITE_TABLES = {"stg_lmp_hourly": "stg_lmp", "int_hourly_market_features": "features",
                 "mart_hourly_market_stress": "stress", "mart_price_spike_dashboard": "dashboard"}


def _sql_pred(chk: quality.Check) -> str:
    if chk.kind == "not_null":
        return f"{chk.column} is null"
    if chk.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in chk.values)
        return f"{chk.column} not in ({vals})"
    return chk.predicate


def _suite_sql(checks_by_table) -> str:
    parts = []
    for table, checks in checks_by_table.items():
        src = _SUITE_TABLES.get(table, "stress")
        for chk in checks:
            n = f"cast(count_if(coalesce({_sql_pred(chk)}, false)) as bigint)"
            parts.append(
                f"select '{table}' as table_name, '{chk.test_name(table)}' as test_name, {n} as failing_rows, "
                f"'{chk.severity}' as severity, case when {n} = 0 then 'pass' when '{chk.severity}' = 'error' "
                f"then 'fail' else '{chk.severity}' end as status from {src}")
    return "\nunion all\n".join(parts)


@reg("dq04_schema_suite", _suite_sql(quality.schema_suite()))
def q_dq04(spark, sf):
    lay = L(spark, sf)
    frames = {"stg_lmp_hourly": lay.stg_prices, "int_hourly_market_features": lay.features,
              "mart_hourly_market_stress": lay.stress, "mart_price_spike_dashboard": lay.dashboard}
    reps = [quality.run_checks(frames[t], checks, t) for t, checks in quality.schema_suite().items()]
    out = reps[0]
    for r in reps[1:]:
        out = out.unionByName(r)
    return out


@reg("dq05_sanity_suite", _suite_sql({"mart_hourly_market_stress": quality.sanity_suite()}))
def q_dq05(spark, sf):
    return quality.run_checks(L(spark, sf).stress, quality.sanity_suite(), "mart_hourly_market_stress")


@reg("dq09_uniqueness_features", """
select count(*) as distinct_keys, count_if(n > 1) as duplicated_keys,
  cast(coalesce(sum(case when n > 1 then n end), 0) as bigint) as duplicated_rows
from (select trading_hub, hour_utc, count(*) as n from features group by trading_hub, hour_utc) g""")
def q_dq09(spark, sf):
    return quality.uniqueness_summary(L(spark, sf).features, ["trading_hub", "hour_utc"])


@reg("dq10_complete_hours", """
select trading_hub, market, count_if(interval_count = 12) as complete_hours,
  count_if(interval_count <> 12) as incomplete_hours, count(*) as hours
from stg_lmp group by trading_hub, market""")
def q_dq10(spark, sf):
    return quality.complete_hours(L(spark, sf).stg_prices)


@reg("dq11_missing_hours", """
select c.trading_hub, c.hour_utc from (
  select trading_hub, unnest(generate_series(lo, hi, interval 1 hour)) as hour_utc
  from (select trading_hub, min(hour_utc) as lo, max(hour_utc) as hi from features group by trading_hub) s) c
where not exists (select 1 from features f where f.trading_hub = c.trading_hub and f.hour_utc = c.hour_utc)""")
def q_dq11(spark, sf):
    return quality.missing_hours(L(spark, sf).features)


@reg("dq12_component_check", """
select count(*) as rows,
  count_if(abs(energy_component + congestion_component + loss_component - lmp) > 1e-6) as component_mismatch_rows
from lmp_5min""")
def q_dq12(spark, sf):
    return quality.component_mismatches(adapters.lmp_5min(spark, sf))


# =============================================================== reports
@reg("e06_top_hours", """
select cast(row_number() over (order by lmp_avg desc, hour_utc, trading_hub) as integer) as rank,
  hour_utc, trading_hub, lmp_avg, stress_severity
from stress order by lmp_avg desc, hour_utc, trading_hub limit 10""")
def q_e06(spark, sf):
    return R.top_hours(L(spark, sf).stress, 10)


@reg("r01_last_7_days", """
select hour_utc, trading_hub, lmp_avg from stress
where hour_utc > (select max(hour_utc) - interval 7 day from stress)""")
def q_r01(spark, sf):
    return R.last_days(L(spark, sf).stress, 7)


@reg("r02_current_vs_threshold", f"""
select trading_hub, max(hour_utc) as latest_hour, max_by(lmp_avg, hour_utc) as current_lmp,
  max(lmp_p95_threshold) as lmp_p95_threshold,
  max_by(lmp_avg, hour_utc) >= max(lmp_p95_threshold) as above_threshold
from stress group by trading_hub""")
def q_r02(spark, sf):
    return R.current_vs_threshold(L(spark, sf).stress)


@reg("r03_daily_average", f"""
select cast(cast(hour_utc as date) as varchar) as day, trading_hub, {O.r('avg(lmp_avg)', 6)} as avg_lmp,
  count(*) as hours from stress group by 1, 2""")
def q_r03(spark, sf):
    d = R.daily_average(L(spark, sf).stress)
    return _stable(d.withColumn("day", F.col("day").cast("string")), ["avg_lmp"])


@reg("r04_component_breakdown", " union all ".join(
    f"select hour_utc, '{n}' as component, {O.r(f'avg({c})', 6)} as component_value from stress group by hour_utc"
    for n, c in [("energy", "energy_component_avg"), ("congestion", "congestion_component_avg"),
                 ("loss", "loss_component_avg")]))
def q_r04(spark, sf):
    return _stable(R.component_breakdown(L(spark, sf).stress), ["component_value"])


@reg("r05_freshness", """
select trading_hub, market, max(loaded_at) as last_loaded_at, max(hour_utc) as last_hour
from stg_lmp group by trading_hub, market""")
def q_r05(spark, sf):
    return R.freshness(L(spark, sf).stg_prices)


@reg("r06_filtered_hours", """
select hour_utc, trading_hub, lmp_avg, stress_severity, is_weekend from stress
where trading_hub in ('NP15', 'ZP26') and hour_utc >= timestamp '2024-01-08 00:00:00'
  and hour_utc < timestamp '2024-01-22 00:00:00' and stress_severity in ('ELEVATED', 'SPIKE', 'EXTREME')
  and is_weekend = false""")
def q_r06(spark, sf):
    s = R.apply_filters(L(spark, sf).stress, hubs=["NP15", "ZP26"], start="2024-01-08", end="2024-01-21",
                        severities=["ELEVATED", "SPIKE", "EXTREME"], weekend=False)
    return s.select("hour_utc", "trading_hub", "lmp_avg", "stress_severity", "is_weekend")


_SEV_RANK_SQL = "case stress_severity " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(SEVERITIES)) + " end"
_SEV_LABEL = lambda e: "case " + e + " " + " ".join(f"when {i} then '{s}'" for i, s in enumerate(SEVERITIES)) + " end"


@reg("r07_spike_calendar", "select cast(cast(hour_utc as date) as varchar) as day, " + ", ".join(
    _SEV_LABEL(f"max(case when hour_of_day = {h} then {_SEV_RANK_SQL} end)") + f" as h{h:02d}" for h in range(24))
    + " from stress group by 1")
def q_r07(spark, sf):
    return R.spike_calendar(L(spark, sf).stress).withColumn("day", F.col("day").cast("string"))


@reg("r08_flag_series", f"""
select hour_utc, trading_hub, lmp_avg, price_spike_flag, stress_severity,
  cast({_SEV_RANK_SQL} as integer) as severity_rank from stress""")
def q_r08(spark, sf):
    return R.flag_series(L(spark, sf).stress)


@reg("r10_congestion_during_spikes", f"""
select trading_hub, count(*) as spike_hours, {O.r('avg(congestion_component_avg)', 6)} as avg_congestion,
  {O.r('avg(case when lmp_avg <> 0 then congestion_component_avg / lmp_avg end)', 6)} as avg_congestion_share
from stress where price_spike_flag = 1 group by trading_hub""")
def q_r10(spark, sf):
    return _stable(R.congestion_during_spikes(L(spark, sf).stress), ["avg_congestion", "avg_congestion_share"])


@reg("r11_demand_vs_generation", f"""
select trading_hub, price_spike_flag, count(*) as hours, {O.r('avg(demand_mwh)', 6)} as avg_demand_mwh,
  {O.r('avg(net_generation_mwh)', 6)} as avg_net_generation_mwh, {O.r('avg(demand_supply_gap_mwh)', 6)} as avg_gap_mwh
from stress group by trading_hub, price_spike_flag""")
def q_r11(spark, sf):
    return _stable(R.demand_vs_generation(L(spark, sf).stress),
                   ["avg_demand_mwh", "avg_net_generation_mwh", "avg_gap_mwh"])


@reg("r12_spike_heatmap", f"""
select hour_of_day, day_of_week, {O.r('avg(price_spike_flag)', 6)} as spike_rate, count(*) as hours
from stress group by hour_of_day, day_of_week""")
def q_r12(spark, sf):
    return _stable(R.spike_heatmap(L(spark, sf).stress), ["spike_rate"])


@reg("r13_seasonal_naive", """
select hour_utc, trading_hub, lmp_avg as actual_lmp, lmp_lag_24h as predicted_lmp,
  lmp_avg - lmp_lag_24h as forecast_error from stress""")
def q_r13(spark, sf):
    return R.seasonal_naive(L(spark, sf).stress)


@reg("r15_error_histogram", """
select floor((lmp_avg - lmp_lag_24h) / 5.0e0) * 5.0e0 as bucket_start, count(*) as n
from stress where lmp_avg - lmp_lag_24h is not null group by 1""")
def q_r15(spark, sf):
    return R.error_histogram(R.seasonal_naive(L(spark, sf).stress), 5.0)


@reg("r16_lag_trend", " union all ".join(
    f"select hour_utc, trading_hub, '{c}' as series, {c} as series_value from stress"
    for c in ["lmp_avg", "lmp_lag_1h", "lmp_lag_24h", "lmp_lag_168h"]))
def q_r16(spark, sf):
    return R.lag_trend(L(spark, sf).stress)


def _peak_sql(dim: str) -> str:
    return f"""select trading_hub, {dim} as peak_{dim}, rate as peak_{dim}_rate from (
  select trading_hub, {dim}, rate, row_number() over (partition by trading_hub order by rate desc, {dim}) as rn
  from (select trading_hub, {dim}, avg(price_spike_flag) as rate from stress group by 1, 2) g) x where rn = 1"""


@reg("r17_recurring_patterns", f"""
select a.trading_hub, a.peak_hour_of_day, {O.r('a.peak_hour_of_day_rate', 6)} as peak_hour_of_day_rate,
  b.peak_month, {O.r('b.peak_month_rate', 6)} as peak_month_rate
from ({_peak_sql('hour_of_day')}) a join ({_peak_sql('month')}) b on a.trading_hub = b.trading_hub""")
def q_r17(spark, sf):
    return _stable(R.recurring_patterns(L(spark, sf).stress), ["peak_hour_of_day_rate", "peak_month_rate"])


@reg("r18_stress_correlations", f"""
select trading_hub, {O.r('corr(demand_forecast_error_mwh, cast(price_spike_flag as double))', 6)} as corr_forecast_error_spike,
  {O.r('corr(demand_supply_gap_mwh, cast(price_spike_flag as double))', 6)} as corr_gap_spike
from stress group by trading_hub""")
def q_r18(spark, sf):
    return _stable(R.stress_correlations(L(spark, sf).stress), ["corr_forecast_error_spike", "corr_gap_spike"])


@reg("r19_cost_premium", f"""
select trading_hub, {O.r('s', 6)} as avg_lmp_spike, {O.r('n', 6)} as avg_lmp_normal, {O.r('s - n', 6)} as premium,
  {O.r('case when n <> 0 then s / n end', 6)} as premium_ratio
from (select trading_hub, avg(case when price_spike_flag = 1 then lmp_avg end) as s,
  avg(case when price_spike_flag <> 1 then lmp_avg end) as n from stress group by trading_hub) g""")
def q_r19(spark, sf):
    return _stable(R.cost_premium(L(spark, sf).stress), ["avg_lmp_spike", "avg_lmp_normal", "premium", "premium_ratio"])


@reg("r20_hedging_windows", f"""
select trading_hub, hour_of_day, {O.r('spike_rate', 6)} as spike_rate, hours from (
  select trading_hub, hour_of_day, avg(price_spike_flag) as spike_rate, count(*) as hours
  from stress group by 1, 2) g where spike_rate >= 0.1""")
def q_r20(spark, sf):
    return _stable(R.hedging_windows(L(spark, sf).stress, 0.1), ["spike_rate"])


@reg("r21_notable_hours", f"""
select hour_utc, trading_hub, lmp_avg, {O.r('z', 6)} as z_score from (
  select hour_utc, trading_hub, lmp_avg,
    case when lmp_historical_stddev <> 0 then (lmp_avg - lmp_historical_mean) / lmp_historical_stddev end as z
  from stress) x where abs(z) >= 3.0""")
def q_r21(spark, sf):
    return _stable(R.notable_hours(L(spark, sf).stress, 3.0), ["z_score"])


@reg("r22_highest_risk", f"""
select trading_hub, hour_of_day, {O.r('spike_rate', 6)} as spike_rate from (
  select trading_hub, hour_of_day, avg(price_spike_flag) as spike_rate from stress group by 1, 2) g
order by spike_rate desc, trading_hub, hour_of_day limit 1""")
def q_r22(spark, sf):
    return _stable(R.highest_risk(L(spark, sf).stress), ["spike_rate"])


@reg("r23_coverage_stats", """
select trading_hub, count(*) as hours, min(hour_utc) as first_hour, max(hour_utc) as last_hour,
  count(distinct cast(hour_utc as date)) as days from stress group by trading_hub""")
def q_r23(spark, sf):
    return R.coverage_stats(L(spark, sf).stress)


# =============================================================== ML frame (SQL-checkable parts)
_NEXT = """(select s.*, lead(price_spike_flag, 1) over (partition by trading_hub order by hour_utc)
  as next_hour_price_spike_flag from stress s) n"""
_FRAME = f"(select * replace (cast(next_hour_price_spike_flag as integer) as next_hour_price_spike_flag) from {_NEXT} where next_hour_price_spike_flag is not null) fr"
_SQL_NUM = {c: (f"cast({c} as double)" if c == "is_weekend" else c) for c in _FRAME_NUM}


def _frame(spark, sf):
    lay = L(spark, sf)
    return ml.next_hour_target(lay.stress)


@reg("e02_next_hour_target", f"select hour_utc, trading_hub, price_spike_flag, next_hour_price_spike_flag from {_FRAME}")
def q_e02(spark, sf):
    return _frame(spark, sf).select("hour_utc", "trading_hub", "price_spike_flag", ml.TARGET)


@reg("e02_next_hour_target_distributed",
     f"select hour_utc, trading_hub, price_spike_flag, next_hour_price_spike_flag from {_FRAME}")
def q_e02d(spark, sf):
    fr = ml.next_hour_target(L(spark, sf).stress, method="join")
    return fr.select("hour_utc", "trading_hub", "price_spike_flag", ml.TARGET)


@reg("d11_class_counts", f"select next_hour_price_spike_flag, count(*) as n from {_FRAME} group by 1")
def q_d11(spark, sf):
    return ml.class_counts(_frame(spark, sf))


@reg("b17_violation_rows", f"select * replace ({_r6(_INEXACT)}) from stress where demand_mwh is null")
def q_b17(spark, sf):
    return _stable(clean.violations(L(spark, sf).stress, F.col("demand_mwh").isNull()), _INEXACT)


def _imputed_sql() -> str:
    med = ", ".join(f"list_sort(list({e}) filter (where {e} is not null)) as {c}__v" for c, e in _SQL_NUM.items())
    fill = {c: f"coalesce({e}, {O.interp(f'm.{c}__v', f'len(m.{c}__v)', 0.5)})" for c, e in _SQL_NUM.items()}
    fill["lmp_stddev"] = O.r(fill["lmp_stddev"], 6)        # float stddev: reported at 6 dp
    cols = ", ".join(f"{x} as {c}" for c, x in fill.items())
    return (f"select fr.hour_utc, {cols}, coalesce(fr.trading_hub, 'UNKNOWN') as trading_hub, "
            f"fr.next_hour_price_spike_flag from {_FRAME} join (select {med} from {_FRAME}) m on true")


@reg("m04_imputed_frame", _imputed_sql())
def q_m04(spark, sf):
    lay = L(spark, sf)
    return _stable(ml.build_features(lay.stress).df, ["lmp_stddev"])


@reg("d12_all_null_columns", "select " + ", ".join(f"count({c}) as {c}" for c in _FRAME_NUM) + f" from {_FRAME}")
def q_d12(spark, sf):
    return ml.all_null_columns(_frame(spark, sf), _FRAME_NUM)


@reg("d13_medians", "select " + ", ".join(
    f"{O.r(f'quantile_cont({e}, 0.5)', 6)} as {c}" for c, e in _SQL_NUM.items()) + f" from {_FRAME}")
def q_d13(spark, sf):
    return _stable(ml.medians(_frame(spark, sf), _FRAME_NUM), _FRAME_NUM)


_SPLIT_H = "md5(concat_ws('|', '42', trading_hub, cast(hour_utc as varchar)))"


@reg("e04_stratified_split", f"""
select hour_utc, trading_hub, next_hour_price_spike_flag,
  row_number() over (partition by next_hour_price_spike_flag order by {_SPLIT_H})
    <= ceil(count(*) over (partition by next_hour_price_spike_flag) * 0.25e0) as is_test
from {_FRAME}""")
def q_e04(spark, sf):
    lay = L(spark, sf)
    fr = ml.next_hour_target(lay.stress)
    return ml.stratified_split(fr).select("hour_utc", "trading_hub", ml.TARGET, "is_test")


@reg("e04_stratified_split_distributed", f"""
select hour_utc, trading_hub, next_hour_price_spike_flag,
  row_number() over (partition by next_hour_price_spike_flag order by {_SPLIT_H})
    <= ceil(count(*) over (partition by next_hour_price_spike_flag) * 0.25e0) as is_test
from {_FRAME}""")
def q_e04d(spark, sf):
    s = ml.stratified_split(ml.next_hour_target(L(spark, sf).stress, method="join"), method="distributed")
    return s.select("hour_utc", "trading_hub", ml.TARGET, "is_test")


@reg("e05_temporal_split", f"""
select hour_utc, trading_hub, hour_utc >= (
  select hour_utc from (select hour_utc, row_number() over (order by hour_utc) as rn, count(*) over () as n
                        from (select distinct hour_utc from {_FRAME}) d) x
  where rn = n - cast(ceil(n * 0.25e0) as bigint) + 1) as is_test
from {_FRAME}""")
def q_e05(spark, sf):
    return ml.temporal_split(_frame(spark, sf)).select("hour_utc", "trading_hub", "is_test")


@reg("m05_scaler_stats", "select " + ", ".join(
    f"{O.r(f'avg({e})', 6)} as {c}__mean, {O.r(f'stddev_pop({e})', 6)} as {c}__std" for c, e in _SQL_NUM.items())
    + f" from {_FRAME}")
def q_m05(spark, sf):
    fr = _frame(spark, sf).withColumn("is_weekend", F.col("is_weekend").cast("double"))
    st = ml.scaler_stats(fr, _FRAME_NUM)
    return _stable(st, st.columns)


@reg("m07_balanced_weights", f"""
select hour_utc, trading_hub, next_hour_price_spike_flag,
  cast(count(*) over () as double) / (2.0e0 * count(*) over (partition by next_hour_price_spike_flag)) as class_weight
from {_FRAME}""")
def q_m07(spark, sf):
    return ml.balanced_weights(_frame(spark, sf)).select("hour_utc", "trading_hub", ml.TARGET, "class_weight")


@reg("m14_baseline_metrics", f"""
select n, tp, fp, fn, tn, (tp + tn) / cast(n as double) as accuracy,
  coalesce(case when tp + fp > 0 then tp / cast(tp + fp as double) end, 0.0e0) as precision_score,
  coalesce(case when tp + fn > 0 then tp / cast(tp + fn as double) end, 0.0e0) as recall_score,
  coalesce(case when 2 * tp + fp + fn > 0 then 2.0e0 * tp / (2 * tp + fp + fn) end, 0.0e0) as f1_score
from (select count(*) as n, count_if(y = 1 and p = 1) as tp, count_if(y = 0 and p = 1) as fp,
             count_if(y = 1 and p = 0) as fn, count_if(y = 0 and p = 0) as tn
      from (select next_hour_price_spike_flag as y,
                   case when lmp_lag_1h >= lmp_p95_threshold then 1 else 0 end as p from {_FRAME}) b) c""")
def q_m14(spark, sf):
    return ml.binary_metrics(ml.baseline_predictions(_frame(spark, sf)))


@reg("d15_price_rank_auc", f"""
select {O.r('case when P > 0 and N > 0 then (sr - P * (P + 1) / 2.0e0) / (P * cast(N as double)) end', 6)} as roc_auc
from (select sum(case when y = 1 then rk end) as sr, count_if(y = 1) as P, count_if(y = 0) as N
      from (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0e0 as rk
            from (select next_hour_price_spike_flag as y, lmp_avg as s from {_FRAME} where lmp_avg is not null) a) b) c""")
def q_d15(spark, sf):
    return _stable(ml.roc_auc(_frame(spark, sf), score_col="lmp_avg"), ["roc_auc"])


@reg("m15_feature_correlations", " union all ".join(
    f"select '{c}' as feature, {O.r(f'corr({e}, cast(next_hour_price_spike_flag as double))', 6)} as correlation from {_FRAME}"
    for c, e in _SQL_NUM.items()))
def q_m15(spark, sf):
    return _stable(ml.feature_correlations(_frame(spark, sf), _FRAME_NUM), ["correlation"])


@reg("m16_lag_regression", f"""
select trading_hub, {O.r('regr_slope(lmp_avg, lmp_lag_1h)', 6)} as slope,
  {O.r('regr_intercept(lmp_avg, lmp_lag_1h)', 6)} as intercept, {O.r('regr_r2(lmp_avg, lmp_lag_1h)', 6)} as r2,
  cast(regr_count(lmp_avg, lmp_lag_1h) as bigint) as n
from stress group by trading_hub""")
def q_m16(spark, sf):
    return _stable(ml.lag_regression(L(spark, sf).stress), ["slope", "intercept", "r2"])


@reg("m16_price_regression", f"""
with x as (select lmp_avg as y, lmp_lag_1h as a, lmp_lag_24h as b from stress where lmp_lag_24h is not null and lmp_lag_1h is not null and lmp_avg is not null),
m as (select avg(y) as my, avg(a) as ma, avg(b) as mb, count(*)::bigint as n from x),
s as (select sum((a - ma) * (a - ma)) as aa, sum((b - mb) * (b - mb)) as bb, sum((a - ma) * (b - mb)) as ab,
  sum((a - ma) * (y - my)) as ay, sum((b - mb) * (y - my)) as by_ from x, m),
c as (select (ay * bb - by_ * ab) / (aa * bb - ab * ab) as ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) as cb from s)
select feature, {O.r("v", 6)} as coefficient, n from m, (
  select '' as feature, my - ca * ma - cb * mb as v from c, m union all select 'lmp_lag_1h', ca from c union all select 'lmp_lag_24h', cb from c) f""".replace("with x as", "select * from (with x as", 1) + ") z")
def q_m16m(spark, sf):
    return _stable(ml.least_squares(L(spark, sf).features, ["lmp_lag_1h", "lmp_lag_24h"]), ["coefficient"])


# ------------------------------------------------------- inputs and scores of a fitted table
_IN = ["lmp_avg", "lmp_lag_1h", "lmp_lag_168h", "demand_mwh"]
_WEIGHTS = {("lmp_avg", None): 0.75, ("lmp_lag_1h", None): -0.5, ("lmp_lag_168h", None): 0.125, ("demand_mwh", None): 0.25,
            ("trading_hub", "NP15"): 0.375, ("trading_hub", "SP15"): -0.625}


def _inputs_sql(train: str) -> str:
    """Rows of the frame with the scaled inputs z_<c> by the fills, means and deviations of the rows where ``train`` holds."""
    med = ", ".join(f"list_sort(list({c}) filter (where {c} is not null and {train})) as {c}__v" for c in _IN)
    fill = ", ".join(f"{O.interp(f'{c}__v', f'len({c}__v)', 0.5)} as {c}__f" for c in _IN)
    stats = ", ".join(f"avg(coalesce({c}, {c}__f)) as {c}__m, stddev_pop(coalesce({c}, {c}__f)) as {c}__s" for c in _IN)
    z = ", ".join(f"(coalesce({c}, {c}__f) - {c}__m) / {c}__s as z_{c}" for c in _IN)
    return f"""(select fr.*, {z} from {_FRAME}, (select {fill} from (select {med} from {_FRAME}) v) f,
  (select {stats} from {_FRAME}, (select {fill} from (select {med} from {_FRAME}) v) g where {train}) s)"""


_MARGIN = " + ".join([f"{w} * z_{c}" for (c, level), w in _WEIGHTS.items() if level is None]
                     + [f"{w} * (trading_hub = '{level}')::int" for (c, level), w in _WEIGHTS.items() if level])


@reg("m04_train_only_inputs", f"""
select hour_utc, trading_hub, {", ".join(f"{O.r(f'z_{c}', 6)} as {c}" for c in _IN)}, (trading_hub = 'NP15')::int::double as is_np15,
  (trading_hub = 'SP15')::int::double as is_sp15, 6::int as n_inputs
from {_inputs_sql("trading_hub <> 'ZP26'")} i""")
def q_m04t(spark, sf):
    """M-4 / M-6: everything is learned without hub ZP26, whose rows then get the training fills and no level."""
    fr = materialise_frame(_frame(spark, sf))
    fitted = PP.fit(fr.filter("trading_hub <> 'ZP26'"), _IN, ["trading_hub"])
    out = PP.apply(fr, fitted)
    return _stable(out.select("hour_utc", "trading_hub", *[F.col("inputs")[i].alias(c) for i, c in enumerate(_IN)],
                              F.col("inputs")[4].alias("is_np15"), F.col("inputs")[5].alias("is_sp15"), F.size("inputs").alias("n_inputs")), _IN)


@reg("m09_fixed_scores", f"""
select hour_utc, trading_hub, {O.r(f"1 / (1 + exp(-({_MARGIN} - 1.5e0)))", 6)} as predicted_spike_probability
from {_inputs_sql("trading_hub <> 'ZP26'")} i""")
def q_m09(spark, sf):
    fr = materialise_frame(_frame(spark, sf))
    fitted = PP.fit(fr.filter("trading_hub <> 'ZP26'"), _IN, ["trading_hub"])
    out = PP.linear_probability(fr, fitted, _WEIGHTS, -1.5)
    return _stable(out.select("hour_utc", "trading_hub", "predicted_spike_probability"), ["predicted_spike_probability"])


def _auc_sql(score: str, of: str, by: str = "") -> str:
    part = f"partition by {by}" if by else ""
    return f"""(select {by + ', ' if by else ''}case when count_if(y = 1) > 0 and count_if(y = 0) > 0 then (sum(case when y = 1 then rk end)
    - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0e0) / (count_if(y = 1) * cast(count_if(y = 0) as double)) end as auc
  from (select *, rank() over ({part} order by s) + (count(*) over (partition by {by + ', ' if by else ''}s) - 1) / 2.0e0 as rk
        from (select *, {score} as s from {of}) a) b {'group by ' + by if by else ''})"""


_PERM = ["lmp_avg", "lmp_lag_1h", "demand_mwh"]
_H = lambda seed: f"md5(concat_ws('|', '{seed}', trading_hub, cast(hour_utc as varchar)))"


@reg("m13_permutation_importance", f"""
select * from (with i as (select *, next_hour_price_spike_flag as y from {_inputs_sql("true")} i),
t as (select *, row_number() over (order by {_H(7)}) as r1, row_number() over (order by {_H(8)}) as r2 from i),
p as (select t.* replace ({", ".join(f"case when feature = '{c}' then d.z_{c} else t.z_{c} end as z_{c}" for c in _PERM)}), feature
  from t join t as d on d.r2 = t.r1, (values {", ".join(f"('{c}')" for c in _PERM)}) as f(feature))
select feature, {O.r("b.auc", 6)} as base_auc, {O.r("q.auc", 6)} as permuted_auc
from {_auc_sql(_MARGIN, "t")} b, {_auc_sql(_MARGIN, "p", "feature")} q) z""")
def q_m13p(spark, sf):
    """M-13 with given coefficients on all rows, so that SQL can follow it to the number."""
    fr = materialise_frame(_frame(spark, sf))
    fitted = PP.fit(fr, _IN, ["trading_hub"])
    score = lambda df: PP.apply(df, fitted, _WEIGHTS).withColumnRenamed("margin", "predicted_spike_probability")
    out = ml_outputs.permutation_importance(score, fr, _PERM)
    return _stable(out.select("feature", "base_auc", "permuted_auc"), ["base_auc", "permuted_auc"])


# =============================================================== model (rows-only checks)
def _trained(spark, sf, kind="logreg"):
    lay = L(spark, sf)
    ff = ml.build_features(lay.stress)
    split = materialise_frame(ml.stratified_split(ff.df))
    train, test = split.filter("not is_test"), split.filter("is_test")
    model = ml.train_classifier(train, ff.numeric, ff.categorical, kind=kind)
    return ff, train, test, model


_SPLIT = f"""(select hour_utc, trading_hub, lmp_avg, demand_mwh, next_hour_price_spike_flag as y,
  row_number() over (partition by next_hour_price_spike_flag order by {_SPLIT_H})
    <= ceil(count(*) over (partition by next_hour_price_spike_flag) * 0.25e0) as is_test from {_FRAME})"""


@reg("m08_fit_certificate", f"select count(*)::bigint as training_rows, sum(y)::bigint as positives, true as stationary from {_SPLIT} s where not is_test")
def q_m08(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    flat = ml.fit_gradient(model, train).agg(F.max(F.abs("gradient")).alias("g"))
    return train.agg(F.count(F.lit(1)).alias("training_rows"), F.sum(ml.TARGET).alias("positives")).join(F.broadcast(flat)).select(
        "training_rows", "positives", (F.col("g") < 1e-4).alias("stationary"))


@reg("m10_prediction_rows", f"""
select hour_utc, trading_hub, y as actual_price_spike_flag, {O.r("lmp_avg", 6)} as lmp_avg,
  true as sane from {_SPLIT} s where is_test""")
def q_m10r(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    p = F.col("predicted_spike_probability")
    out = ml_outputs.predictions(ml.score(model, test), f"{MODEL_VERSION_PREFIX}_r1")
    return _stable(out.select("hour_utc", "trading_hub", "actual_price_spike_flag", "lmp_avg", (
        p.between(0, 1) & ((p > 0.5).cast("int") == F.col("predicted_price_spike_flag"))).alias("sane")), ["lmp_avg"])


@reg("m11_metric_rows", f"""
select (select count(*) from {_SPLIT} s where not is_test)::bigint as training_row_count, (select count(*) from {_SPLIT} s where is_test)::bigint as test_row_count,
  true as consistent""")
def q_m11r(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    row = ml_outputs.model_metrics(ml.score(model, test), train, f"{MODEL_VERSION_PREFIX}_r1")
    share = lambda c: F.col(c).between(0, 1)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision_score") * F.col("recall_score"), F.col("precision_score") + F.col("recall_score")), F.lit(0.0))
    return row.select("training_row_count", "test_row_count", (
        share("accuracy") & share("roc_auc") & (F.abs(f1 - F.col("f1_score")) < 1e-9)).alias("consistent"))


@reg("m10_predictions", None)
def q_m10(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    return ml_outputs.predictions(ml.score(model, test), f"{MODEL_VERSION_PREFIX}_r1")


@reg("m11_model_metrics", None)
def q_m11(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    return ml_outputs.model_metrics(ml.score(model, test), train, f"{MODEL_VERSION_PREFIX}_r1")


@reg("m17_random_forest_metrics", None)
def q_m17(spark, sf):
    ff, train, test, model = _trained(spark, sf, kind="rf")
    return ml.binary_metrics(ml.score(model, test))


@reg("m13_feature_importance", None)
def q_m13(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    return ml_outputs.feature_importance(model, test)


@reg("r14_probability_by_hour", None)
def q_r14(spark, sf):
    ff, train, test, model = _trained(spark, sf)
    return R.probability_by_hour(ml.score(model, test))


# =============================================================== streaming
def _stream_events(spark, sf):
    return SP.stream_table(spark, sf, "events", adapters.table(spark, sf, "events").schema)


def _stream_ck(spark) -> str:
    import uuid
    base = checkpoint_dir(spark, lambda: shared_fallback(spark))
    return f"{base.rstrip('/')}/streams/{uuid.uuid4().hex}"


def _run(df, spark):
    folder = _stream_ck(spark)
    return SP.run_to_parquet(df, f"{folder}/rows", f"{folder}/progress")


_CLOSED = "hour_utc + interval 1 hour <= (select max(interval_start) from lmp_5min) - interval 2 hour"


@reg("s01_streaming_hourly_prices", f"select * replace ({_r6(['lmp_stddev'])}) from stg_lmp where {_CLOSED}")
def q_s01(spark, sf):
    out = _run(SP.streaming_hourly_prices(adapters.lmp_from_events(_stream_events(spark, sf))), spark)
    return _stable(out, ["lmp_stddev"])


@reg("s02_streaming_dedupe", """
select count(*) as rows, min(interval_start) as first_interval, max(interval_start) as last_interval
from (select distinct interval_start, trading_hub, market from lmp_5min) d""")
def q_s02(spark, sf):
    out = _run(SP.dedupe_intervals(adapters.lmp_from_events(_stream_events(spark, sf))), spark)
    ntz = instant_to_utc_ntz("interval_start")
    return out.agg(F.count(F.lit(1)).alias("rows"), F.min(ntz).alias("first_interval"),
                   F.max(ntz).alias("last_interval"))


@reg("s03_streaming_scores", f"""
select s.hour_utc, s.trading_hub, s.lmp_avg, s.lmp_p95_threshold, s.lmp_p99_threshold, s.price_spike_flag,
  s.stress_severity from stress s
where {_CLOSED.replace('hour_utc', 's.hour_utc')}""")
def q_s03(spark, sf):
    th = ST.hub_thresholds(L(spark, sf).features)
    hourly = SP.streaming_hourly_prices(adapters.lmp_from_events(_stream_events(spark, sf))).filter("market = 'RTM'")
    out = _run(SP.score_stream(hourly, th), spark)
    return out.drop("market")


# =============================================================== generic tables
@reg("g01_orders_coverage", """
select o_orderstatus, count(*) as row_count, min(o_orderdate) as earliest, max(o_orderdate) as latest
from orders group by o_orderstatus""")
def q_g01(spark, sf):
    return R.coverage(adapters.table(spark, sf, "orders"), "o_orderstatus", "o_orderdate")


@reg("g02_lineitem_top_price", """
select * from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber limit 10""")
def q_g02(spark, sf):
    li = adapters.table(spark, sf, "lineitem")
    return R.sample_rows(li, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"], 10)


@reg("g03_lineitem_daily", """
select date_trunc('day', l_shipdate) as bucket_start, l_returnflag, sum(l_quantity) as qty, count(*) as lines
from lineitem group by 1, 2""")
def q_g03(spark, sf):
    li = adapters.table(spark, sf, "lineitem")
    return hourly.time_rollup(li, "l_shipdate", "1 day", ["l_returnflag"],
                              {"qty": "sum(l_quantity)", "lines": "count(1)"})


# =============================================================== contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: each hour and hub with its stress severity (sf0.001)."""
    return _shipping(q_b13)(spark, SF_SMOKE)


# the training-data queries are optional: without their folder, or without a library that they need, everything
# else works
try:
    from market_engine.llm.queries import QUERIES as _LLM
    _Q.update(_LLM)
except ImportError as e:
    print(f"training-data queries are left out: {e}", file=sys.stderr)


def _shipping(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``fn`` on a session whose workers have the package, from whatever folder the driver was started."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _shipping(v[0]) for k, v in _Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _Q.items() if v[1] is not None}
