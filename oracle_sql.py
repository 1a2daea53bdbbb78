"""DuckDB formulations of the registered queries (the correctness oracle).

Written independently of the Spark code, against the raw test tables only. Shared stages are
CTEs assembled below; every query string is self-contained.
"""

from __future__ import annotations


def r(expr: str, d: int) -> str:
    """Half-away-from-zero rounding on the binary value (same IEEE steps as the Spark helper)."""
    m = f"{10 ** d}.0e0"
    return f"(sign({expr}) * floor(abs({expr}) * {m} + 0.5e0) / {m})"


def xavg(c: str, decimals: int = 5) -> str:
    m = f"{10 ** decimals}.0e0"
    return f"(cast(sum(cast(round({c} * {m}) as bigint)) as double) / (count({c}) * {m}))"


def interp(values: str, n: str, q: float) -> str:
    """Interpolated percentile from a sorted 1-based list: position (n-1)q between the two
    neighbouring order statistics, weights (ceil - pos) and (pos - floor); an exact position or
    equal neighbours give the value itself."""
    pos = f"(({n} - 1) * {q}e0)"
    lo, hi = f"{values}[cast(floor({pos}) as bigint) + 1]", f"{values}[cast(ceil({pos}) as bigint) + 1]"
    return (f"case when floor({pos}) = ceil({pos}) or {lo} = {hi} then {lo} "
            f"else (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} end")


K = "cast(json_extract_string(props, '$.k') as bigint)"

CALENDAR = """cast(hour(j.hour_utc) as integer) as hour_of_day,
  cast(isodow(j.hour_utc) - 1 as integer) as day_of_week,
  (isodow(j.hour_utc) - 1) >= 5 as is_weekend,
  cast(month(j.hour_utc) as integer) as month,
  cast(year(j.hour_utc) as integer) as year"""

CTES = {
    "lmp_5min": f"""
select ts as interval_start, ts + interval 5 minute as interval_end,
  case user_id % 3 when 0 then ' np15' when 1 then 'SP15 ' else 'Zp26' end as trading_hub,
  value as lmp,
  (cast(round(value * 100) as bigint) - {K} - event_id % 7) / 100.0e0 as energy_component,
  {K} / 100.0e0 as congestion_component,
  (event_id % 7) / 100.0e0 as loss_component,
  case when event_id % 10 = 9 then ' dam' else 'rtm ' end as market,
  'events_feed' as source_system,
  timestamp '2024-02-01 00:00:00' as loaded_at
from events""",
    "ops_long": """
select strftime(ts, '%Y-%m-%dT%H') as period,
  case user_id % 2 when 0 then 'CISO' else 'MISO' end as respondent,
  case event_type when 'view' then 'D' when 'click' then 'DF' when 'purchase' then 'NG'
    when 'signup' then 'TI' else 'ZZ' end as type,
  case when event_id % 97 = 0 then 'n/a' else cast(value as varchar) end as value,
  event_id as seq
from events""",
    "ops_hourly": """
select try_strptime(period, '%Y-%m-%dT%H') as period, respondent as balancing_authority,
  min_by(v, seq) filter (where type = 'D') as demand_mwh,
  min_by(v, seq) filter (where type = 'DF') as demand_forecast_mwh,
  min_by(v, seq) filter (where type = 'NG') as net_generation_mwh,
  min_by(v, seq) filter (where type = 'TI') as interchange_mwh,
  'events_feed' as source_system, timestamp '2024-02-01 00:00:00' as loaded_at
from (select period, respondent, type, try_cast(value as double) as v, seq from ops_long
      where type in ('D', 'DF', 'NG', 'TI')) s
where v is not null
group by period, respondent""",
    "stg_lmp": f"""
select date_trunc('hour', interval_start) as hour_utc,
  upper(trim(trading_hub)) as trading_hub, upper(trim(market)) as market,
  {xavg('lmp')} as lmp_avg, min(lmp) as lmp_min, max(lmp) as lmp_max, stddev_samp(lmp) as lmp_stddev,
  {xavg('energy_component')} as energy_component_avg,
  {xavg('congestion_component')} as congestion_component_avg,
  {xavg('loss_component')} as loss_component_avg,
  count(*) as interval_count, source_system, max(loaded_at) as loaded_at
from lmp_5min
where interval_start is not null and trading_hub is not null
group by 1, 2, 3, source_system""",
    "stg_ops": """
select period as hour_utc, upper(trim(balancing_authority)) as balancing_authority,
  demand_mwh, demand_forecast_mwh, net_generation_mwh, interchange_mwh,
  demand_mwh - net_generation_mwh as demand_supply_gap_mwh,
  demand_mwh - demand_forecast_mwh as demand_forecast_error_mwh,
  source_system, loaded_at
from ops_hourly where period is not null and balancing_authority is not null""",
    "joined": """
select c.hour_utc, c.trading_hub, c.lmp_avg, c.lmp_min, c.lmp_max, c.lmp_stddev,
  c.energy_component_avg, c.congestion_component_avg, c.loss_component_avg,
  e.demand_mwh, e.demand_forecast_mwh, e.net_generation_mwh, e.interchange_mwh,
  e.demand_supply_gap_mwh, e.demand_forecast_error_mwh
from (select * from stg_lmp where market = 'RTM') c
left join (select * from stg_ops where balancing_authority = 'CISO') e on c.hour_utc = e.hour_utc""",
    "features": f"""
select j.*,
  lag(lmp_avg, 1) over (partition by trading_hub order by hour_utc) as lmp_lag_1h,
  lag(lmp_avg, 24) over (partition by trading_hub order by hour_utc) as lmp_lag_24h,
  lag(lmp_avg, 168) over (partition by trading_hub order by hour_utc) as lmp_lag_168h,
  {CALENDAR}
from joined j""",
    "features_time": f"""
select j.*, l1.lmp_avg as lmp_lag_1h, l24.lmp_avg as lmp_lag_24h, l168.lmp_avg as lmp_lag_168h,
  {CALENDAR}
from joined j
left join joined l1 on l1.trading_hub = j.trading_hub and l1.hour_utc = j.hour_utc - interval 1 hour
left join joined l24 on l24.trading_hub = j.trading_hub and l24.hour_utc = j.hour_utc - interval 24 hour
left join joined l168 on l168.trading_hub = j.trading_hub and l168.hour_utc = j.hour_utc - interval 168 hour""",
    "thresholds": f"""
select trading_hub, {interp('v', 'len(v)', 0.95)} as lmp_p95_threshold,
  {interp('v', 'len(v)', 0.99)} as lmp_p99_threshold, m as lmp_historical_mean, sd as lmp_historical_stddev
from (select trading_hub, list_sort(list(lmp_avg) filter (where lmp_avg is not null)) as v,
             avg(lmp_avg) as m, stddev_samp(lmp_avg) as sd
      from features group by trading_hub) t""",
    "stress": """
select f.hour_utc, f.trading_hub, f.lmp_avg, f.lmp_min, f.lmp_max, f.lmp_stddev,
  f.energy_component_avg, f.congestion_component_avg, f.loss_component_avg,
  t.lmp_p95_threshold, t.lmp_p99_threshold, t.lmp_historical_mean, t.lmp_historical_stddev,
  case when f.lmp_avg >= t.lmp_p95_threshold then 1 else 0 end as price_spike_flag,
  case when f.lmp_avg >= t.lmp_p99_threshold then 'EXTREME'
       when f.lmp_avg >= t.lmp_p95_threshold then 'SPIKE'
       when f.lmp_avg >= t.lmp_historical_mean + t.lmp_historical_stddev then 'ELEVATED'
       else 'NORMAL' end as stress_severity,
  f.demand_mwh, f.demand_forecast_mwh, f.net_generation_mwh, f.interchange_mwh,
  f.demand_supply_gap_mwh, f.demand_forecast_error_mwh,
  f.lmp_lag_1h, f.lmp_lag_24h, f.lmp_lag_168h,
  f.hour_of_day, f.day_of_week, f.is_weekend, f.month, f.year
from features f left join thresholds t on f.trading_hub = t.trading_hub""",
    "dashboard": f"""
select hour_utc, year, month, hour_of_day, day_of_week, is_weekend, trading_hub,
  {r('lmp_avg', 2)} as lmp_avg_usd_mwh, {r('lmp_min', 2)} as lmp_min_usd_mwh,
  {r('lmp_max', 2)} as lmp_max_usd_mwh, {r('lmp_stddev', 2)} as lmp_stddev_usd_mwh,
  {r('lmp_p95_threshold', 2)} as spike_threshold_p95, {r('lmp_p99_threshold', 2)} as spike_threshold_p99,
  {r('energy_component_avg', 2)} as energy_component_avg,
  {r('congestion_component_avg', 2)} as congestion_component_avg,
  {r('loss_component_avg', 2)} as loss_component_avg,
  price_spike_flag, stress_severity,
  {r('demand_mwh', 0)} as demand_mwh, {r('demand_forecast_mwh', 0)} as demand_forecast_mwh,
  {r('net_generation_mwh', 0)} as net_generation_mwh, {r('interchange_mwh', 0)} as interchange_mwh,
  {r('demand_supply_gap_mwh', 0)} as demand_supply_gap_mwh,
  {r('demand_forecast_error_mwh', 0)} as demand_forecast_error_mwh,
  {r('lmp_lag_1h', 2)} as lmp_lag_1h, {r('lmp_lag_24h', 2)} as lmp_lag_24h, {r('lmp_lag_168h', 2)} as lmp_lag_168h,
  case when lmp_p95_threshold > 0
    then {r('(lmp_avg - lmp_p95_threshold) / lmp_p95_threshold * 100', 1)} end as pct_above_spike_threshold
from stress where lmp_avg is not null""",
}


def bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` is HUGEINT; Spark's is BIGINT. Wrap every call in a BIGINT cast."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_counts(sql[j + len(key):k - 1])
        out.append(sql[i:j] + "cast(count_if(" + inner + ") as bigint)")
        i = k


def with_ctes(body: str) -> str:
    """Prefix a query body with every shared stage as a CTE."""
    ctes = ",\n".join(f"{name} as ({sql}\n)" for name, sql in CTES.items())
    return bigint_counts(f"with {ctes}\n{body}")



