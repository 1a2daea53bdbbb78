"""Declarative data-quality checks.

A suite is a list of ``Check`` specs. ``run_checks`` evaluates every check on one table in a
single scan (one global aggregate of ``count_if`` columns, partial-aggregated per task), then
unpivots to one report row per check. The report is tiny (one row per check); only
``assert_checks`` brings it to the driver, to raise on failed error-severity checks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.constants import INTERVALS_PER_HOUR, SEVERITIES

HUBS = ("NP15", "SP15", "ZP26")


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | accepted_values | expression
    column: str
    values: Sequence = field(default_factory=tuple)
    severity: str = "error"        # error | warn | info
    predicate: str | None = None   # SQL predicate marking a FAILING row (kind="expression")
    name: str | None = None

    def test_name(self, table: str) -> str:
        return self.name or f"{self.kind}_{table}_{self.column}"

    def failing(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            # NULL is not a violation (SQL three-valued logic), as in warehouse schema tests
            return ~c.isin(list(self.values))
        if self.kind == "expression":
            return F.expr(self.predicate)
        raise ValueError(f"unknown check kind {self.kind!r}")


def not_null(column: str, severity: str = "error") -> Check:
    """DQ-1."""
    return Check("not_null", column, severity=severity)


def accepted_values(column: str, values: Iterable, severity: str = "error") -> Check:
    """DQ-2."""
    return Check("accepted_values", column, tuple(values), severity)


def expression(name: str, predicate: str, severity: str = "error", column: str = "") -> Check:
    return Check("expression", column, severity=severity, predicate=predicate, name=name)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """DQ-4: one report row per check: table_name, test_name, failing_rows, severity, status."""
    aggs = [F.count_if(F.coalesce(chk.failing(), F.lit(False))).alias(f"c{i}") for i, chk in enumerate(checks)]
    counts = df.agg(*aggs)
    rows = ", ".join(f"'{chk.test_name(table)}', '{chk.severity}', c{i}" for i, chk in enumerate(checks))
    long = counts.selectExpr(f"stack({len(checks)}, {rows}) as (test_name, severity, failing_rows)")
    status = (F.when(F.col("failing_rows") == 0, "pass")
              .when(F.col("severity") == "error", "fail").otherwise(F.col("severity")))
    return long.select(F.lit(table).alias("table_name"), "test_name",
                       F.col("failing_rows").cast("bigint").alias("failing_rows"), "severity",
                       status.alias("status"))


def assert_checks(report: DataFrame) -> DataFrame:
    """Raise when an error-severity check failed; warn/info checks never raise."""
    failed = report.filter(F.col("status") == "fail").select("table_name", "test_name", "failing_rows").collect()
    if failed:
        raise AssertionError("data tests failed: " + ", ".join(f"{r[0]}.{r[1]}={r[2]}" for r in failed))
    return report


def schema_suite() -> dict[str, list[Check]]:
    """The published suite: 19 not_null + 7 accepted_values over the four models."""
    flag = accepted_values("price_spike_flag", (0, 1))
    sev = accepted_values("stress_severity", SEVERITIES)
    hub = accepted_values("trading_hub", HUBS)
    return {
        "stg_lmp_hourly": [not_null("hour_utc"), not_null("trading_hub"),
                           accepted_values("trading_hub", HUBS, severity="warn"),
                           not_null("market"), not_null("lmp_avg")],
        "int_hourly_market_features": [not_null("hour_utc"), not_null("trading_hub"), not_null("lmp_avg"),
                                       not_null("hour_of_day"), not_null("day_of_week")],
        "mart_hourly_market_stress": [not_null("hour_utc"), not_null("trading_hub"), hub, not_null("lmp_avg"),
                                      not_null("price_spike_flag"), flag, not_null("stress_severity"), sev],
        "mart_price_spike_dashboard": [not_null("hour_utc"), not_null("trading_hub"), hub,
                                       not_null("lmp_avg_usd_mwh"), not_null("price_spike_flag"), flag,
                                       not_null("stress_severity"), sev],
    }


def sanity_suite() -> list[Check]:
    """DQ-5 / DQ-6: the must-be-zero checks on the mart, plus the informational NULL-demand count."""
    return [
        expression("null_hour_utc_count", "hour_utc is null"),
        expression("null_lmp_avg_count", "lmp_avg is null"),
        expression("invalid_spike_flag_count", "price_spike_flag not in (0, 1)"),
        expression("null_demand_mwh_count", "demand_mwh is null", severity="info"),
    ]


def violation_counts(stress: DataFrame) -> DataFrame:
    """D-10: the four sanity counts as one row, one pass."""
    return stress.agg(
        F.count_if(F.col("hour_utc").isNull()).alias("null_hour_utc_count"),
        F.count_if(F.col("lmp_avg").isNull()).alias("null_lmp_avg_count"),
        F.count_if(~F.col("price_spike_flag").isin(0, 1)).alias("invalid_spike_flag_count"),
        F.count_if(F.col("demand_mwh").isNull()).alias("null_demand_mwh_count"),
    )


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-9: keys occurring more than once at the stated grain, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def uniqueness_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-9 as one row: distinct keys, duplicated keys, rows in duplicated keys."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("distinct_keys"),
                 F.count_if(F.col("n") > 1).alias("duplicated_keys"),
                 F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("duplicated_rows"))


def complete_hours(stg_prices: DataFrame, expected: int = INTERVALS_PER_HOUR,
                   keys: Sequence[str] = ("trading_hub", "market")) -> DataFrame:
    """DQ-10: per hub/market, hours with the expected interval count vs incomplete ones."""
    ok = F.col("interval_count") == expected
    return stg_prices.groupBy(*keys).agg(F.count_if(ok).alias("complete_hours"),
                                          F.count_if(~ok).alias("incomplete_hours"),
                                          F.count(F.lit(1)).alias("hours"))


def missing_hours(df: DataFrame, key: str = "trading_hub", ts: str = "hour_utc") -> DataFrame:
    """DQ-11: hours absent between each key's first and last hour.

    The calendar is generated in two steps (days per key, then 24 hours per day), so no
    single row expands to a key's whole span; the anti-join then shuffles on (key, hour).
    """
    span = df.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    days = span.select(key, "_lo", "_hi", F.explode(F.sequence(
        F.to_date("_lo"), F.to_date("_hi"), F.expr("interval 1 day"))).alias("_day"))
    hours = days.select(key, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"), "_day")
    cal = hours.select(key, "_lo", "_hi", F.timestamp_add(
        "HOUR", F.col("_h"), F.col("_day").cast("timestamp_ntz")).alias(ts))
    cal = cal.filter((F.col(ts) >= F.col("_lo")) & (F.col(ts) <= F.col("_hi"))).select(key, ts)
    present = df.select(key, ts)
    return cal.join(present, [key, ts], "left_anti")


def component_mismatches(raw: DataFrame, eps: float = 1e-6) -> DataFrame:
    """DQ-12: rows whose energy + congestion + loss components do not sum to the price."""
    total = F.col("energy_component") + F.col("congestion_component") + F.col("loss_component")
    bad = F.abs(total - F.col("lmp")) > eps
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("component_mismatch_rows"))


def bad_timestamp_counts(df: DataFrame, raw_cols: Sequence[str], parsed_cols: Sequence[str]) -> DataFrame:
    """DQ-8: per column, values present in the input that did not parse."""
    return df.agg(*[F.count_if(F.col(r).isNotNull() & F.col(p).isNull()).alias(f"bad_{p}")
                    for r, p in zip(raw_cols, parsed_cols)])
