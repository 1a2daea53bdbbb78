"""Column-level helpers. All are built-in Catalyst expressions (codegen, no Python per row).

Timestamps are ``timestamp_ntz`` holding UTC wall clock. Helpers here never route an NTZ
value through the session time zone, so results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_key(c) -> Column:
    """B-3 / H-5: ``upper(trim(x))``."""
    return F.upper(F.trim(_c(c)))


def hour_bucket(ts, width: str = "1 hour") -> Column:
    """H-1: truncate an NTZ timestamp to the hour; stays NTZ (``date_trunc`` would return a zoned value)."""
    return F.window(_c(ts), width).start


def exact_avg(c, decimals: int = 5) -> Column:
    """Average of a fixed-point measure, computed on integer units.

    Prices are published with at most ``decimals`` decimals, so summing integer units is exact;
    the single division at the end is correctly rounded. The result is independent of the
    partitioning and of summation order (a plain float ``avg`` is not). A group that holds a value
    which is no such number (more decimals, NaN, beyond bigint) takes the plain ``avg`` of all its
    values: nothing is rounded away or left out. NULLs are ignored; all-NULL groups give NULL.
    """
    scale = 10 ** decimals
    x = _c(c).cast("double")
    units = F.round(x * scale).try_cast("bigint")
    whole = F.bool_and(F.coalesce(units / F.lit(float(scale)) == x, x.isNull()))
    total = F.try_sum(units).cast("double")
    return F.when(whole & (total.isNotNull() | (F.count(x) == 0)), F.try_divide(total, F.count(x) * float(scale))
                  ).otherwise(F.avg(x))


def round_half_away(c, digits: int = 2) -> Column:
    """H-6: round half away from zero on the binary value: ``sign(x)*floor(|x|*10^d+0.5)/10^d``."""
    x = _c(c)
    m = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * m + 0.5) / m


def stable(c, digits: int = 6) -> Column:
    """Round a float aggregate (stddev, percentile, mean of means) to ``digits`` for reporting."""
    return round_half_away(c, digits)


def ratio(num, den) -> Column:
    """Guarded division: NULL when the denominator is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def try_double(c) -> Column:
    """H-9: numeric parse; unparsable and NaN -> NULL (missing is SQL NULL, never NaN)."""
    v = _c(c).cast("string").try_cast("double")
    return F.when(~F.isnan(v), v)


def instant_to_utc_ntz(ltz) -> Column:
    """Zoned timestamp (an instant) -> NTZ holding its UTC wall clock, session-TZ independent."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ltz)), _epoch_ntz())


def utc_ntz_to_instant(ntz) -> Column:
    """NTZ holding UTC wall clock -> zoned timestamp of that instant, session-TZ independent."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(ntz)))


def parse_hour_period(c, fmt: str = "yyyy-MM-dd'T'HH") -> Column:
    """H-10: parse an hourly period string (UTC) into NTZ; unparsable -> NULL."""
    return instant_to_utc_ntz(F.try_to_timestamp(F.concat(_c(c), F.lit("+0000")), F.lit(fmt + "Z")))


def parse_iso_utc(c) -> Column:
    """H-10: ISO-8601 timestamp with optional offset -> UTC naive. No offset means UTC."""
    s = F.trim(_c(c).cast("string"))
    zoned = F.when(s.rlike(r"(Z|[+-]\d{2}(:?\d{2})?)$"), s).otherwise(F.concat(s, F.lit("Z")))
    return instant_to_utc_ntz(F.try_to_timestamp(zoned))


def format_seconds(c) -> Column:
    """H-11: NTZ -> 'yyyy-MM-dd HH:mm:ss' (NTZ formatting does not use the session zone)."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def calendar_columns(ts, week_start: str = "monday") -> dict[str, Column]:
    """H-2/H-3: calendar parts of an hour.

    ``week_start="monday"``: day_of_week 0=Mon..6=Sun (documented meaning; weekend = Sat, Sun).
    ``week_start="sunday"``: day_of_week 0=Sun..6=Sat (warehouse default numbering; the same
    ``>= 5`` weekend test then marks Fri and Sat).
    """
    t = _c(ts)
    if week_start == "monday":
        dow = F.weekday(t)
    elif week_start == "sunday":
        dow = F.dayofweek(t) - 1
    else:
        raise ValueError(f"week_start must be 'monday' or 'sunday', got {week_start!r}")
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": dow,
        "is_weekend": dow >= 5,
        "month": F.month(t),
        "year": F.year(t),
    }


def day_window(ts, start: str, end: str) -> Column:
    """B-10: inclusive day range [start 00:00, end 23:59:59.999999] as a half-open, prunable range."""
    t = _c(ts)
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.timestamp_add("DAY", F.lit(1), F.lit(end).cast("timestamp_ntz"))
    return (t >= lo) & (t < hi)


def on_date(ts, d: str) -> Column:
    """B-11: ``DATE(ts) = d``."""
    return F.to_date(_c(ts)) == F.lit(d).cast("date")


def compact_date(c) -> Column:
    """H-12: 'YYYY-MM-DD' -> 'YYYYMMDD' (request-window and id formatting)."""
    return F.regexp_replace(_c(c).cast("string"), "-", "")


def request_window(start_date, end_date) -> tuple[Column, Column]:
    """H-12 / B-10: a day range as the price API's window strings, 00:00 to 23:55 UTC."""
    return (F.concat(compact_date(start_date), F.lit("T00:00-0000")),
            F.concat(compact_date(end_date), F.lit("T23:55-0000")))


def version_id(prefix: str, ts) -> Column:
    """H-12: model version id '<prefix>_YYYYMMDD_HHMMSS' from a (job-supplied) NTZ timestamp."""
    return F.concat(F.lit(prefix + "_"), F.date_format(_c(ts), "yyyyMMdd_HHmmss"))
