from market_engine.functions.columns import (  # noqa: F401
    clean_key, hour_bucket, exact_avg, round_half_away, try_double, parse_hour_period,
    parse_iso_utc, instant_to_utc_ntz, utc_ntz_to_instant, calendar_columns, day_window, on_date, format_seconds,
    ratio, stable, compact_date, request_window, version_id,
)
