"""Table reads and load-time coercion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.functions import parse_hour_period, parse_iso_utc


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A-7: a catalog table by name, or a Parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def truncate_seconds(ts) -> F.Column:
    """Drop sub-second precision of an NTZ timestamp (formatting NTZ never uses the session zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_timestamp_ntz(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))


def coerce_timestamps(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    """A-15: parse text timestamps to NTZ UTC at whole seconds; unparsable -> NULL.

    Adds ``<col>__bad`` flags (value present but unparsable) so DQ-8 can count them in the
    same pass that loads the data.
    """
    out = {}
    for c in cols:
        raw = F.col(c).cast("string")
        parsed = parse_hour_period(raw, fmt) if fmt else parse_iso_utc(raw)
        out[c] = truncate_seconds(parsed)
        out[f"{c}__bad"] = raw.isNotNull() & parsed.isNull()
    return df.withColumns(out)


def bad_value_counts(coerced: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ-8: rows per column whose timestamp could not be parsed (the reference warns and loads NULL)."""
    return coerced.agg(F.count(F.lit(1)).alias("rows"),
                       *[F.count_if(F.col(f"{c}__bad")).alias(f"bad_{c}") for c in cols])
