"""Rows and paths that several tests share."""

from datetime import datetime, timedelta

from market_engine.schemas import LMP_5MIN, OPS_HOURLY

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

T0 = datetime(2024, 1, 15, 0, 0)


def lmp_rows(spark, rows):
    """rows: (minutes_from_T0, hub, lmp[, market]) -> raw.lmp_5min frame; components split the price."""
    out = []
    for r in rows:
        m, hub, lmp = r[0], r[1], r[2]
        market = r[3] if len(r) > 3 else "RTM"
        st = T0 + timedelta(minutes=m)
        e = None if lmp is None else round(lmp - 1.0, 2)
        out.append((st, st + timedelta(minutes=5), hub, lmp, e, None if lmp is None else 0.75,
                    None if lmp is None else 0.25, market, "test", datetime(2024, 2, 1)))
    return spark.createDataFrame(out, LMP_5MIN)


def ops_rows(spark, rows):
    """rows: (hours_from_T0, ba, demand, forecast, netgen, interchange)."""
    out = [(T0 + timedelta(hours=h), ba, d, f, g, i, "test", datetime(2024, 2, 1)) for h, ba, d, f, g, i in rows]
    return spark.createDataFrame(out, OPS_HOURLY)
