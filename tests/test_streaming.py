import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from helpers import SF001, lmp_rows
from market_engine.operators.hourly import hourly_prices
from market_engine.operators.stress import hub_thresholds
from market_engine.plans import market
from market_engine.schemas import LMP_5MIN
from market_engine.sinks.tables import with_load_date
from market_engine.sources import adapters
from market_engine.streaming import prices as SP


def test_stream_equals_batch_on_closed_hours(spark, tmp_path_run):
    ev = adapters.table(spark, SF001, "events")
    src = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    out = SP.run_to_memory(SP.streaming_hourly_prices(adapters.lmp_from_events(src)), "s1_closed",
                           os.path.join(tmp_path_run, "ck"))
    batch = hourly_prices(adapters.lmp_5min(spark, SF001))
    mx = ev.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("hour_utc") <= F.lit(mx - timedelta(hours=3)))
    got = out.select(*batch.columns)
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).count() == 0


def _land(spark, path, rows):
    lmp_rows(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_dropped_after_watermark(spark, tmp_path_run):
    land, ck = os.path.join(tmp_path_run, "land"), os.path.join(tmp_path_run, "ck")
    _land(spark, land, [(60 * h + 5 * i, "NP15", 10.0 + h) for h in range(6) for i in range(12)])
    src = lambda: spark.readStream.schema(LMP_5MIN).parquet(land)
    sink = os.path.join(tmp_path_run, "sink")
    first = SP.run_to_parquet(SP.streaming_hourly_prices(src()), sink, ck)
    hours_a = {r.hour_utc.hour: r.interval_count for r in first.collect()}
    assert hours_a == {h: 12 for h in range(3)}            # watermark 5:55 - 2h: hours 0..2 closed
    _land(spark, land, [(0, "NP15", 999.0), (60 * 8, "NP15", 1.0)])   # hour 0 is late, hour 8 advances time
    both = SP.run_to_parquet(SP.streaming_hourly_prices(src()), sink, ck)
    rows = both.collect()
    hours_b = {r.hour_utc.hour: r.interval_count for r in rows}
    assert len(rows) == 6 and all(r.lmp_max < 999 for r in rows)     # the late row never counted
    assert hours_b == {h: 12 for h in range(6)}


def test_dedupe_within_watermark(spark, tmp_path_run):
    land = os.path.join(tmp_path_run, "land")
    rows = [(5 * i, "NP15", 10.0) for i in range(24)]
    _land(spark, land, rows)
    _land(spark, land, rows[:10])                          # re-delivery
    d = SP.dedupe_intervals(spark.readStream.schema(LMP_5MIN).parquet(land))
    out = SP.run_to_memory(d, "dedupe", os.path.join(tmp_path_run, "ck"))
    assert out.count() == 24


def test_score_stream_matches_mart(spark, tmp_path_run):
    lay = market.from_testdata(spark, SF001)
    th = hub_thresholds(lay.features)
    ev = adapters.table(spark, SF001, "events")
    src = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    hourly = SP.streaming_hourly_prices(adapters.lmp_from_events(src)).filter("market = 'RTM'")
    out = SP.run_to_memory(SP.score_stream(hourly, th), "scored", os.path.join(tmp_path_run, "ck"))
    mart = lay.stress.select("hour_utc", "trading_hub", "price_spike_flag", "stress_severity")
    got = out.select("hour_utc", "trading_hub", "price_spike_flag", "stress_severity")
    assert got.count() > 0 and got.exceptAll(mart).count() == 0


def test_stream_ingest_is_idempotent(spark, tmp_path_run):
    land, target = os.path.join(tmp_path_run, "land"), os.path.join(tmp_path_run, "raw")
    ck = os.path.join(tmp_path_run, "ck")
    _land(spark, land, [(5 * i, h, 10.0) for h in ("NP15", "SP15") for i in range(6)])
    _land(spark, land, [(24 * 60 + 5 * i, "NP15", 20.0) for i in range(6)])
    tf = lambda df: with_load_date(df, "interval_start")
    SP.stream_ingest(spark, land, LMP_5MIN, target, ["load_date", "trading_hub"], ck, transform=tf).awaitTermination()
    assert spark.read.parquet(target).count() == 18
    SP.stream_ingest(spark, land, LMP_5MIN, target, ["load_date", "trading_hub"], ck, transform=tf).awaitTermination()
    assert spark.read.parquet(target).count() == 18        # nothing new: nothing rewritten
    _land(spark, land, [(5 * i, "NP15", 11.0) for i in range(6)])    # day 1 NP15 re-delivered
    SP.stream_ingest(spark, land, LMP_5MIN, target, ["load_date", "trading_hub"], ck, transform=tf).awaitTermination()
    t = spark.read.parquet(target)
    assert t.count() == 18
    assert t.filter("trading_hub = 'NP15' and load_date = '2024-01-15'").agg(F.max("lmp")).first()[0] == 11.0


def test_stream_ingest_merges_parts_of_a_partition(spark, tmp_path_run):
    land, target = os.path.join(tmp_path_run, "land"), os.path.join(tmp_path_run, "raw")
    ck = os.path.join(tmp_path_run, "ck")
    tf = lambda df: with_load_date(df, "interval_start")
    for hour in (0, 1, 1):                               # one day and hub in two parts, the second twice
        _land(spark, land, [(60 * hour + 5 * i, "NP15", 10.0 + hour) for i in range(12)])
        SP.stream_ingest(spark, land, LMP_5MIN, target, ["load_date", "trading_hub"], ck, transform=tf).awaitTermination()
    t = spark.read.parquet(target)
    assert t.count() == 24 and t.select("interval_start").distinct().count() == 24
    assert t.agg(F.sum("lmp")).first()[0] == 12 * 10.0 + 12 * 11.0


def test_stream_hours_do_not_depend_on_session_zone(spark, tmp_path_run):
    land = os.path.join(tmp_path_run, "land")
    _land(spark, land, [(60 * h + 5 * i, "NP15", 10.0 + h) for h in range(6) for i in range(12)])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")          # +05:30
    try:
        out = SP.run_to_memory(SP.streaming_hourly_prices(spark.readStream.schema(LMP_5MIN).parquet(land)),
                               "tz_probe", os.path.join(tmp_path_run, "ck"))
        got = sorted((r.hour_utc, r.interval_count) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(datetime(2024, 1, 15, h), 12) for h in range(3)]


def _hours(spark, folder):
    cols = ["hour_utc", "trading_hub", "market", "lmp_avg", "lmp_min", "lmp_max", "interval_count"]
    return sorted(tuple(r) for r in spark.read.parquet(folder).select(*cols).collect())


def test_rollup_and_dedupe_resume_after_a_stop_between_batches(spark, tmp_path_run):
    """Hours that are open when the run stops keep their state; the rest of their rows come later, in other files, with another
    number of shuffle partitions, and the result equals D-1 over all rows on closed hours."""
    land, sink, ck = (os.path.join(tmp_path_run, x) for x in ("land", "sink", "ck"))
    rows = [(60 * h + 5 * i, hub, 10.0 + h + i / 8, m) for h in range(10) for i in range(12) for hub in ("NP15", "sp15 ") for m in ("RTM", "DAM")]
    early = [r for r in rows if r[0] < 5 * 60 + 30]
    src = lambda: spark.readStream.schema(LMP_5MIN).option("maxFilesPerTrigger", 1).parquet(land)
    _land(spark, land, early[::2])
    first = SP.drive(SP.streaming_hourly_prices(src()), sink, ck)
    assert first.rows == len(early[::2]) and first.late_rows == 0
    open_before = len(_hours(spark, sink))
    ahead = [r for r in early[1::2] if r[0] >= 3 * 60 + 30]  # older ones are past the watermark by now
    lmp_rows(spark, ahead).repartition(5).write.mode("append").parquet(land)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        stopped = SP.drive(SP.streaming_hourly_prices(src()), sink, ck, stop_after=1)
        resumed = SP.drive(SP.streaming_hourly_prices(src()), sink, ck)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert stopped.rows + resumed.rows >= len(ahead) and resumed.batches > 0
    later = [r for r in rows if r[0] >= 5 * 60 + 30]
    _land(spark, land, later)
    SP.drive(SP.streaming_hourly_prices(src()), sink, ck)
    _land(spark, land, [(5, "NP15", 999.0), (60 * 3, "SP15", 999.0), (60 * 14, "NP15", 1.0)])
    late = SP.drive(SP.streaming_hourly_prices(src()), sink, ck)
    assert late.late_rows == 2
    got = _hours(spark, sink)
    assert len(got) > open_before and all(r[5] < 999 for r in got) and len({r[:3] for r in got}) == len(got)
    counted = early[::2] + ahead + later
    want = [tuple(r) for r in hourly_prices(lmp_rows(spark, counted)).select(
        "hour_utc", "trading_hub", "market", "lmp_avg", "lmp_min", "lmp_max", "interval_count").collect()]
    assert got == sorted(want)


def test_dedupe_resumes_after_a_stop_between_batches(spark, tmp_path_run):
    land, sink, ck = (os.path.join(tmp_path_run, x) for x in ("land", "sink", "ck"))
    rows = [(5 * i, "NP15", 10.0) for i in range(36)]
    for part in (rows[:12], rows[6:20], rows[10:30], rows[12:]):     # every part delivers rows again
        _land(spark, land, part)
    dedupe = lambda: SP.dedupe_intervals(spark.readStream.schema(LMP_5MIN).option("maxFilesPerTrigger", 1).parquet(land))
    SP.drive(dedupe(), sink, ck, stop_after=1)
    SP.drive(dedupe(), sink, ck, stop_after=1)
    SP.drive(dedupe(), sink, ck)
    out = spark.read.parquet(sink)
    assert out.count() == out.select("interval_start").distinct().count() == 36


def test_stream_queries_read_a_table_of_part_files(spark, tmp_path_run):
    import __spark_entry__ as entry
    parts, one = os.path.join(tmp_path_run, "parts"), SF001
    adapters.table(spark, one, "events").repartition(3).write.parquet(os.path.join(parts, "events.parquet"))
    for name in ("s01_streaming_hourly_prices", "s02_streaming_dedupe", "s03_streaming_scores"):
        got, want = (entry.queries()[name](spark, sf) for sf in (parts, one))
        assert want.count() == got.count() > 0
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0, name


def test_stream_queries_need_no_fallback_folder_where_one_is_named(spark, monkeypatch):
    import __spark_entry__ as entry

    def refuse(_):
        raise ValueError("set spark.checkpoint.dir")
    monkeypatch.setattr(entry, "shared_fallback", refuse)
    assert "/streams/" in entry._stream_ck(spark)
