import os

import pytest
from pyspark.sql import functions as F

from helpers import lmp_rows
from market_engine.sinks import ledger as L
from market_engine.sinks import tables as S


def _day(spark, day_offset_min, hubs, price):
    rows = [(day_offset_min + 5 * i, h, price) for h in hubs for i in range(3)]
    return S.with_load_date(lmp_rows(spark, rows), "interval_start")


def test_day_rerun_is_idempotent_and_hub_scoped(spark, tmp_path_run):
    target = os.path.join(tmp_path_run, "raw_lmp")
    keys = ["load_date", "trading_hub"]
    assert S.replace_partitions(_day(spark, 0, ["NP15", "SP15"], 10.0), target, keys) == 6
    S.replace_partitions(_day(spark, 24 * 60, ["NP15", "SP15"], 20.0), target, keys)      # another day
    S.replace_partitions(_day(spark, 0, ["NP15", "SP15"], 10.0), target, keys)            # same day again
    t = spark.read.parquet(target)
    assert t.count() == 12                                                               # no duplicates
    # rerun of day 0 where SP15 failed: only NP15's partition of that day is replaced (T15)
    S.replace_partitions(_day(spark, 0, ["NP15"], 11.0), target, keys)
    got = {(str(r.load_date), r.trading_hub): (r.n, r.p) for r in spark.read.parquet(target).groupBy(
        "load_date", "trading_hub").agg(F.count(F.lit(1)).alias("n"), F.max("lmp").alias("p")).collect()}
    assert got == {("2024-01-15", "NP15"): (3, 11.0), ("2024-01-15", "SP15"): (3, 10.0),
                   ("2024-01-16", "NP15"): (3, 20.0), ("2024-01-16", "SP15"): (3, 20.0)}
    with pytest.raises(ValueError):
        S.replace_partitions(_day(spark, 0, ["NP15"], 1.0).limit(0), target, keys)      # empty batch refused


def test_replace_all_and_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS raw_lmp_t")
    keys = ["load_date", "trading_hub"]
    S.replace_partitions(_day(spark, 0, ["NP15", "SP15"], 10.0), "raw_lmp_t", keys)
    S.replace_partitions(_day(spark, 24 * 60, ["NP15"], 20.0), "raw_lmp_t", keys)
    S.replace_partitions(_day(spark, 0, ["NP15"], 12.0), "raw_lmp_t", keys)
    assert spark.table("raw_lmp_t").count() == 9
    S.replace_partitions(_day(spark, 0, ["ZP26"], 5.0), "raw_lmp_t", keys, mode="all")
    assert spark.table("raw_lmp_t").count() == 3


def test_append_and_materialise_and_audit(spark):
    df = _day(spark, 0, ["NP15"], 10.0)
    name = S.materialise(df, "mart", "audit_probe", comment="probe table")
    assert name == "mart.audit_probe"
    assert S.append_to(df, name) == 3
    assert S.append_to(df.limit(0), name) == 0
    assert spark.table(name).count() == 6
    assert S.materialise(df, "staging", "probe") == "staging_probe"
    with pytest.raises(ValueError):
        S.append_to(df, "mart.does_not_exist")
    a = {r.table_name: r for r in S.table_audit(spark, {name: "interval_start", "mart.nope": None}).collect()}
    assert a[name].table_exists and a[name].row_count == 6 and a[name].first_time.hour == 0
    assert not a["mart.nope"].table_exists and a["mart.nope"].row_count == 0


def test_ops_day_ba_and_model_version_replace(spark, tmp_path_run):
    from helpers import ops_rows
    target = os.path.join(tmp_path_run, "ops")
    keys = ["load_date", "balancing_authority"]
    day = lambda rows: S.with_load_date(ops_rows(spark, rows), "period")
    S.replace_partitions(day([(h, "CISO", 1.0, 1.0, 1.0, 1.0) for h in range(24)] +
                             [(h, "MISO", 2.0, 2.0, 2.0, 2.0) for h in range(24)]), target, keys)
    S.replace_partitions(day([(h, "CISO", 3.0, 3.0, 3.0, 3.0) for h in range(24)]), target, keys)   # CISO rerun
    got = {r.balancing_authority: (r.n, r.d) for r in spark.read.parquet(target).groupBy("balancing_authority")
           .agg(F.count(F.lit(1)).alias("n"), F.max("demand_mwh").alias("d")).collect()}
    assert got == {"CISO": (24, 3.0), "MISO": (24, 2.0)}
    ml_t = os.path.join(tmp_path_run, "metrics")
    m = lambda v, a: spark.createDataFrame([(v, a)], "model_version string, accuracy double")
    S.replace_partitions(m("v1", 0.5), ml_t, ["model_version"])
    S.replace_partitions(m("v2", 0.6), ml_t, ["model_version"])
    S.replace_partitions(m("v1", 0.7), ml_t, ["model_version"])
    got = {r.model_version: r.accuracy for r in spark.read.parquet(ml_t).collect()}
    assert got == {"v1": 0.7, "v2": 0.6}


def test_ledger_recognises_replays_and_half_finished_batches(spark, tmp_path_run):
    target, keys, row = os.path.join(tmp_path_run, "raw_lmp"), ["load_date", "trading_hub"], ["interval_start", "trading_hub"]
    day = _day(spark, 0, ["NP15", "SP15"], 10.0)
    assert L.load(day, target, "e1", "merge", keys, row) == 6
    other = _day(spark, 0, ["NP15", "SP15"], 99.0).withColumn("loaded_at", F.lit("2030-01-01").cast("timestamp_ntz"))
    assert L.load(other, target, "e1", "merge", keys, row) == 6                 # the name is known: nothing is written
    assert {r.lmp for r in spark.read.parquet(target).collect()} == {10.0}
    # the job of e2 dies after one of its partitions was replaced
    L._note(spark, target, "e2", "begun", "merge", L._touched(other, keys), 0, 0)
    S.merge_partitions(other.filter("trading_hub = 'NP15'"), target, keys, row)
    assert L.load(other, target, "e2", "merge", keys, row) == 6
    assert {r.lmp for r in spark.read.parquet(target).collect()} == {99.0}
    got = {(r.batch, r.state): (r.rows, r.partitions) for r in L.read_ledger(spark, target).collect()}
    parts = ["load_date=2024-01-15/trading_hub=NP15", "load_date=2024-01-15/trading_hub=SP15"]
    assert got == {("e1", "begun"): (0, parts), ("e1", "done"): (6, parts), ("e2", "begun"): (0, parts), ("e2", "done"): (6, parts)}
    with pytest.raises(ValueError):
        L.load(day, target, "e3", "upsert")


def test_ledger_appends_once(spark):
    spark.sql("DROP TABLE IF EXISTS appended_once")
    day = _day(spark, 0, ["NP15"], 1.0)
    day.limit(0).write.format("parquet").saveAsTable("appended_once")
    assert L.load(day, "appended_once", "b1", "append") == 3 == L.load(day, "appended_once", "b1", "append")
    L._note(spark, "appended_once", "b2", "begun", "append", None, 0, 3)        # died before the write
    assert L.load(day, "appended_once", "b2", "append") == 3 and spark.table("appended_once").count() == 6
    L._note(spark, "appended_once", "b3", "begun", "append", None, 0, 6)        # died after the write, before the mark
    S.append_to(day, "appended_once")
    assert L.load(day, "appended_once", "b3", "append") == 3 and spark.table("appended_once").count() == 9
