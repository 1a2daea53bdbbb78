import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROWS_ONLY = {"d02_hub_thresholds_approx", "m10_predictions", "m11_model_metrics", "m13_feature_importance",
             "m17_random_forest_metrics", "r14_probability_by_hour"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["hour_utc", "trading_hub"]
    assert "stress_severity" in df.columns and "price_spike_flag" in df.columns


OPTIONAL = set(getattr(E, "_LLM", ()))  # the training-data queries have tests of their own


def test_every_query_has_an_oracle_unless_rows_only():
    qs, oracle = (set(x) - OPTIONAL for x in (E.queries(), E.oracle_sql()))
    assert set(qs) - set(oracle) == ROWS_ONLY
    assert set(oracle) <= set(qs)
    assert len(qs) >= 70


def test_oracle_sql_runs_in_duckdb():
    import duckdb
    con = duckdb.connect()
    for t in ["events", "orders", "lineitem"]:
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for sql in (v for k, v in E.oracle_sql().items() if k not in OPTIONAL):
        con.execute(sql).fetchall()


def test_workers_get_the_package(tmp_path_run):
    """From another folder and without PYTHONPATH, tasks that run Python find the package."""
    code = f"""
import importlib.util, json
spec = importlib.util.spec_from_file_location("__spark_entry__", {E.__file__!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
entry.queries()["d01_hourly_prices"](spark, "/root/testdata/sf0.001")
def where(batches):
    import market_engine.session as s, pyarrow as pa
    for b in batches:
        yield pa.record_batch([pa.array([s.__file__] * b.num_rows)], names=["f"])
print("FOUND " + json.dumps([r.f for r in spark.range(2).mapInArrow(where, "f string").collect()]))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path_run, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND" in out.stdout, out.stderr[-2000:]
    assert all("market_engine" in f for f in json.loads(out.stdout.split("FOUND ")[1]))
