import os

from pyspark.sql import functions as F

from helpers import SF001
from market_engine.plans import jobs
from market_engine.sources import adapters
from test_sources import _page, _zip


def _land(spark, root):
    raw = adapters.lmp_5min(spark, SF001).withColumn("trading_hub", F.upper(F.trim("trading_hub")))
    pdf = raw.filter("upper(trim(market)) = 'RTM'").toPandas()
    fmt = lambda ts: ts.strftime("%Y-%m-%dT%H:%M:%S.%f") + "-00:00"
    items = {"LMP": "lmp", "MCE": "energy_component", "MCC": "congestion_component", "MCL": "loss_component"}
    for (hub, day), g in pdf.groupby([pdf.trading_hub, pdf.interval_start.dt.date]):
        d = os.path.join(root, "prices", f"trading_hub={hub}")
        os.makedirs(d, exist_ok=True)
        lines = ["INTERVALSTARTTIME_GMT,INTERVALENDTIME_GMT,LMP_TYPE,MW"]
        lines += [f"{fmt(r.interval_start)},{fmt(r.interval_end)},{c},{getattr(r, col)!r}"
                  for r in g.itertuples() for c, col in items.items()]
        _zip(os.path.join(d, f"{day}.zip"), {"prices.csv": "\n".join(lines) + "\n"})
    long = adapters.ops_long(spark, SF001).orderBy("seq").toPandas()
    recs = [{"period": r.period, "respondent": r.respondent, "type": r.type, "value": r.value}
            for r in long.itertuples()]
    os.makedirs(os.path.join(root, "pages", "req"))
    for i in range(0, len(recs), 500):
        _page(os.path.join(root, "pages", "req", f"p{i:05d}.json"), len(recs), recs[i:i + 500])
    return len(pdf)


def test_daily_lifecycle(spark, tmp_path_run):
    n_land = _land(spark, tmp_path_run)
    rp, ro = os.path.join(tmp_path_run, "raw_lmp"), os.path.join(tmp_path_run, "raw_ops")
    for _ in range(2):                                         # a rerun changes nothing
        r1 = jobs.ingest_prices(spark, os.path.join(tmp_path_run, "prices"), rp, loaded_at="2024-02-01 00:00:00")
        r2 = jobs.ingest_ops(spark, os.path.join(tmp_path_run, "pages"), ro, source_system="events_feed",
                             loaded_at="2024-02-01 00:00:00")
    assert r1.rows == n_land and spark.read.parquet(rp).count() == n_land
    assert r1.rejected.count() == 0 and r2.totals.first().complete
    lay, report = jobs.build_marts(spark, rp, ro)
    assert report.count() == 26 and {r.status for r in report.collect()} <= {"pass", "warn"}
    assert spark.table("mart.mart_hourly_market_stress").count() == lay.stress.count() > 0
    ref = adapters.ops_hourly(spark, SF001)
    assert spark.read.parquet(ro).select(*ref.columns).exceptAll(ref).count() == 0   # partition cols move last
    preds, mets = os.path.join(tmp_path_run, "preds"), os.path.join(tmp_path_run, "metrics")
    model, n = jobs.train_and_publish(lay.stress, "v_test", preds, mets, trained_at="2024-02-01 00:00:00")
    assert spark.read.parquet(preds).count() == n > 0
    assert spark.read.parquet(mets).first().model_version == "v_test"
