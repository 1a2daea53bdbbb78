import io
import json
import os
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from market_engine.sources import pages as P
from market_engine.sources import prices as PR

HEADER = " intervalstarttime_gmt ,INTERVALENDTIME_GMT,NODE,LMP_TYPE,MW,MW\n"


def _csv(rows, header=HEADER):
    return header + "".join(",".join(str(x) for x in r) + "\n" for r in rows)


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def _iv(i):
    s = f"2024-01-15T08:{i * 5:02d}:00-00:00"
    e = f"2024-01-15T08:{i * 5 + 5:02d}:00-00:00" if i < 11 else "2024-01-15T09:00:00-00:00"
    return s, e


@pytest.fixture
def landing(tmp_path_run):
    root = os.path.join(tmp_path_run, "prices")
    np15 = os.path.join(root, "trading_hub=NP15")
    sp15 = os.path.join(root, "trading_hub=SP15")
    os.makedirs(np15)
    os.makedirs(sp15)
    rows = []
    for i in range(3):
        s, e = _iv(i)
        rows += [(s, e, "TH_NP15_GEN-APND", "LMP", 30 + i, 0), (s, e, "TH_NP15_GEN-APND", "MCE", 29 + i, 0),
                 (s, e, "TH_NP15_GEN-APND", "MCC", 0.5, 0)]          # no MCL rows: loss NULL (B-2)
    s, e = _iv(3)
    rows += [(s, e, "TH_NP15_GEN-APND", "LMP", "", 0), (s, e, "TH_NP15_GEN-APND", "LMP", 44, 0)]  # dup, first NULL
    s, e = _iv(4)
    rows += [(s, e, "TH_NP15_GEN-APND", "LMP", "", 0)]                 # only NULL: interval absent
    s, e = _iv(5)
    rows += [(s, e, "TH_NP15_GEN-APND", "XYZ", 1, 0), (s, e, "TH_NP15_GEN-APND", "LMP", 50, 0)]  # unknown item
    _zip(os.path.join(np15, "ok.zip"), {"readme.xml": "<x/>", "prices.csv": _csv(rows)})
    with open(os.path.join(np15, "bad.zip"), "wb") as f:
        f.write(b"this is not an archive")
    _zip(os.path.join(sp15, "nocsv.zip"), {"only.xml": "<x/>"})
    return root


def test_archives_decode_pivot_and_quarantine(spark, landing):
    prices, bad = PR.read_price_archives(spark, landing, loaded_at="2024-02-01 00:00:00")
    q = {r.status for r in bad.collect()}
    assert q == {"bad_zip", "no_csv"}
    rows = {r.interval_start.minute: r for r in prices.collect()}
    assert sorted(rows) == [0, 5, 10, 15, 25]       # minute 20 (only NULL values) is absent
    r0 = rows[0]
    assert r0.trading_hub == "NP15" and r0.lmp == 30.0 and r0.energy_component == 29.0
    assert r0.congestion_component == 0.5 and r0.loss_component is None
    assert r0.interval_start.hour == 8 and r0.market == "RTM"
    assert rows[15].lmp == 44.0                      # first non-NULL of a duplicated item
    assert rows[25].lmp == 50.0                      # unknown item dropped, known kept
    assert prices.schema["interval_start"].dataType.typeName() == "timestamp_ntz"


def test_header_resolution_rules():
    import pandas as pd
    pdf = PR.normalise_header(pd.DataFrame([[1, 2, 3]], columns=[" mw ", "MW", "value"]))
    assert list(pdf.columns) == ["MW", "VALUE"]
    res = PR.resolve_columns(["DATA_ITEM", "VALUE", "STARTTIME", "END_TIME"], PR.PRICE_CSV_CANDIDATES)
    assert res == {"item": "DATA_ITEM", "value": "VALUE", "start": "STARTTIME", "end": "END_TIME"}
    out = PR.decode_price_csv("x.csv", b"A,B\n1,2\n")
    assert out.status.tolist() == ["missing_columns"]


def test_plain_csv_reader(spark, tmp_path_run):
    d = os.path.join(tmp_path_run, "csv")
    os.makedirs(d)
    s, e = _iv(0)
    with open(os.path.join(d, "p.csv"), "w") as f:
        f.write(f"STARTTIME,ENDTIME,NODE,DATA_ITEM,VALUE\n{s},{e},TH_SP15_GEN-APND,LMP,20\n"
                f"{s},{e},TH_SP15_GEN-APND,MCL,0.1\n")
    df, bad = PR.read_price_csv(spark, d, loaded_at="2024-02-01 00:00:00")
    r = df.collect()
    assert bad.count() == 0
    assert len(r) == 1 and r[0].trading_hub == "SP15" and r[0].lmp == 20.0 and r[0].loss_component == 0.1
    with open(os.path.join(tmp_path_run, "bad.csv"), "w") as f:
        f.write("A,B\n1,2\n")
    df, bad = PR.read_price_csv(spark, os.path.join(tmp_path_run, "bad.csv"))
    assert df.count() == 0 and [r.status for r in bad.collect()] == ["missing_columns"]


def test_plain_csv_files_have_headers_of_their_own(spark, tmp_path_run):
    d = os.path.join(tmp_path_run, "csv")
    os.makedirs(os.path.join(d, "trading_hub=NP15"))
    (s0, e0), (s1, e1), (s2, e2) = _iv(0), _iv(1), _iv(2)
    at = lambda n: os.path.join(d, "trading_hub=NP15", n)
    with open(at("a.csv"), "w") as f:
        f.write(f"STARTTIME,ENDTIME,DATA_ITEM,VALUE\n{s0},{e0},LMP,20\n")
    with open(at("b.csv"), "w") as f:
        f.write(f" value ,data_item,endtime,starttime\n21,LMP,{e1},{s1}\n22,LMP,{e2},{s2}\n")
    with open(at("c.csv"), "w") as f:                    # a name that repeats: the first column counts
        f.write(f"MW,LMP_TYPE,STARTTIME,ENDTIME,MW\n0.5,MCC,{s0},{e0},99\n")
    with open(at("d.csv"), "w") as f:
        f.write("A,B\n1,2\n")
    df, bad = PR.read_price_csv(spark, d, loaded_at="2024-02-01 00:00:00")
    got = {r.interval_start.minute: r for r in df.collect()}
    assert {m: r.lmp for m, r in got.items()} == {0: 20.0, 5: 21.0, 10: 22.0}
    assert got[0].congestion_component == 0.5 and {r.trading_hub for r in got.values()} == {"NP15"}
    assert [(r.source_file[-5:], r.status) for r in bad.collect()] == [("d.csv", "missing_columns")]


def test_plain_csv_lines_that_cannot_be_read_are_quarantined(spark, tmp_path_run):
    """A path with a space and a plus, headers in three orders, quotes, a BOM, ragged lines and broken times."""
    d = os.path.join(tmp_path_run, "day 1+2", "trading_hub=SP15")
    os.makedirs(d)
    iv = [_iv(i) for i in range(6)]
    files = {"a.csv": f"STARTTIME,ENDTIME,DATA_ITEM,VALUE\n{iv[0][0]},{iv[0][1]},LMP,1.5\n{iv[1][0]},{iv[1][1]},LMP\n\n{iv[2][0]},{iv[2][1]},LMP,3,4\n",
             "b.csv": f'\ufeffNOTE,VALUE,DATA_ITEM,ENDTIME,STARTTIME\n"a, b",2.5,LMP,{iv[3][1]},{iv[3][0]}\n"say ""x""",7,MCC,{iv[3][1]},{iv[3][0]}\n,9,LMP,soon,now\n',
             "c.csv": f'"LMP_TYPE",MW,INTERVAL_START_GMT,"INTERVAL_END_GMT"\nlmp ,"4.5",{iv[4][0]},{iv[4][1]}\nLMP,n/a,{iv[5][0]},{iv[5][1]}\n'}
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    df, bad = PR.read_price_csv(spark, os.path.dirname(d), loaded_at="2024-02-01 00:00:00")
    assert {r.interval_start.minute: (r.trading_hub, r.lmp, r.congestion_component) for r in df.collect()} == {
        0: ("SP15", 1.5, None), 15: ("SP15", 2.5, 7.0), 20: ("SP15", 4.5, None)}
    got = sorted((r.source_file[-5:], r.status) for r in bad.collect())
    assert got == [("a.csv", "ragged_row"), ("a.csv", "ragged_row"), ("b.csv", "bad_time")]
    assert all("/day 1+2/" in r.source_file for r in bad.collect())


def test_plain_csv_headers_hold_for_all_blocks_of_a_file(spark, tmp_path_run):
    """A file read in many blocks takes its header from the first one; headers come from a pruned read."""
    d = os.path.join(tmp_path_run, "blocks")
    os.makedirs(os.path.join(d, "trading_hub=NP15"))
    hours = [datetime(2024, 1, 1) + timedelta(minutes=5 * i) for i in range(4000)]
    with open(os.path.join(d, "trading_hub=NP15", "long.csv"), "w") as f:
        f.write("VALUE,ENDTIME,DATA_ITEM,STARTTIME\n")
        f.writelines(f"{i},{t + timedelta(minutes=5):%Y-%m-%dT%H:%M:%S},LMP,{t:%Y-%m-%dT%H:%M:%S}\n" for i, t in enumerate(hours))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert PR.csv_lines(spark, d).select("start").distinct().count() > 5
        df, bad = PR.read_price_csv(spark, d)
        assert {r.interval_start: r.lmp for r in df.collect()} == {t: float(i) for i, t in enumerate(hours)} and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_every_damaged_archive_is_quarantined(spark, tmp_path_run):
    d = os.path.join(tmp_path_run, "zips")
    os.makedirs(d)
    s, e = _iv(0)
    at = lambda n: os.path.join(d, n)
    _zip(at("good.zip"), {"p.csv": _csv([(s, e, "TH_NP15_GEN-APND", "LMP", 30, 0)])})
    _zip(at("node.zip"), {"p.csv": _csv([(s, e, "NO_SUCH_NODE", "LMP", 30, 0)] * 10)})
    _zip(at("empty.zip"), {"p.csv": ""})
    _zip(at("head.zip"), {"p.csv": HEADER})
    _zip(at("ragged.zip"), {"p.csv": HEADER + "1,2\n" + ",".join("1" * 9) + "\n"})
    _zip(at("bytes.zip"), {"p.csv": HEADER.encode() + b"\xff\xfe,2,3,4,5,6\n"})
    with zipfile.ZipFile(at("member.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("p.csv", _csv([(s, e, "TH_NP15_GEN-APND", "LMP", i, 0) for i in range(200)]))
    raw = bytearray(open(at("member.zip"), "rb").read())
    raw[60:120] = bytes(60)
    open(at("member.zip"), "wb").write(raw)
    prices, bad = PR.read_price_archives(spark, d, loaded_at="2024-02-01 00:00:00")
    assert [(r.trading_hub, r.lmp) for r in prices.collect()] == [("NP15", 30.0)]
    got = {r.source_file.rsplit("/", 1)[1]: r.status for r in bad.collect()}
    assert got == {"node.zip": "unknown_hub", "empty.zip": "bad_csv", "head.zip": "empty", "ragged.zip": "bad_csv",
                   "bytes.zip": "bad_csv", "member.zip": "bad_member"}


def test_broken_pages_are_rejected_and_stop_the_replace(spark, tmp_path_run):
    from market_engine.plans import jobs
    root, raw = os.path.join(tmp_path_run, "ops"), os.path.join(tmp_path_run, "raw")
    for r in ("r1", "r2", "r3"):
        os.makedirs(os.path.join(root, r))
    recs = [{"period": "2024-01-15T00", "respondent": "CISO", "type": "D", "value": "100"}]
    _page(os.path.join(root, "r1", "p0.json"), 1, recs)
    _page(os.path.join(root, "r2", "p0.json"), 1, recs)
    with open(os.path.join(root, "r2", "p0.json")) as f:
        text = f.read()
    with open(os.path.join(root, "r2", "p0.json"), "w") as f:
        f.write(text[:-30])                              # cut off in a transfer
    with open(os.path.join(root, "r3", "p0.json"), "w") as f:
        f.write("{}")
    ops, bad, totals = P.ops_from_pages(spark, root, loaded_at="2024-02-01 00:00:00")
    assert {(r.request[-2:], r.error) for r in bad.collect()} == {
        ("r2", "unreadable page"), ("r3", "page without a response")}
    assert [(r.request[-2:], r.complete) for r in totals.collect()] == [("r1", True)] and ops.count() == 1
    with pytest.raises(ValueError, match="2 request"):
        jobs.ingest_ops(spark, root, raw)
    assert not os.path.exists(raw)
    assert jobs.ingest_ops(spark, root, raw, allow_incomplete=True).rows == 1


def _page(path, total, data=None, error=None):
    body = {"error": error} if error else {"response": {"total": str(total), "data": data}}
    with open(path, "w") as f:
        json.dump(body, f)


def test_ops_pages(spark, tmp_path_run):
    req = os.path.join(tmp_path_run, "ops", "req1")
    err = os.path.join(tmp_path_run, "ops", "req2")
    os.makedirs(req)
    os.makedirs(err)
    recs = [{"period": "2024-01-15T00", "respondent": "CISO", "type": "D", "value": "100"},
            {"period": "2024-01-15T00", "respondent": "CISO", "type": "NG", "value": 90},
            {"period": "2024-01-15T00", "respondent": "MISO", "type": "D", "value": "500"},   # second BA kept
            {"period": "2024-01-15T01", "respondent": "CISO", "type": "D", "value": "n/a"},   # bad value
            {"period": "2024-01-15T01", "respondent": "CISO", "type-name": "DF", "value": "120"}]
    _page(os.path.join(req, "p0.json"), 7, recs)
    _page(os.path.join(req, "p1.json"), 7, [
        {"period": "2024-01-15T01", "respondent": "CISO", "type": "ZZ", "value": "1"},
        {"period": "2024-01-15T01", "respondent": "CISO", "type": "D", "value": None}])
    _page(os.path.join(err, "e.json"), 0, error="invalid api key")
    ops, bad, totals = P.ops_from_pages(spark, os.path.join(tmp_path_run, "ops"), loaded_at="2024-02-01 00:00:00")
    got = {(r.period.hour, r.balancing_authority): r for r in ops.collect()}
    assert set(got) == {(0, "CISO"), (0, "MISO"), (1, "CISO")}
    assert got[(0, "CISO")].demand_mwh == 100.0 and got[(0, "CISO")].net_generation_mwh == 90.0
    assert got[(0, "CISO")].interchange_mwh is None                     # missing code -> NULL column
    assert got[(1, "CISO")].demand_mwh is None and got[(1, "CISO")].demand_forecast_mwh == 120.0
    assert [r.error for r in bad.collect()] == ["invalid api key"]
    t = totals.collect()
    assert len(t) == 1 and t[0].reported_total == 7 and t[0].received_rows == 7 and t[0].complete
    good, _ = P.reject_error_pages(P.read_pages(spark, os.path.join(tmp_path_run, "ops")), strict=True)
    with pytest.raises(Exception):
        good.count()


def test_archive_round_trip_at_volume(spark, tmp_path_run):
    """sf0.001 prices -> long CSV rows in one archive per hub and day -> A-1 -> equal rows."""
    from helpers import SF001
    from market_engine.operators.hourly import hourly_prices
    from market_engine.sources import adapters
    raw = adapters.lmp_5min(spark, SF001).withColumn("trading_hub", F.upper(F.trim("trading_hub")))
    pdf = raw.toPandas()
    items = {"LMP": "lmp", "MCE": "energy_component", "MCC": "congestion_component", "MCL": "loss_component"}
    root = os.path.join(tmp_path_run, "archives")
    fmt = lambda ts: ts.strftime("%Y-%m-%dT%H:%M:%S.%f") + "-00:00"
    for (hub, day), g in pdf.groupby([pdf.trading_hub, pdf.interval_start.dt.date]):
        d = os.path.join(root, f"trading_hub={hub}")
        os.makedirs(d, exist_ok=True)
        lines = ["INTERVALSTARTTIME_GMT,INTERVALENDTIME_GMT,NODE,LMP_TYPE,MW"]
        for r in g.itertuples():
            for code, col in items.items():
                v = getattr(r, col)
                lines.append(f"{fmt(r.interval_start)},{fmt(r.interval_end)},node,{code},{'' if v != v else repr(v)}")
        _zip(os.path.join(d, f"{day}.zip"), {f"{hub}_{day}.csv": "\n".join(lines) + "\n"})
    prices, bad = PR.read_price_archives(spark, root, market="RTM", source_system="events_feed",
                                         loaded_at="2024-02-01 00:00:00")
    assert bad.count() == 0
    cols = ["interval_start", "interval_end", "trading_hub", "lmp", "energy_component", "congestion_component",
            "loss_component"]
    assert prices.count() == raw.count()
    assert prices.select(cols).exceptAll(raw.select(cols)).count() == 0
    # the hourly roll-up over the ingested rows equals the one over the adapter: exact averages
    # bitwise (order-independent), the float stddev up to its last bits
    def roll(df):
        h = hourly_prices(df.withColumn("market", F.lit("RTM"))).drop("market", "loaded_at", "source_system")
        return h.withColumn("lmp_stddev", F.round("lmp_stddev", 9))
    assert roll(prices).exceptAll(roll(raw)).count() == 0


def test_pages_round_trip_at_volume(spark, tmp_path_run):
    """sf0.001 operations rows as paged JSON (5000 per page, reported totals) -> A-3..A-5 -> D-4."""
    from helpers import SF001
    from market_engine.sources import adapters
    long = adapters.ops_long(spark, SF001).orderBy("seq").toPandas()
    req = os.path.join(tmp_path_run, "pages", "req")
    os.makedirs(req)
    recs = [{"period": r.period, "respondent": r.respondent, "type": r.type, "value": r.value}
            for r in long.itertuples()]
    for i in range(0, len(recs), 300):
        _page(os.path.join(req, f"p{i // 300:04d}.json"), len(recs), recs[i:i + 300])
    ops, bad, totals = P.ops_from_pages(spark, os.path.join(tmp_path_run, "pages"), source_system="events_feed",
                                        loaded_at="2024-02-01 00:00:00")
    t = totals.first()
    assert bad.count() == 0 and t.complete and t.received_rows == len(recs)
    ref = adapters.ops_hourly(spark, SF001)
    assert ops.count() == ref.count()
    assert ops.exceptAll(ref).count() == 0


def test_mixed_header_csv_landing(spark, tmp_path_run):
    """A-2: files with different header variants are resolved per file (binaryFile path)."""
    d = os.path.join(tmp_path_run, "mixed", "trading_hub=SP15")
    os.makedirs(d)
    s, e = _iv(0)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write(f"STARTTIME,ENDTIME,DATA_ITEM,VALUE\n{s},{e},LMP,20\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write(f" mw ,lmp_type,interval_end_gmt,interval_start_gmt\n0.5,MCC,{e},{s}\n")
    prices, bad = PR.read_price_archives(spark, os.path.join(tmp_path_run, "mixed"), kind="csv",
                                         loaded_at="2024-02-01 00:00:00")
    r = prices.collect()
    assert bad.count() == 0 and len(r) == 1
    assert r[0].lmp == 20.0 and r[0].congestion_component == 0.5 and r[0].trading_hub == "SP15"


def test_large_files_are_decoded_some_lines_at_a_time(monkeypatch):
    monkeypatch.setattr(PR, "CSV_LINES", 40)
    monkeypatch.setattr(PR, "FRAME_LINES", 15)
    monkeypatch.setattr(PR, "SPOOL_BYTES", 500)
    lines = [(*_iv(i % 12), "TH_NP15_GEN-APND", "lmp ", i, 0) for i in range(100)]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("p.csv", _csv(lines))
    frames = list(PR.archive_frames("a.zip", buf))
    assert max(map(len, frames)) <= 15
    whole = [b for b in PR._whole(PR.archive_frames("a.zip", buf))]
    assert [x for b in whole for x in b["line"].to_pylist()] == list(range(100))
    assert [x for b in whole for x in b["value"].to_pylist()] == [str(i) for i in range(100)]
    assert {x for b in whole for x in b["item"].to_pylist()} == {"LMP"}
    late = PR.price_frames("b.csv", io.BytesIO((_csv(lines) + "1,2,3,4,5,6,7\n").encode()))    # a line that can't be read, after good ones
    assert [(b["status"].to_pylist(), b["source_file"].to_pylist()) for b in PR._whole(late)] == [(["bad_csv"], ["b.csv"])]


def test_archives_are_packed_line_by_line():
    import pyarrow as pa
    from market_engine.sources import adapters
    rows = [(f"/l/{d}.zip", "p.csv", d == 2, "NP15", f"{d},{i}\n") for d in (1, 2, 3) for i in range(7)]
    batches = [pa.record_batch([list(c) for c in zip(*rows[i:i + 4])], names=["path", "member", "cut", "trading_hub", "line"]) for i in range(0, len(rows), 4)]
    out = [b.to_pylist()[0] for b in adapters._pack_archives(iter(batches))]
    assert [(r["path"], r["trading_hub"]) for r in out] == [(f"/l/{d}.zip", "NP15") for d in (1, 2, 3)]
    for d in (1, 3):
        text = zipfile.ZipFile(io.BytesIO(out[d - 1]["content"])).read("p.csv").decode()
        assert text.split("\n")[1:] == [f"{d},{i}" for i in range(7)] + [""]
    assert not zipfile.is_zipfile(io.BytesIO(out[1]["content"]))


def test_rows_without_a_time_are_in_no_archive(spark, tmp_path_run):
    from market_engine.sources import adapters
    sf = os.path.join(tmp_path_run, "sf")
    spark.sql("""select id as event_id, case when id % 2 = 0 then timestamp_ntz'2024-01-05 01:02:03' end as ts, id as user_id, 'view' as event_type,
        cast(id as double) as value, '{"k": 1}' as props from range(12)""").write.parquet(os.path.join(sf, "events.parquet"))
    long = PR.decode_files(adapters.price_archives(spark, sf))
    assert {r.status for r in long.collect()} == {"ok"} and long.count() == 6 * 5
