"""Adapters from the shared test tables to the landing schemas (FIXTURES.md §2).

Only ``events`` has sub-daily time, so both feeds are derived from it. Keys are padded and
mixed-case on purpose, so staging has to clean them. Every row of ``events`` is used.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from market_engine.constants import PRICE_ITEMS
from market_engine.functions import clean_key, parse_hour_period
from market_engine.operators.hourly import pivot_ops

# fixed load time stamped on adapter rows (lineage constant, keeps runs reproducible)
LOADED_AT = "2024-02-01 00:00:00"


_SCANS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A-7: scan one table by name.

    The shared test tables are read-only, so the scan (file listing + footer schema) is built
    once per session and path; DataFrames are immutable plans, so reuse is safe.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)   # a new application never reuses a scan
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("bigint")


def lmp_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.lmp_5min over ``events``: components sum to the price."""
    return lmp_from_events(table(spark, sf_dir, "events"))


def lmp_from_events(e: DataFrame) -> DataFrame:
    """The price mapping as a plain projection (works on batch and streaming frames)."""
    k = _k()
    loss_units = F.col("event_id") % 7
    return e.select(
        F.col("ts").alias("interval_start"),
        F.timestamp_add("MINUTE", F.lit(5), F.col("ts")).alias("interval_end"),
        F.when(F.col("user_id") % 3 == 0, " np15").when(F.col("user_id") % 3 == 1, "SP15 ")
         .otherwise("Zp26").alias("trading_hub"),
        F.col("value").alias("lmp"),
        ((F.round(F.col("value") * 100).cast("bigint") - k - loss_units) / 100.0).alias("energy_component"),
        (k / 100.0).alias("congestion_component"),
        (loss_units / 100.0).alias("loss_component"),
        F.when(F.col("event_id") % 10 == 9, " dam").otherwise("rtm ").alias("market"),
        F.lit("events_feed").alias("source_system"),
        F.lit(LOADED_AT).cast("timestamp_ntz").alias("loaded_at"),
    )


def ops_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long operations rows (period string, respondent, type code, value string, seq) over ``events``.

    Includes an unknown code (ZZ) and unparsable values ('n/a').
    """
    e = table(spark, sf_dir, "events")
    period = F.concat_ws("T", F.to_date("ts").cast("string"), F.lpad(F.hour("ts").cast("string"), 2, "0"))
    code = (F.when(F.col("event_type") == "view", "D").when(F.col("event_type") == "click", "DF")
            .when(F.col("event_type") == "purchase", "NG").when(F.col("event_type") == "signup", "TI")
            .otherwise("ZZ"))
    return e.select(
        period.alias("period"),
        F.when(F.col("user_id") % 2 == 0, "CISO").otherwise("MISO").alias("respondent"),
        code.alias("type"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("event_id").alias("seq"),
    )


def ops_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.ops_hourly: pivot of ``ops_long`` (D-4), period parsed (H-10), lineage stamped (A-21)."""
    wide = pivot_ops(ops_long(spark, sf_dir))
    return wide.select(
        parse_hour_period("period").alias("period"),
        F.col("respondent").alias("balancing_authority"),
        "demand_mwh", "demand_forecast_mwh", "net_generation_mwh", "interchange_mwh",
        F.lit("events_feed").alias("source_system"),
        F.lit(LOADED_AT).cast("timestamp_ntz").alias("loaded_at"),
    )


# ---------------------------------------------------------------- landings built from the test tables
def price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long price rows over ``events``, as text: the four items, an unknown one, and values that can't be read."""
    raw = lmp_5min(spark, sf_dir).withColumn("event_id", F.monotonically_increasing_id())
    stamp = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-00:00"))
    items = [F.struct(F.lit(code).alias("item"), F.col(name).cast("string").alias("value")) for code, name in PRICE_ITEMS.items()]
    items += [F.struct(F.lit("OTHER").alias("item"), F.lit("1").alias("value"))]
    return raw.select(clean_key("trading_hub").alias("trading_hub"), stamp("interval_start").alias("start"), stamp("interval_end").alias("end"),
                      F.to_date("interval_start").alias("day"), F.posexplode(F.array(*items)).alias("place", "cell")).select(
        "trading_hub", "start", "end", "day", "place", "cell.item",
        F.when((F.col("place") == 3) & F.col("start").contains(":00:0"), F.lit("n/a")).otherwise(F.col("cell.value")).alias("value"))


#: Column orders of the CSV landing, by day.
CSV_ORDERS = (("STARTTIME", "ENDTIME", "DATA_ITEM", "VALUE"), ("MW", "LMP_TYPE", "INTERVAL_END_GMT", "INTERVAL_START_GMT"),
              ("INTERVALSTARTTIME_GMT", "NOTE", "DATA_ITEM", "MW", "ENDTIME"))


def land_price_csv(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """``price_lines`` as a CSV file for each hub and day under ``folder``/trading_hub=<hub>/day=<day>/, one row an interval and
    item, in three orders of columns; every seventh day's lines of the second order lack their last field."""
    one = price_lines(spark, sf_dir).groupBy("trading_hub", "day", "start", "end", "item").agg(F.min("value").alias("value"))
    of = {"STARTTIME": "start", "ENDTIME": "end", "DATA_ITEM": "item", "VALUE": "value", "MW": "value", "LMP_TYPE": "item",
          "INTERVAL_END_GMT": "end", "INTERVAL_START_GMT": "start", "INTERVALSTARTTIME_GMT": "start"}
    line, head = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, order in enumerate(CSV_ORDERS):
        cells = [F.coalesce(F.col(of[c]), F.lit("")) if c in of else F.lit('"a, b"') for c in order]
        short = (F.lit(i) == 1) & (F.dayofmonth("day") % 7 == 0)
        own = F.dayofyear("day") % len(CSV_ORDERS) == i
        line = F.when(own, F.when(short, F.concat_ws(",", *cells[:-1])).otherwise(F.concat_ws(",", *cells))).otherwise(line)
        head = F.when(own, F.lit(",".join(order))).otherwise(head)
    place = ["trading_hub", "day"]
    rows = one.select(*place, F.lit(1).alias("nth"), line.alias("value")).unionByName(
        one.select(*place).distinct().select(*place, F.lit(0).alias("nth"), head.alias("value")))
    rows.repartition(*place).sortWithinPartitions(*place, "nth").select("value", *place).write.partitionBy(*place).text(folder)


def _pack_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, member, cut, trading_hub, line), those of a path one after the other -> its ZIP archive (path, content, trading_hub).
    Lines are compressed as they come, so only the packed archive is held."""
    out = path = z = None

    def close() -> pa.RecordBatch:
        member.close()
        z.close()
        data = out.getvalue()
        return pa.record_batch([[path], [data[:-30] if cut else data], [hub]], names=["path", "content", "trading_hub"])

    for batch in batches:
        runs, at = pc.run_end_encode(batch.column(0)), 0
        for new, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if new != path:
                if path is not None:
                    yield close()
                path, name, cut, hub = (batch.column(c)[at].as_py() for c in range(4))
                out = io.BytesIO()
                z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                member = z.open(name, "w", force_zip64=True)
                member.write(b"INTERVALSTARTTIME_GMT,INTERVALENDTIME_GMT,LMP_TYPE,MW\n")
            member.write("".join(batch.column(4).slice(at, end - at).to_pylist()).encode())
            at = end
    if path is not None:
        yield close()


def price_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``price_lines`` as ZIP archives (path, content, trading_hub), one per hub and day: some cut off, some without a CSV.
    A row without a time is of no day and so in no archive."""
    day = F.col("day").cast("string")
    place = ["trading_hub", "day"]
    lines = price_lines(spark, sf_dir).filter("day is not null").repartition(*place).sortWithinPartitions(
        *place, "start", "place", F.asc_nulls_last("value"))
    return lines.select(
        F.concat(F.lit("/landing/"), "trading_hub", F.lit("/"), day, F.lit(".zip")).alias("path"),
        F.when(F.dayofmonth("day") == 17, "readme.txt").otherwise(F.concat("trading_hub", F.lit("_"), day, F.lit(".csv"))).alias("member"),
        (F.dayofmonth("day") == 13).alias("cut"), "trading_hub",
        F.concat(F.concat_ws(",", "start", "end", "item", F.coalesce("value", F.lit(""))), F.lit("\n")).alias("line"),
    ).mapInArrow(_pack_archives, "path string, content binary, trading_hub string")


def ops_pages(spark: SparkSession, sf_dir: str, per_page: int = 40) -> DataFrame:
    """``ops_long`` as API pages (page_file, content), a request per respondent and day: on the 5th the first page is cut off,
    on the 9th it is an error, on the 11th every fifth record is missing."""
    rec = ops_long(spark, sf_dir).withColumn("request", F.concat_ws("/", F.lit("/landing"), "respondent", F.substring("period", 1, 10)))
    day = F.substring("request", -2, 2).cast("int")
    total = F.count(F.lit(1)).over(Window.partitionBy("request"))
    nth = F.row_number().over(Window.partitionBy("request").orderBy("seq"))
    rec = rec.withColumns({"total": total, "page": F.floor((nth - 1) / per_page)}).filter(~((day == 11) & (F.col("seq") % 5 == 0)))
    pages = rec.groupBy("request", "page").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct(
        "seq", "period", "respondent", "type", "value"))).alias("data"))
    body = F.to_json(F.struct(F.struct(F.col("total").cast("string").alias("total"), F.transform("data", lambda r: r.dropFields("seq")).alias("data")).alias("response")))
    first = F.col("page") == 0
    body = F.when(first & (day == 5), F.substring(body, 1, 60)).when(first & (day == 9), F.lit('{"error": "over the limit"}')).otherwise(body)
    return pages.select(F.concat("request", F.format_string("/p%05d.json", "page")).alias("page_file"), body.alias("content"))
