"""Operations API pages landed as JSON files.

Each file is one page ``{"response": {"total": .., "data": [..]}}`` or ``{"error": ..}``.
Pages are parsed with an explicit schema (no inference pass) from (file, content) rows, so landed files and
pages from any other frame take one path, and unnested with ``posexplode`` so each record keeps (file, position)
as its arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from market_engine.constants import OPS_SOURCE_SYSTEM
from market_engine.functions import instant_to_utc_ntz, parse_hour_period
from market_engine.operators.hourly import pivot_ops
from market_engine.schemas import OPS_PAGE


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON files, one row per page, see ``parse_pages``."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    return parse_pages(files.select(F.col("_metadata.file_path").alias("page_file"), F.col("value").alias("content")))


def parse_pages(files: DataFrame) -> DataFrame:
    """Pages (page_file, content) with an explicit schema: error, response, the request folder, and ``_corrupt``, the
    text of a page that is cut off or does not fit the schema (a blank one too). Pages of several landings are united
    before (G-2); each is parsed where it lies."""
    schema = T.StructType([*OPS_PAGE.fields, T.StructField("_corrupt", T.StringType())])
    page = F.from_json("content", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    blank = F.when(F.trim(F.coalesce("content", F.lit(""))) == "", F.coalesce("content", F.lit("")))
    return files.withColumn("page", page).select(
        "page.error", "page.response", F.coalesce("page._corrupt", blank).alias("_corrupt"), "page_file",
        F.regexp_replace("page_file", "/[^/]*$", "").alias("request"))


def reject_error_pages(pages: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """A-4: pages with an ``error`` member, unreadable pages and pages without a ``response`` are split
    off with what is wrong as ``error`` (or, ``strict``, fail the job)."""
    wrong = F.when(F.col("_corrupt").isNotNull(), F.lit("unreadable page")).otherwise(F.coalesce(
        "error", F.when(F.col("response").isNull(), F.lit("page without a response"))))
    judged = pages.withColumn("error", wrong).drop("_corrupt")
    good = judged.filter(F.col("error").isNull())
    if strict:
        # the predicate is evaluated for every page, so the first error page fails the job
        good = judged.filter(F.when(F.col("error").isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("operations API error: "), F.col("error")))))
    return good, judged.filter(F.col("error").isNotNull()).select("page_file", "request", "error")


def explode_pages(good: DataFrame) -> DataFrame:
    """A-3: ``response.data[]`` -> long rows (period, respondent, type, value, seq)."""
    rec = good.select("page_file", "request", F.posexplode("response.data").alias("pos", "r"))
    return rec.select(
        F.col("r.period").alias("period"), F.col("r.respondent").alias("respondent"),
        F.coalesce(F.col("r.type"), F.col("`r`.`type-name`")).alias("type"),
        F.col("r.value").alias("value"),
        F.struct("page_file", "pos").alias("seq"), "request")


def check_page_totals(good: DataFrame) -> DataFrame:
    """A-5: per request folder, records received vs the ``total`` the API reported."""
    per_page = good.select("request", F.col("response.total").try_cast("bigint").alias("total"),
                           F.size(F.coalesce("response.data", F.array())).alias("n"))
    g = per_page.groupBy("request").agg(F.max("total").alias("reported_total"), F.sum("n").alias("received_rows"),
                                        F.count(F.lit(1)).alias("pages"))
    return g.withColumn("complete", F.coalesce(F.col("reported_total") == F.col("received_rows"), F.lit(False)))


def incomplete_requests(totals: DataFrame, bad: DataFrame) -> DataFrame:
    """Requests that miss rows: totals that differ or are unknown, or only rejected pages."""
    short = totals.filter(~F.col("complete")).select("request")
    lost = bad.select("request").distinct().join(totals.select("request"), "request", "left_anti")
    return short.unionByName(lost)


def ops_from_pages(spark: SparkSession, path: str, source_system: str = OPS_SOURCE_SYSTEM,
                   loaded_at: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages -> raw.ops_hourly rows (D-4 keyed on period and respondent), error pages, totals check."""
    return ops_of(read_pages(spark, path), source_system, loaded_at)


def ops_of(pages: DataFrame, source_system: str = OPS_SOURCE_SYSTEM,
           loaded_at: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``ops_from_pages`` on pages that are parsed already."""
    good, bad = reject_error_pages(pages)
    long = explode_pages(good)
    wide = pivot_ops(long)
    stamp_ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else instant_to_utc_ntz(F.current_timestamp())
    ops = wide.select(parse_hour_period("period").alias("period"),
                      F.col("respondent").alias("balancing_authority"),
                      "demand_mwh", "demand_forecast_mwh", "net_generation_mwh", "interchange_mwh",
                      F.lit(source_system).alias("source_system"), stamp_ts.alias("loaded_at"))
    return ops, bad, check_page_totals(good)
