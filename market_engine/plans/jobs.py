"""The daily lifecycle as three jobs: ingest, build marts + data tests, train + publish.

Each job is a composition of the operators; storage is Parquet paths or catalog tables.
Reruns are idempotent: raw loads replace (day, hub) / (day, authority) partitions, marts are
overwritten, model outputs replace their ``model_version`` partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.constants import OPS_SOURCE_SYSTEM, PRICES_SOURCE_SYSTEM
from market_engine.operators import ml, ml_outputs, quality
from market_engine.plans import market
from market_engine.session import materialise_frame
from market_engine.sinks.tables import materialise, replace_partitions, with_load_date
from market_engine.sources.pages import incomplete_requests, ops_from_pages
from market_engine.sources.prices import read_price_archives


@dataclass
class IngestResult:
    rows: int
    rejected: DataFrame
    totals: DataFrame | None = None


def ingest_prices(spark: SparkSession, landing: str, raw_path: str, kind: str = "zip", market_name: str = "RTM",
                  source_system: str = PRICES_SOURCE_SYSTEM, loaded_at: str | None = None) -> IngestResult:
    """Entry 1 (prices): landed archives -> raw.lmp_5min, replacing the (day, hub) partitions present."""
    prices, bad = read_price_archives(spark, landing, kind, market=market_name, source_system=source_system,
                                      loaded_at=loaded_at)
    n = replace_partitions(with_load_date(prices, "interval_start"), raw_path, ["load_date", "trading_hub"])
    return IngestResult(n, bad)


def ingest_ops(spark: SparkSession, landing: str, raw_path: str, source_system: str = OPS_SOURCE_SYSTEM,
               loaded_at: str | None = None, allow_incomplete: bool = False) -> IngestResult:
    """Entry 1 (operations): landed pages -> raw.ops_hourly, replacing (day, authority) partitions.

    Refused while a request lacks rows (good days must not be replaced by parts of them), unless
    ``allow_incomplete``."""
    ops, bad, totals = ops_from_pages(spark, landing, source_system, loaded_at)
    if not allow_incomplete:
        short = incomplete_requests(totals, bad).agg(F.count(F.lit(1)).alias("n"), F.min("request").alias("first")).first()
        if short["n"]:
            raise ValueError(f"{short['n']} request(s) under {landing} are incomplete, the first is {short['first']}")
    n = replace_partitions(with_load_date(ops, "period"), raw_path, ["load_date", "balancing_authority"])
    return IngestResult(n, bad, totals)


def build_marts(spark: SparkSession, raw_prices: str, raw_ops: str,
                params: market.MarketParams = market.MarketParams(), publish: bool = True,
                raise_on_error: bool = True) -> tuple[market.MarketLayers, DataFrame]:
    """Entry 2: staging view, feature / mart tables, then the 26 schema tests (one scan per table)."""
    lay = market.build(spark.read.parquet(raw_prices).drop("load_date"),
                       spark.read.parquet(raw_ops).drop("load_date"), params, materialise="checkpoint")
    frames = {"stg_lmp_hourly": lay.stg_prices, "int_hourly_market_features": lay.features,
              "mart_hourly_market_stress": lay.stress, "mart_price_spike_dashboard": lay.dashboard}
    if publish:
        materialise(lay.stg_prices, "staging", "stg_lmp_hourly")
        materialise(lay.stg_ops, "staging", "stg_ops_hourly")
        materialise(lay.features, "intermediate", "int_hourly_market_features")
        materialise(lay.stress, "mart", "mart_hourly_market_stress")
        materialise(lay.dashboard, "mart", "mart_price_spike_dashboard")
    reports = [quality.run_checks(frames[t], checks, t) for t, checks in quality.schema_suite().items()]
    report = reports[0]
    for r in reports[1:]:
        report = report.unionByName(r)
    report = materialise_frame(report)
    if raise_on_error:
        quality.assert_checks(report)
    return lay, report


def train_and_publish(stress: DataFrame, model_version: str, predictions_path: str, metrics_path: str,
                      trained_at: str | None = None, kind: str = "logreg", split: str = "stratified"):
    """Entry 3: features -> split -> fit -> score -> predictions + metrics for ``model_version``."""
    ff = ml.build_features(stress)
    s = ml.stratified_split(ff.df) if split == "stratified" else ml.temporal_split(ff.df)
    s = materialise_frame(s)
    train, test = s.filter("not is_test"), s.filter("is_test")
    model = ml.train_classifier(train, ff.numeric, ff.categorical, kind=kind)
    # not cached: the scoring expression captures the fitted model, whose training summary the
    # cache / checkpoint paths cannot serialise; re-scoring the materialised test split is cheap
    scored = ml.score(model, test)
    preds = ml_outputs.predictions(scored, model_version, trained_at)
    metrics = ml_outputs.model_metrics(scored, train, model_version, trained_at)
    n_pred = replace_partitions(preds, predictions_path, ["model_version"])
    replace_partitions(metrics, metrics_path, ["model_version"])
    return model, n_pred
