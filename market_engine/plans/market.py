"""Composed market-stress job: raw feeds -> staging -> features -> mart -> dashboard.

Each stage is a lazy DataFrame; Catalyst sees one plan per output and pushes the market /
authority filters into the scans. The roll-up's hourly rows, joined with the operations, feed the lags
and the per-hub thresholds; they are stored once, everything behind them is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from market_engine.constants import DEFAULT_BA, DEFAULT_LAGS, DEFAULT_MARKET
from market_engine.operators.dashboard import dashboard_view
from market_engine.operators.features import features_of, joined_prices
from market_engine.operators.hourly import hourly_prices, staged_ops
from market_engine.operators.stress import market_stress
from market_engine.session import materialise_frame
from market_engine.sources import adapters


@dataclass(frozen=True)
class MarketParams:
    market: str = DEFAULT_MARKET
    balancing_authority: str = DEFAULT_BA
    lags: Sequence[int] = DEFAULT_LAGS
    lag_mode: str = "rows"
    # one path at every size: "window" / "aggregate" (one task per hub) exist for comparison only
    lag_method: str = "join"
    threshold_method: str = "distributed"
    week_start: str = "monday"
    quantiles: Sequence[float] = (0.95, 0.99)
    exact_percentiles: bool = True
    price_decimals: int | None = 5


class MarketLayers:
    """Lazy layers: each is built (and the feature table materialised) on first access, so a
    query that needs only staging never pays for the features."""

    def __init__(self, raw_prices, raw_ops, params: MarketParams, materialise: str):
        # raw inputs: DataFrames, or zero-argument callables building them on first use
        self._raw_prices, self._raw_ops = raw_prices, raw_ops
        self.params, self.materialise = params, materialise

    @staticmethod
    def _get(x) -> DataFrame:
        return x() if callable(x) else x

    @cached_property
    def stg_prices(self) -> DataFrame:
        return hourly_prices(self._get(self._raw_prices), self.params.price_decimals)

    @cached_property
    def stg_ops(self) -> DataFrame:
        return staged_ops(self._get(self._raw_ops))

    @cached_property
    def joined(self) -> DataFrame:
        """Prices with operations: the roll-up's result, stored once if anything is (the lags and the thresholds read it)."""
        j = joined_prices(self.stg_prices, self.stg_ops, self.params.market, self.params.balancing_authority)
        if self.materialise == "persist":
            return j.persist(StorageLevel.MEMORY_AND_DISK)
        return materialise_frame(j) if self.materialise == "checkpoint" else j

    @cached_property
    def features(self) -> DataFrame:
        p = self.params
        return features_of(self.joined, p.lags, p.lag_mode, p.week_start, p.lag_method, stored=self.materialise != "none")

    @cached_property
    def stress(self) -> DataFrame:
        p = self.params
        return market_stress(self.features, p.quantiles, p.exact_percentiles, p.threshold_method, prices=self.joined)

    @cached_property
    def dashboard(self) -> DataFrame:
        return dashboard_view(self.stress)


def build(raw_prices: DataFrame, raw_ops: DataFrame, params: MarketParams = MarketParams(),
          materialise: str = "none") -> MarketLayers:
    """Compose the layers. ``materialise`` for the rolled-up prices joined with operations (read by the lags and
    the threshold aggregate of every downstream report):

    * ``"none"``: lazy; one plan per output.
    * ``"persist"``: MEMORY_AND_DISK cache (lost partitions are recomputed from lineage).
    * ``"checkpoint"``: written as Parquet to the shared ``spark.checkpoint.dir``; cuts the lineage so
      downstream plans start from a scan of the columns they need and survive executor loss.
    """
    if materialise not in ("none", "persist", "checkpoint"):
        raise ValueError(f"materialise must be none, persist or checkpoint, got {materialise!r}")
    return MarketLayers(raw_prices, raw_ops, params, materialise)


def from_testdata(spark: SparkSession, sf_dir: str, params: MarketParams = MarketParams(),
                  materialise: str = "checkpoint") -> MarketLayers:
    return build(lambda: adapters.lmp_5min(spark, sf_dir), lambda: adapters.ops_hourly(spark, sf_dir),
                 params, materialise)
