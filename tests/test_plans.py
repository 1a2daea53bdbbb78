"""Plan-shape guards (formatted explain output): no repeated raw scans, no needless shuffles."""

import contextlib
import io

from helpers import SF01
from market_engine.operators import features as FE
from market_engine.plans import market


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_distributed_lags_read_the_rollup_once(spark):
    lay = market.from_testdata(spark, SF01, market.MarketParams(lag_method="join"), materialise="none")
    joined = FE.join_ops(lay.stg_prices.filter("market = 'RTM'"), lay.stg_ops.filter("balancing_authority = 'CISO'"))
    plan = _plan(FE.add_lags(joined))
    assert "events.parquet" not in plan                 # every branch reads the materialised input
    reads = sorted((ln for ln in plan.splitlines() if ln.startswith("ReadSchema")), key=len)
    assert len(reads) == 2 and "lmp_avg" not in reads[0]    # the counts a day read the keys only


def test_default_mart_broadcasts_thresholds_to_the_features(spark):
    plan = _plan(market.from_testdata(spark, SF01, materialise="none").stress)
    tree = [ln for ln in plan.split("\n\n")[0].splitlines() if "Join" in ln]
    assert "BroadcastHashJoin LeftOuter" in tree[0]      # the outermost join: features with thresholds
    assert "percentile(" not in plan and "Window [lag" not in plan
    reads = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert all("event_type" not in r or "props" not in r for r in reads)


def test_mart_prunes_scans_and_broadcasts_thresholds(spark):
    # the one-task-per-hub form, kept for comparison
    params = market.MarketParams(lag_method="window", threshold_method="aggregate")
    lay = market.from_testdata(spark, SF01, params, materialise="none")
    plan = _plan(lay.stress)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    reads = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert reads and all("event_type" not in r or "props" not in r for r in reads)   # column pruning
    assert "PushedFilters: [IsNotNull(ts)]" in plan
