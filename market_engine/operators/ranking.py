"""Exact per-group row numbers without a single-task sort per group.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends each group to one task. Here rows are
first assigned to an ordered bucket (a coarse, monotone function of ``o``: the day of an hour,
the leading bits of a hash, a quantile range of a score). Then:

1. counts per (group, bucket) — a partially aggregated, small table;
2. running offsets per group over its buckets (a window over bucket counts only);
3. the local row number inside (group, bucket), plus the bucket's offset.

The result equals the single window's row numbers (ties within ``o`` are broken by the
remaining ``order`` columns, as with any row_number), while every task sees one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_engine.session import materialise_frame


def distributed_row_number(df: DataFrame, partition_by: Sequence[str], bucket: Column,
                           order_by: Sequence[Column | str], name: str = "_rn",
                           broadcast_offsets: bool = False) -> DataFrame:
    """Add ``name`` = 1-based row number within ``partition_by`` in ``order_by`` order.

    ``bucket`` must be non-decreasing in ``order_by`` (its value orders the buckets).
    ``broadcast_offsets`` is for bucket functions with a fixed bucket count (a proven bound).
    """
    keys = list(partition_by)
    b = df.withColumn("_bkt", bucket)
    counts = b.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_bkt") if keys else Window.orderBy("_bkt")
    offsets = counts.select(*keys, "_bkt", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    if broadcast_offsets:
        offsets = F.broadcast(offsets)
    joined = b.join(offsets, [*keys, "_bkt"], "inner")
    local = Window.partitionBy(*keys, "_bkt").orderBy(*order_by)
    return joined.withColumn(name, F.col("_off") + F.row_number().over(local)).drop("_bkt", "_off")


def with_neighbours(ranked: DataFrame, key: Sequence[str], back: int = 0, ahead: int = 0, size: int = 4096):
    """Rows numbered without gaps by ``_rn``, dealt to blocks (key, ``_block``) of ``size`` row numbers, each with copies
    of the ``back`` rows before and the ``ahead`` rows after it: (frame, window over a block by row number,
    filter for a block's own rows). Lags and leads of up to that many rows are complete inside a block, so a long group is
    many blocks of work and a row costs little more than one copy."""
    size = max(size, back, ahead)
    own = F.floor((F.col("_rn") - 1) / size)
    place = F.pmod(F.col("_rn") - 1, F.lit(size))
    blocks = F.array_compact(F.array(own, F.when(place >= size - back, own + 1) if back else F.lit(None).cast("long"),
                                     F.when(place < ahead, own - 1) if ahead else F.lit(None).cast("long")))
    out = ranked.withColumn("_block", F.explode(blocks))
    return out, Window.partitionBy(*key, "_block").orderBy("_rn"), F.col("_block") == own


#: Numbers that are broadcast at most as cuts of value ranges: keys times ranges.
BROADCAST_CUTS = 1 << 20
_STEP = 16


def splitters(df: DataFrame, key: Sequence[str], value: str, *more: Column, buckets: int = 256, accuracy: int = 10_000) -> DataFrame:
    """(*key, _cuts, *more): values that cut each key's rows into ranges of nearly equal numbers of rows, from a quantile
    sketch whose ranks are off by at most rows / accuracy, and further aggregates. Cuts lie where the rows lie, however
    unevenly the values are spread. One partially aggregated pass, one row a key."""
    if buckets % _STEP:
        raise ValueError(f"buckets must be a multiple of {_STEP}")
    cuts = F.percentile_approx(value, F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), accuracy)
    return df.groupBy(*key).agg(F.array_distinct(cuts).alias("_cuts"), *more)


def with_range(df: DataFrame, key: Sequence[str], value: str, *more: Column, buckets: int = 256) -> DataFrame:
    """``df`` with the number of its value's range among its key's ``splitters`` as ``_bkt`` (a cut belongs to the range
    below it) and the aggregates ``more`` of its key. Reads ``df`` twice; the cuts are broadcast if they are counted to be
    few, else joined on the key."""
    cuts = materialise_frame(splitters(df, key, value, *more, buckets=buckets))
    if not key:
        cuts = cuts.withColumn("_one", F.lit(1))
        df = df.withColumn("_one", F.lit(1))
    few = not key or cuts.count() * buckets <= BROADCAST_CUTS
    out = df.join(F.broadcast(cuts) if few else cuts, list(key) or "_one")
    # looked up in two steps: among every 16th cut, then in the 16 cuts that follow
    out = out.withColumn("_coarse", F.expr(f"size(filter(sequence(1, {buckets // _STEP}), i -> get(_cuts, i * {_STEP} - 1) < `{value}`))"))
    fine = F.expr(f"size(filter(slice(_cuts, _coarse * {_STEP} + 1, {_STEP}), x -> x < `{value}`))")
    return out.withColumn("_bkt", F.col("_coarse") * _STEP + fine).drop("_cuts", "_coarse", "_one")


def hex_bucket(hexstr: Column, chars: int = 3) -> Column:
    """Leading hex characters of a digest string: monotone in the string order, 16**chars buckets."""
    return F.substring(hexstr, 1, chars)


def distributed_running_count(df: DataFrame, partition_by: Sequence[str], bucket: Column | str,
                              order_by: Sequence[Column | str], weight: str, name: str = "_before") -> DataFrame:
    """Add ``name`` = sum of ``weight`` over the rows before this one within ``partition_by``
    (in ``order_by`` order), computed with per-bucket offsets as in ``distributed_row_number``."""
    keys = list(partition_by)
    b = df if isinstance(bucket, str) else df.withColumn("_bkt", bucket)
    sums = b.groupBy(*keys, "_bkt").agg(F.sum(weight).alias("_w"))
    w = Window.partitionBy(*keys).orderBy("_bkt") if keys else Window.orderBy("_bkt")
    offsets = sums.select(*keys, "_bkt", (F.sum("_w").over(w) - F.col("_w")).alias("_off"))
    joined = b.join(offsets, [*keys, "_bkt"], "inner")
    local = (Window.partitionBy(*keys, "_bkt").orderBy(*order_by)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.withColumn(name, F.col("_off") + F.sum(weight).over(local) - F.col(weight)).drop("_bkt", "_off")
