"""Sharding by rendezvous hashing: every record goes to the shard with the highest weighted score.

The score of (record key, shard) is ``weight / -ln(u)`` with u taken from the digest of both, so a
record's shard depends on its key and the shard list alone. A new shard wins some records from the
old ones and moves none between them; a larger weight wins proportionally more. Built-in functions
only; the text is read once, and only its size and checksum travel further.

Slots number the records of a shard without gaps. Equal records are counted first, so a key that
holds a third of all rows is one row in the shuffle; running offsets come from counts per
(shard, leading bits of the key digest), so no task sorts a whole shard.

Defined results: a null key has the digest of the empty string, a null text has no bytes; equal
scores go to the smaller shard id; repeated rows share their shard and get slots of their own; a
column of the input is taken by name and never written to; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.llm.common import stored
from market_engine.operators.ranking import distributed_running_count

#: Bytes that a record takes besides its text.
OVERHEAD = 8
#: Copies of one record that are numbered at a time.
CHUNK = 65536


def key_digest(*parts: Column) -> Column:
    """52 leading bits of the md5 of the parts joined by ':' as long."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def score(key: Column, shard: int, weight: float = 1.0) -> Column:
    u = (key_digest(key, F.lit(shard)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.lit(float(weight)) / -F.log(u)


def choose_shard(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard id of the highest score; equal scores go to the smaller id."""
    ranked = F.array_max(F.array(*[
        F.struct(score(key, s, w).alias("score"), F.lit(-s).alias("neg")) for s, w in sorted(weights.items())]))
    return (-ranked["neg"]).cast("int")


def grow(key: Column, shard: Column, old: Mapping[int, float], new: int, weight: float = 1.0) -> Column:
    """The shard after ``new`` joins: a record moves only if the new shard outbids its own."""
    own = F.coalesce(*[F.when(shard == s, score(key, s, w)) for s, w in sorted(old.items())])
    bid = score(key, new, weight)
    wins = (bid > own) | ((bid == own) & (F.lit(new) < shard))
    return F.when(wins, F.lit(new)).otherwise(shard).cast("int")


def assign(df: DataFrame, key: str, weights: Mapping[int, float], name: str = "shard") -> DataFrame:
    """All rows and columns of ``df`` plus ``name``; no shuffle."""
    return df.withColumn(name, choose_shard(F.col(key), weights))


def manifest(df: DataFrame, key: str, text: str, weights: Mapping[int, float], grown: tuple[int, float] | None = None,
             slot_bits: int = 12) -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot, grown_shard. ``slot_bits``: leading digest
    bits per numbering bucket; 2**slot_bits buckets a shard."""
    t = F.coalesce(F.col(text), F.lit(""))
    rec = df.select(F.col(key).alias("key"), (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
                    F.crc32(t.cast("binary")).alias("text_crc32"))
    rec = rec.groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    rec = rec.withColumn("shard", choose_shard(F.col("key"), weights)).withColumn(
        "rank", key_digest(F.col("key"), F.col("text_crc32")))
    new = F.lit(None).cast("int") if grown is None else grow(F.col("key"), F.col("shard"), weights, *grown)
    rec = stored(rec.withColumn("grown_shard", new), "shards")
    rec = distributed_running_count(rec, ["shard"], F.shiftright("rank", 52 - slot_bits),
                                    ["rank", "key", "size", "text_crc32"], "copies")
    last = F.col("copies") - 1
    rec = rec.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / CHUNK))))
    first = F.col("chunk") * CHUNK
    rec = rec.withColumn("copy", F.explode(F.sequence(first, F.least(last, first + (CHUNK - 1)))))
    return rec.select("key", "size", "text_crc32", "shard", (F.col("_before") + F.col("copy")).alias("slot"), "grown_shard")
