"""Texts packed for a shuffle: zstd per row, about half of what the shuffle's own fast codec leaves.

For joins that must move whole texts to the rows that say what to do with them.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame


def _pack(batches):
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        last = batch.column(batch.num_columns - 1)
        packed = pa.array([z.compress(x.as_buffer()) if x.is_valid else None for x in last], pa.binary())
        yield pa.record_batch([*batch.columns[:-1], packed], names=[*batch.schema.names[:-1], "packed"])


def pack(df: DataFrame) -> DataFrame:
    """``df`` with its last column, a text, as binary column ``packed``; null stays null."""
    keep = df.select(*[f"`{c}`" for c in df.columns[:-1]])
    return df.mapInArrow(_pack, keep.schema.add("packed", "binary"))


def unpack_slices(columns: list[pa.Array], size: int):
    """Yields (first row, row after the last, string columns) of packed columns, about ``size`` bytes of text at a time."""
    z = zstandard.ZstdDecompressor()
    first, held, texts = 0, 0, [[] for _ in columns]
    for r, row in enumerate(zip(*columns)):
        for x, to in zip(row, texts):
            to.append(z.decompress(x.as_buffer()) if x.is_valid else b"")
            held += len(to[-1])
        if held > size or r + 1 == len(columns[0]):
            yield first, r + 1, [pa.array(t, pa.binary()).cast(pa.string()) for t in texts]
            first, held, texts = r + 1, 0, [[] for _ in columns]


def unpack(column: pa.Array) -> pa.Array:
    z = zstandard.ZstdDecompressor()
    return pa.array([z.decompress(x.as_buffer()) if x.is_valid else None for x in column], pa.binary()).cast(pa.string())
