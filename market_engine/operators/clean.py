"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from market_engine.constants import HUB_NODES


def conform(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """B-1 + B-2: rename, add missing columns as typed NULL, and emit ``schema``'s column order."""
    rename = dict(rename or {})
    cols = []
    present = {rename.get(c, c): c for c in df.columns}
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f"`{present[f.name]}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def ensure_columns(df: DataFrame, cols: Iterable[str], dtype: str = "double") -> DataFrame:
    """B-2: add each missing column as NULL of ``dtype``."""
    missing = {c: F.lit(None).cast(dtype) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def require_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """B-6: drop rows with a NULL key part."""
    return df.dropna(subset=list(keys))


def filter_codes(df: DataFrame, col: str, codes: Iterable[str]) -> DataFrame:
    """B-8: keep rows whose code is one of ``codes`` (an empty match gives an empty frame)."""
    return df.filter(F.col(col).isin(list(codes)))


def map_hub(c, nodes: Mapping[str, str] = HUB_NODES, strict: bool = True) -> Column:
    """B-9: hub name -> pricing node id; unknown hubs raise (``strict``) or map to NULL."""
    lookup = F.create_map(*[x for k, v in nodes.items() for x in (F.lit(k), F.lit(v))])
    key = F.upper(F.col(c) if isinstance(c, str) else c)
    node = lookup[key]
    if not strict:
        return node
    return F.when(node.isNotNull(), node).otherwise(
        F.raise_error(F.concat(F.lit("unknown trading hub: "), key)))


def stamp(df: DataFrame, **consts) -> DataFrame:
    """A-21: lineage constants (market, source_system, loaded_at, balancing_authority, ...)."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in consts.items()})


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """B-17: rows matching an invalid-row predicate (``isNull``, ``~isin``; SQL NULL logic applies)."""
    return df.filter(predicate)
