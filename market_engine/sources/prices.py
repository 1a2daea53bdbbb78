"""Landed price files: CSVs inside ZIP archives and plain CSVs.

Archives are read with the ``binaryFile`` source (one row per archive, files split across
tasks) and decoded by a ``mapInArrow`` step: each task opens its archives with the standard
library, takes the first ``.csv`` member, conforms its header and emits long rows
(interval, item code, value), some lines at a time, so a task's memory holds the packed archive
and a part of its lines, however many there are. Undecodable archives become quarantine rows
instead of failing the job. The long->wide pivot (D-3) then runs as a Spark aggregation keyed on the interval.

The trading hub comes from the landing layout ``.../trading_hub=<HUB>/...`` (partition
discovery), or from a ``NODE`` column mapped back through the hub->node table.
"""

from __future__ import annotations

import io
import lzma
import tempfile
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence
from typing import IO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from market_engine.constants import HUB_NODES, PRICE_CSV_CANDIDATES, PRICE_ITEMS, PRICES_SOURCE_SYSTEM
from market_engine.functions import clean_key, instant_to_utc_ntz, parse_iso_utc
from market_engine.operators.hourly import pivot_prices
from market_engine.session import materialise_frame

LONG_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("start_raw", T.StringType()),
    T.StructField("end_raw", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("node", T.StringType()),
    T.StructField("line", T.LongType()),
])
NODE_CANDIDATES = ["NODE", "NODE_ID", "PNODE_ID"]
#: Lines of a CSV that a task parses at a time: as many as the parser itself takes from a file of four columns.
CSV_LINES = 1 << 17
#: Lines of a frame in LONG_SCHEMA.
FRAME_LINES = 10_000
#: Bytes of one file's text, and of its decoded lines, that a task keeps in memory; more go to its disk.
SPOOL_BYTES = 16 << 20


def normalise_header(pdf: pd.DataFrame) -> pd.DataFrame:
    """Strip and upper-case names; of duplicate names keep the first column."""
    pdf = pdf.copy()
    pdf.columns = [str(c).strip().upper() for c in pdf.columns]
    return pdf.loc[:, ~pdf.columns.duplicated()]


def resolve_columns(columns: Sequence[str], candidates: Mapping[str, Sequence[str]]) -> dict[str, str | None]:
    """Each logical column -> first candidate name present (None if absent)."""
    present = set(columns)
    return {k: next((c for c in cands if c in present), None) for k, cands in candidates.items()}


def _rows(path: str, status: str, detail: str = "") -> pd.DataFrame:
    return pd.DataFrame([{"source_file": path, "status": status, "detail": detail}], columns=LONG_SCHEMA.names)


def price_frames(path: str, file: IO[bytes]) -> Iterator[pd.DataFrame]:
    """One CSV -> its lines in LONG_SCHEMA, parsed CSV_LINES and yielded FRAME_LINES at a time. A file that can't be read ends with a quarantine row,
    which stands for the whole file, also for lines that came before it."""
    n = 0
    try:
        with pd.read_csv(file, dtype=str, keep_default_na=False, na_values=[""], encoding="utf-8-sig", chunksize=CSV_LINES) as chunks:
            for raw in chunks:
                raw = normalise_header(raw)
                cols = resolve_columns(raw.columns, PRICE_CSV_CANDIDATES)
                missing = [k for k, v in cols.items() if v is None]
                node = next((c for c in NODE_CANDIDATES if c in raw.columns), None)
                for i in range(0, 0 if missing else len(raw), FRAME_LINES):
                    part = raw.iloc[i:i + FRAME_LINES]
                    out = pd.DataFrame({
                        "source_file": path, "status": "ok", "detail": None,
                        "start_raw": part[cols["start"]], "end_raw": part[cols["end"]],
                        "item": part[cols["item"]].str.strip().str.upper(), "value": part[cols["value"]],
                        "node": part[node] if node else None,
                        "line": range(n + i, n + i + len(part)),
                    })
                    yield out[LONG_SCHEMA.names]
                n += len(raw)
    except ValueError as e:  # no columns, ragged rows, bytes that are not UTF-8
        yield _rows(path, "bad_csv", f"{type(e).__name__}: {e}"[:500])
        return
    if not n:
        yield _rows(path, "empty", "csv has no rows")
    elif missing:
        yield _rows(path, "missing_columns", ",".join(missing))


def archive_frames(path: str, file: IO[bytes]) -> Iterator[pd.DataFrame]:
    """First ``.csv`` member of a ZIP archive -> ``price_frames``; bad archives -> one quarantine row. The member is
    unpacked to its end, where its checksum stands, before it is read; a large one waits on the task's disk."""
    try:
        zf = zipfile.ZipFile(file)
    except zipfile.BadZipFile:
        yield _rows(path, "bad_zip", "not a zip archive")
        return
    members = [n for n in zf.namelist() if n.lower().endswith(".csv")]
    if not members:
        yield _rows(path, "no_csv", ";".join(zf.namelist()))
        return
    with tempfile.SpooledTemporaryFile(SPOOL_BYTES) as text:
        try:
            with zf.open(members[0]) as member:
                while block := member.read(1 << 20):
                    text.write(block)
        except (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, RuntimeError) as e:
            # damaged, cut off, encrypted, or of an unknown compression
            yield _rows(path, "bad_member", f"{members[0]}: {type(e).__name__}: {e}"[:500])
            return
        text.seek(0)
        yield from price_frames(path, text)


def decode_price_csv(path: str, data: bytes) -> pd.DataFrame:
    """One CSV's bytes -> long rows in LONG_SCHEMA (or one quarantine row)."""
    frames = list(price_frames(path, io.BytesIO(data)))
    return frames[-1] if frames[-1]["status"].iat[0] != "ok" else pd.concat(frames, ignore_index=True)


def _whole(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    """The frames of one file as Arrow batches, once it is known that the file can be read to its end; else its
    quarantine row alone. Lines that wait for that beyond SPOOL_BYTES wait on the task's disk."""
    schema = to_arrow_schema(LONG_SCHEMA)
    with tempfile.SpooledTemporaryFile(SPOOL_BYTES) as held:
        with pa.ipc.new_stream(held, schema) as sink:
            for frame in frames:
                table = pa.Table.from_pandas(frame, schema, preserve_index=False)
                if frame["status"].iat[0] != "ok":
                    yield from table.combine_chunks().to_batches()
                    return
                sink.write_table(table)
        held.seek(0)
        yield from pa.ipc.open_stream(held)


def read_price_files(spark: SparkSession, path: str, kind: str = "zip", glob: str | None = None) -> DataFrame:
    """A-1: landed archives (``kind="zip"``) or CSVs (``"csv"``) -> long rows incl. quarantine rows.

    Partition columns discovered from the layout (e.g. ``trading_hub``) are carried along.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
    reader = reader.option("pathGlobFilter", glob or ("*.zip" if kind == "zip" else "*.csv"))
    return decode_files(reader.load(path), kind)


def decode_files(files: DataFrame, kind: str = "zip") -> DataFrame:
    """Archives or CSVs as rows (path, content, partition columns) -> long rows incl. quarantine rows."""
    part_cols = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    schema = T.StructType(LONG_SCHEMA.fields + [files.schema[c] for c in part_cols])
    names = [f.name for f in schema.fields]
    frames = archive_frames if kind == "zip" else price_frames

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                for out in _whole(frames(b.column(0)[i].as_py(), pa.BufferReader(b.column(1)[i].as_buffer()))):
                    part = [pa.repeat(c[i], out.num_rows) for c in b.columns[2:]]
                    yield pa.record_batch([*out.columns, *part], names=names)

    return files.select("path", "content", *part_cols).mapInArrow(run, schema)


def split_quarantine(long: DataFrame, hub: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Data rows, and what is rejected (path, status, detail): one row per undecodable file and per line that
    can't be read (its times, or a wrong number of fields), and one per file and node (or hub folder) whose trading
    hub is unknown."""
    known = _hub_column(long, hub).isNotNull()
    timed = parse_iso_utc("start_raw").isNotNull() & parse_iso_utc("end_raw").isNotNull()
    good = F.col("status") == "ok"
    bad = long.filter(~good).select("source_file", "status", "detail")
    untimed = long.filter(good & ~timed).select("source_file", F.lit("bad_time").alias("status"), F.substring(
        F.concat_ws("|", F.coalesce("start_raw", F.lit("")), F.coalesce("end_raw", F.lit(""))), 1, 500).alias("detail"))
    folder = F.col("trading_hub").cast("string") if "trading_hub" in long.columns else F.lit(None).cast("string")
    lost = long.filter(good & timed & ~known).select(
        "source_file", F.lit("unknown_hub").alias("status"), F.coalesce(folder, "node").alias("detail")).distinct()
    return long.filter(good & timed & known), bad.unionByName(untimed).unionByName(lost)


def _hub_column(long: DataFrame, hub: str | None) -> F.Column:
    """The trading hub of a row: given, named by the landing folder, or of its node; NULL if unknown."""
    if hub is not None:
        return F.lit(hub)
    inverse = F.create_map(*[x for k, v in HUB_NODES.items() for x in (F.lit(v), F.lit(k))])
    by_node = F.try_element_at(inverse, F.trim("node"))
    if "trading_hub" in long.columns:
        folder = clean_key(F.col("trading_hub").cast("string"))
        return F.when(folder.isNull(), by_node).when(folder.isin(list(HUB_NODES)), folder)
    return by_node


def prices_from_long(ok: DataFrame, market: str = "RTM", source_system: str = PRICES_SOURCE_SYSTEM,
                     loaded_at: str | None = None, hub: str | None = None) -> DataFrame:
    """D-3 on decoded rows + B-2 missing items as NULL + H-10 timestamp parsing + A-21 stamps.

    Unknown item codes are dropped (B-8); per interval the first non-NULL value per item wins.
    """
    long = ok.select(
        parse_iso_utc("start_raw").alias("interval_start"), parse_iso_utc("end_raw").alias("interval_end"),
        _hub_column(ok, hub).alias("trading_hub"), "item", "value",
        F.struct("source_file", "line").alias("seq"))
    wide = pivot_prices(long.filter(F.col("item").isin(list(PRICE_ITEMS))))
    stamp_ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else instant_to_utc_ntz(F.current_timestamp())
    return wide.select("interval_start", "interval_end", "trading_hub", *PRICE_ITEMS.values(),
                       F.lit(market).alias("market"), F.lit(source_system).alias("source_system"),
                       stamp_ts.alias("loaded_at"))


def read_price_archives(spark: SparkSession, path: str, kind: str = "zip", **stamps) -> tuple[DataFrame, DataFrame]:
    """A-1 end to end: (raw.lmp_5min rows, quarantine rows). The decoded rows are a table: archives are opened once."""
    return prices_of(read_price_files(spark, path, kind), **stamps)


def prices_of(long: DataFrame, **stamps) -> tuple[DataFrame, DataFrame]:
    """``read_price_archives`` on long rows that are decoded already."""
    ok, bad = split_quarantine(materialise_frame(long, keep=True), stamps.get("hub"))
    return prices_from_long(ok, **stamps), bad


#: Files whose headers are broadcast at most; more are joined on the file.
BROADCAST_FILES = 100_000


def csv_fields(line) -> F.Column:
    """The fields of a CSV line as an array: cut at commas outside quotes, quotes removed, blank fields NULL."""
    line = F.col(line) if isinstance(line, str) else line
    outside = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    plain = F.split(line, ",", -1)
    quoted = F.transform(F.split(line, outside, -1), lambda x: F.replace(
        F.regexp_replace(x, '^\\s*"(.*)"\\s*$', "$1"), F.lit('""'), F.lit('"')))
    return F.transform(F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain), lambda x: F.nullif(F.trim(x), F.lit("")))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files under ``path`` that is not blank: source_file, start (of its block in the file), line, value,
    and the partition columns of the landing layout."""
    text = spark.read.option("recursiveFileLookup", False).text(path)
    name = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = text.select(name.alias("source_file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"),
                       *[F.col(c) for c in text.columns])
    return rows.filter(F.trim("value") != "")


def csv_headers(lines: DataFrame) -> DataFrame:
    """One row per file: the line of its header, its number of columns, and the place of every logical column (of
    candidates the first present, of names that repeat the first; NULL if there is none)."""
    first = lines.filter("start = 0").groupBy("source_file").agg(F.min_by("value", "line").alias("header"), F.min("line").alias("header_line"))
    names = F.transform(csv_fields(F.ltrim(F.col("header"), F.lit("\ufeff"))), lambda x: F.upper(F.trim(x)))
    first = first.withColumn("names", names)
    place = lambda cands: F.coalesce(*[F.nullif(F.array_position("names", c), F.lit(0)) for c in cands])
    return first.select("source_file", "header_line", F.size("names").alias("width"),
                        *[place(c).cast("int").alias(f"_{k}") for k, c in {**PRICE_CSV_CANDIDATES, "node": NODE_CANDIDATES}.items()])


def read_price_csv(spark: SparkSession, path: str, **stamps) -> tuple[DataFrame, DataFrame]:
    """A-2 for plain CSVs of any size: (raw.lmp_5min rows, quarantine rows).

    The landed text is read once, as splittable lines, into a table of lines. A file's header stands in its first
    block, so the headers come from a pruned read of that table; they are joined to the lines by file and each line's
    fields are taken by the places that its own file's header gives them. No list of files and no header passes
    the driver. Quarantined, with status and detail: files that lack a logical column (``missing_columns``), lines with
    more or fewer fields than their header (``ragged_row``), lines whose times can't be read (``bad_time``), and
    unknown hubs, as in A-1. Quoted fields may hold commas, not line ends. The line table stays until the folder of
    intermediate tables is cleared, since both results read it."""
    lines = materialise_frame(csv_lines(spark, path), keep=True)
    heads = materialise_frame(csv_headers(lines), keep=True)
    few = heads.count() <= BROADCAST_FILES
    logical = list(PRICE_CSV_CANDIDATES)
    lacking = F.array_compact(F.array(*[F.when(F.col(f"_{k}").isNull(), F.lit(k)) for k in logical]))
    rows = lines.join(F.broadcast(heads) if few else heads, "source_file").filter(
        (F.col("line") != F.col("header_line")) & (F.size(lacking) == 0)).withColumn("f", csv_fields("value"))
    whole = F.size("f") == F.col("width")
    at = lambda k: F.when(whole, F.get("f", F.col(f"_{k}") - 1))
    ok = rows.select(
        "source_file", F.when(whole, "ok").otherwise("ragged_row").alias("status"),
        F.when(~whole, F.substring("value", 1, 500)).alias("detail"), at("start").alias("start_raw"), at("end").alias("end_raw"),
        F.upper(at("item")).alias("item"), at("value").alias("value"), at("node").alias("node"), "line",
        *[F.col(c) for c in ("trading_hub",) if c in rows.columns])
    bad = heads.filter(F.size(lacking) > 0).select("source_file", F.lit("missing_columns").alias("status"), F.array_join(lacking, ",").alias("detail"))
    ok, rest = split_quarantine(ok, stamps.get("hub"))
    return prices_from_long(ok, **stamps), bad.unionByName(rest)
