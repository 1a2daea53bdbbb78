"""Substring dedup on a compacted De Bruijn graph of word windows.

The edges of the graph are all windows of ``size`` (50) consecutive words. Consecutive windows that
share their minimizer (the leftmost smallest hash of k words inside) form one run, and a run is
written once: its key is a 128-bit digest (BLAKE2b) of all its words, with its coordinates (document, first
window, number of windows) and the digests of the runs before and after it. Equal windows have equal
minimizers at equal places, so:

1. Runs are grouped by digest (summed per batch first, so a passage that a third of all documents
   share is one row a batch): the coordinates of the first document, the last document, and whether the
   run has one neighbour on either side.
2. A minimizer of one run alone does not branch: that run's windows occur nowhere else. Links between
   such runs with one neighbour on both sides are joined through their source coordinates, and
   nonbranching paths compact to one row each, found by its first run.
3. A minimizer with several runs branches. The windows of its distinct runs are read at their source
   coordinates, grouped by digest, and joined back: the first document of each window.
4. Path heads and branching runs are joined with the runs of all documents. Windows whose first
   document has a smaller id give the word ranges to remove; ranges of a document are merged and cut
   from its text.

What is compared before a cut are the words: each run's and window's key is a cryptographic digest of its words,
made from the text at its coordinates, in the source as in the document that loses them. Hashes of words only
choose minimizers; words that share one make a minimizer branch, no more.

Defined results: windows are judged on the input. A null text has no words; a text of fewer than
``size`` words keeps all. Rows that repeat a doc_id are no earlier than each other and each gets its
own result; rows with a null id keep everything and are no source. Any further columns are ignored;
empty tables give empty tables. No group is gathered in one task but the runs of one document.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from market_engine.llm import hashing as H
from market_engine.llm.common import stored
from market_engine.llm.packing import pack, unpack

#: Words of a minimizer.
MINIMIZER = 12
_RUN = "minimizer long, k1 long, k2 long, doc_id long, text_key long, start int, n int"
_EDGE = _RUN + ", last long, prev long, next long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _runs_of(words: np.ndarray, first: np.ndarray, spans: H.Spans, size: int):
    """Arrays (text, start, n, minimizer, k1, k2, prev, next) of the runs of a group of texts."""
    grams = H.Sequences(words, 1).all(MINIMIZER)
    at = H.sliding_argmin(grams, size - MINIMIZER + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:len(at)]
    inside = np.arange(len(at)) + size <= first[text + 1]
    s = np.flatnonzero(inside)
    if not len(s):
        return None
    at, text = at[s], text[s]
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(s)))
    lo, doc = s[head], text[head]
    hi = lo + n - 1 + size
    k1, k2 = spans.digests(lo, hi).T
    same = doc[1:] == doc[:-1]
    prev, nxt = np.zeros_like(k1), np.zeros_like(k1)
    prev[1:][same] = k1[:-1][same]
    nxt[:-1][same] = k1[1:][same]
    return doc, lo - first[doc], n, grams[at[head]], k1, k2, prev, nxt


def _runs(size: int, summed: bool):
    """Runs of documents (doc_id, text_key, text): all of them, or each distinct one of a batch once."""
    def work(batches):
        for batch in batches:
            data, offsets = H.text_bytes(batch.column(2))
            parts = []
            for i, j in H.doc_groups(offsets):
                own = data[offsets[i]:offsets[j]]
                starts, ends, first = H.word_places(own, offsets[i:j + 1] - offsets[i])
                got = _runs_of(H.word_hashes(own, starts, ends), first, H.Spans(own, starts, ends), size)
                if got is not None:
                    parts.append((got[0] + i, *got[1:]))
            if not parts:
                continue
            row, start, n, minimizer, k1, k2, prev, nxt = (np.concatenate(x) for x in zip(*parts))
            ids = batch.column(0).to_numpy(zero_copy_only=False)[row]
            key = batch.column(1).to_numpy(zero_copy_only=False)[row]
            columns = [minimizer, k1, k2, ids, key, start.astype(np.int32), n.astype(np.int32)]
            names = ["minimizer", "k1", "k2", "doc_id", "text_key", "start", "n"]
            if summed:
                order = np.lexsort((start, key, ids, k2, k1))
                a, b = k1[order], k2[order]
                head = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                columns = [c[order[head]] for c in columns] + [np.maximum.reduceat(ids[order], head)]
                for side in (prev[order], nxt[order]):
                    lo, hi = np.minimum.reduceat(side, head), np.maximum.reduceat(side, head)
                    columns.append(np.where(lo == hi, lo, np.uint64(0)))
                names += ["last", "prev", "next"]
            yield pa.record_batch([_signed(c) if c.dtype == np.uint64 else pa.array(c) for c in columns], names=names)
    return work


def _windows(size: int):
    """Digests of the windows of given runs: rows (k1, k2, i, w1, w2, doc_id, last)."""
    def work(batches):
        for batch in batches:
            data, offsets = H.text_bytes(unpack(batch.column(1)))
            wanted = batch.column(2).to_pylist()
            for i, j in H.doc_groups(offsets):
                own = data[offsets[i]:offsets[j]]
                starts, ends, first = H.word_places(own, offsets[i:j + 1] - offsets[i])
                rows = [(d, r["start"] + first[d - i], r["n"], r["k1"], r["k2"], r["last"]) for d in range(i, j) for r in wanted[d]]
                doc, lo, n, k1, k2, last = (np.array(x, np.int64) for x in zip(*rows))
                at = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                s = lo[at] + step
                w1, w2 = H.Spans(own, starts, ends).digests(s, s + size).T
                yield pa.record_batch(
                    [pa.array(k1[at]), pa.array(k2[at]), pa.array(step.astype(np.int32)),
                     _signed(np.ascontiguousarray(w1)), _signed(np.ascontiguousarray(w2)),
                     batch.column(0).take(pa.array(doc[at])), pa.array(last[at])],
                    names=["k1", "k2", "i", "w1", "w2", "doc_id", "last"])
    return work


def _cut(with_text: bool):
    """The columns before the last two (packed, ranges), plus n_words, n_removed, kept and the text itself."""
    def work(batches):
        for batch in batches:
            texts = unpack(batch.column(batch.num_columns - 2))
            out = []
            for text, ranges in zip(texts.to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                words = (text or "").encode().split()
                n, end, kept = len(words), 0, []
                for r in ranges or ():
                    kept += words[end:r["a"]] if r["a"] > end else []
                    end = max(end, r["b"])
                kept = kept + words[end:] if ranges else words
                out.append((n, n - len(kept), b" ".join(kept).decode()))
            n, removed, kept = zip(*out) if out else ((), (), ())
            new = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), *[texts] * with_text]
            yield pa.record_batch([*batch.columns[:-2], *new],
                                  names=[*batch.schema.names[:-2], "n_words", "n_removed", "kept", *["_text"] * with_text])
    return work


def _keyed(documents: DataFrame, doc_id: str, text: str) -> list:
    """Document id and a key that tells different texts of one id apart."""
    return [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text")]


def runs(docs: DataFrame, size: int = 50, summed: bool = False) -> DataFrame:
    """Runs of (doc_id, text_key, text) rows; ``summed``: distinct ones of a batch, with last, prev, next."""
    whole = docs.filter("doc_id is not null and text is not null")
    return whole.mapInArrow(_runs(size, summed), _EDGE if summed else _RUN)


def edges(docs: DataFrame, size: int = 50) -> DataFrame:
    """Distinct runs that occur in several documents or whose minimizer has several runs, with source
    coordinates, the last document, their one neighbour on either side (0: none or several) and
    ``branching``. One exchange, by minimizer; what comes into it is summed per batch of documents."""
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.lit(0).cast("long")).alias(c)
    distinct = runs(docs, size, summed=True).repartition("minimizer").groupBy("minimizer", "k1", "k2").agg(
        F.min(F.struct("doc_id", "text_key", "start", "n")).alias("src"), F.max("last").alias("last"), one("prev"), one("next"))
    same = Window.partitionBy("minimizer")
    known = distinct.withColumns({"runs": F.count(F.lit(1)).over(same), "lo": F.min("src.doc_id").over(same),
                                  "hi": F.max("last").over(same)}).filter("lo < hi")
    return known.select("k1", "k2", "src.*", "last", "prev", "next", (F.col("runs") > 1).alias("branching"))


def paths(edge: DataFrame) -> DataFrame:
    """Nonbranching paths, one row each: key of the first run, source document and windows of the path."""
    plain = edge.filter(~F.col("branching") & (F.col("doc_id") < F.col("last")))
    after = plain.select(F.col("doc_id"), F.col("text_key"), F.col("start").alias("at"), F.col("k1").alias("next_k1"),
                         F.col("prev").alias("next_prev"))
    linked = plain.withColumn("at", F.col("start") + F.col("n")).join(after, ["doc_id", "text_key", "at"], "left")
    linked = linked.select("k1", "k2", "doc_id", "text_key", "start", "n", (
        (F.col("next") == F.col("next_k1")) & (F.col("next_prev") == F.col("k1"))).alias("goes_on"))
    in_doc = Window.partitionBy("doc_id", "text_key").orderBy("start")
    head = ~F.coalesce(F.lag("goes_on").over(in_doc), F.lit(False))
    number = F.sum(head.cast("int")).over(in_doc)
    numbered = linked.withColumn("head", head).withColumn("path", number)
    return numbered.groupBy("doc_id", "text_key", "path").agg(
        F.max(F.when(F.col("head"), F.col("k1"))).alias("k1"), F.max(F.when(F.col("head"), F.col("k2"))).alias("k2"),
        F.sum("n").alias("n")).select("k1", "k2", F.col("doc_id").alias("first_doc"), F.col("n").cast("int").alias("n"))


def window_owners(edge: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Rows (k1, k2, owners) for branching runs: the first document of each of their windows, where it is
    not the only one. Of a repeated row one copy is read, so each window of a run is there once."""
    wanted = edge.filter("branching").groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", "n", "k1", "k2", "last")).alias("runs"))
    source = pack(docs).join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    win = source.select("doc_id", "packed", "runs").mapInArrow(
        _windows(size), "k1 long, k2 long, i int, w1 long, w2 long, doc_id long, last long")
    first = win.groupBy("w1", "w2").agg(F.min("doc_id").alias("owner"), F.max("last").alias("hi")).filter("owner < hi")
    return win.drop("doc_id").join(first.drop("hi"), ["w1", "w2"]).filter("owner < last").groupBy("k1", "k2").agg(
        F.map_from_entries(F.collect_list(F.struct("i", "owner"))).alias("owners"))


def ranges(docs: DataFrame, size: int = 50) -> DataFrame:
    """Rows (doc_id, text_key, ranges): word ranges [a, b) of each document to remove, sorted by a."""
    edge = stored(edges(docs, size), "edges")
    plain = paths(edge).select("k1", "k2", "n", "first_doc", F.lit(None).cast("map<int,bigint>").alias("owners"))
    split = window_owners(edge, docs, size).select(
        "k1", "k2", F.lit(None).cast("int").alias("n"), F.lit(None).cast("long").alias("first_doc"), "owners")
    known = stored(plain.unionByName(split).withColumnRenamed("n", "path_n"), "paths")
    seen = runs(docs, size).select("doc_id", "text_key", "start", "k1", "k2").join(known, ["k1", "k2"])
    whole = F.when(F.col("first_doc") < F.col("doc_id"), F.array(F.struct(
        F.col("start").alias("a"), (F.col("start") + F.col("path_n") - 1 + size).alias("b"))))
    single = F.transform(F.filter(F.map_entries("owners"), lambda e: e["value"] < F.col("doc_id")), lambda e: F.struct(
        (F.col("start") + e["key"]).alias("a"), (F.col("start") + e["key"] + size).alias("b")))
    return seen.select("doc_id", "text_key", F.explode(F.coalesce(whole, single)).alias("r")).groupBy(
        "doc_id", "text_key").agg(F.sort_array(F.collect_set("r")).alias("ranges"))


def remove_repeats(documents: DataFrame, size: int = 50, doc_id: str = "doc_id", text: str = "text",
                   carry: Sequence[str] | None = None) -> DataFrame:
    """One row per document: the columns named in ``carry`` (default all; those named like a new one are
    replaced) plus n_words, n_removed, kept (the kept words joined by one space)."""
    new = ["n_words", "n_removed", "kept"]
    carry = [c for c in (documents.columns if carry is None else carry) if c not in new]
    docs = documents.select(*_keyed(documents, doc_id, text))
    row = F.struct(*[F.col(f"`{c}`") for c in carry if c != text], F.lit(0).alias("_")).alias("_row")
    rows = pack(documents.select(row, *_keyed(documents, doc_id, text)))
    rows = rows.join(ranges(docs, size), ["doc_id", "text_key"], "left").select("_row", "packed", "ranges")
    schema = rows.select("_row").schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    if text in carry:
        schema = schema.add("_text", "string")
    out = rows.mapInArrow(_cut(text in carry), schema)
    return out.select(*[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`") for c in carry], *new)


def rewrite(documents: DataFrame, size: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with the repeated ranges cut from ``text``; a text that loses nothing stays as it is.
    ``n_chars``, where there is one, follows the text."""
    out = remove_repeats(documents, size, doc_id, text)
    after = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(f"`{text}`"))
    chars = F.when(F.col("n_removed") > 0, F.char_length("kept")).otherwise(F.col("n_chars")) if "n_chars" in documents.columns else None
    return out.select(*[after.alias(c) if c == text else chars.cast(documents.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in documents.columns if c in out.columns])
