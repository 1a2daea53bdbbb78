"""Ranked lexical search over bit-sliced Bloom signatures.

Index (``build``): documents are put into blocks of similar numbers of terms. A block is a bitmap with a row
(slice) for each signature bit and a column for each document. A document's term sets HASHES bits for each
level of LEVELS that its number of occurrences reaches, so the AND of a term's slices at a level tells which
documents may hold it so often; it can say yes wrongly, never no.

Search: a term's weight w and a document's length norm are known, and the score grows with the occurrences.
So for each level the sum of w over the terms whose slices say yes (the weighted slice sum), times what the
level may add at most, added up over the levels, is an upper bound of a document's score. Of the documents
with the highest bounds ``SEEDS`` a query are scored exactly; the k-th best of these scores is a lower bound of
the k-th best of all. Every document whose bound is not below that (with equal score: of no larger id) is
scored exactly from its text. Nothing else is left out, so ranks and scores are exact.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, with only A-Z lower-cased. All
integer arithmetic is 64-bit, weights come from doubles.

Queries are taken in blocks of at most about BLOCK_BYTES of text (a stated set against all documents): only a
block's distinct terms and their document counts pass the driver. Bounds and scores are rows.

Defined results: null or empty texts have no terms, are not counted and never found; a query without terms
finds nothing; rows with a null id count as documents and are never found; rows that repeat an id are documents of
their own and keep a place each; rows of queries that repeat an id must be told apart by the caller (they
share its places); other columns are ignored; empty tables give empty results. A document, a block of the index
and a block of queries must fit a task.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from market_engine.llm import hashing as H
from market_engine.llm.common import stored

#: Occurrences from which on a term is entered at a level.
LEVELS = (1, 2, 3, 5, 9, 17)
#: Bits that a term sets for a level, and signature bits for each of them in the fullest documents of a block.
HASHES, BITS = 3, 4
#: Documents of a block at most, and bits of its bitmap (a document that needs more is a block of its own).
BLOCK_DOCS, BLOCK_BITS = 4096, 1 << 24
#: Documents whose words are sorted together at most, as a power of two.
DOC_BITS = 16
#: Documents that are scored exactly to find a query's bound, for each place of its result.
SEEDS = 3
#: Bytes of query texts a block.
BLOCK_BYTES = 4 << 20
#: Ids of documents that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 100_000

#: Bytes to terms: separators become spaces, A-Z lower case.
TERM = np.where(np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]),
                H.ASCII_LOWER, 32).astype(np.uint8)
_TABLE = TERM.tobytes()
_INDEX = "width int, docs long, terms long, doc_ids array<long>, n binary, top binary, bits binary"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """HASHES numbers of 32 bits for each term at a level."""
    step = np.arange(1, HASHES + 1, dtype=np.uint64) + np.uint64(16 * level)
    with np.errstate(over="ignore"):
        return H.mix(hashes[:, None] + step[None, :] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _places(mixed: np.ndarray, width) -> np.ndarray:
    """Signature bits of numbers of 32 bits."""
    return ((mixed * width) >> np.uint64(32)).astype(np.int64)


class _Band:
    """Documents of one block that is being filled."""

    def __init__(self, width: int):
        self.width, self.size = width, 0
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BITS // width // 8 * 8))
        self.parts: list[tuple] = []

    def add(self, ids, n, top, column, places):
        """Blocks that are full after the documents; ``column`` numbers them, for each of ``places``."""
        done, a = [], 0
        while a < len(ids):
            b = min(len(ids), a + self.room - self.size)
            own = slice(*np.searchsorted(column, [a, b]))
            self.parts.append((ids[a:b], n[a:b], top[a:b], column[own] - a + self.size, places[own]))
            self.size += b - a
            if self.size == self.room:
                done.append(self.row())
                self.parts, self.size = [], 0
            a = b
        return done

    def row(self) -> tuple:
        columns = -(-self.size // 8) * 8
        ids, n, top, column, places = (np.concatenate(x) for x in zip(*self.parts))
        whole = np.zeros(self.width * columns, bool)
        whole[places * columns + column[:, None]] = True
        packed = np.packbits(whole.reshape(self.width, columns), axis=1, bitorder="little")
        return self.width, None, None, ids, n.tobytes(), top.tobytes(), packed.tobytes()


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in _INDEX.split(", ")])


def _build(batches):
    bands: dict[int, _Band] = {}
    for whole in batches:
        for k in range(0, whole.num_rows, 1 << DOC_BITS):
            batch = whole.slice(k, 1 << DOC_BITS)
            ids, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            data, offsets = H.text_bytes(batch.column(1))
            for i, j in H.doc_groups(offsets):
                own = TERM[data[offsets[i]:offsets[j]]]
                starts, ends, first = H.word_places(own, offsets[i:j + 1] - offsets[i])
                n = np.diff(first)
                yield _index_batch([(0, int((n > 0).sum()), int(n.sum()), None, None, None, None)])
                rows = [row for width, *part in _signatures(H.word_hashes(own, starts, ends), n, ids[i:j], null[i:j])
                        for row in bands.setdefault(width, _Band(width)).add(*part)]
                if rows:
                    yield _index_batch(rows)
    for band in bands.values():
        if band.size:
            yield _index_batch([band.row()])


def _signatures(hashes: np.ndarray, n: np.ndarray, ids: np.ndarray, null: np.ndarray):
    """(width, ids, n, top, column, places) of the documents of each width; hashes of a group's words, n a document."""
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    rows = np.sort((doc << np.uint64(64 - DOC_BITS)) | _name(hashes))
    if not len(rows):
        return
    head = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    tf, rows = np.diff(np.append(head, len(rows))), rows[head]
    doc = (rows >> np.uint64(64 - DOC_BITS)).astype(np.int64)
    name = rows & np.uint64((1 << 64 - DOC_BITS) - 1)
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, doc, tf)
    at, mixed = [], []
    for level, least in enumerate(LEVELS):
        held = np.flatnonzero(tf >= least)
        at.append(doc[held])
        mixed.append(_mixed(name[held], level))
    at, mixed = np.concatenate(at), np.concatenate(mixed)
    keys = np.bincount(at, minlength=len(n))
    width = np.int64(HASHES * BITS) << np.ceil(np.log2(np.maximum(keys, 1))).astype(np.int64)
    width[(keys == 0) | null] = 0
    order = np.argsort(at, kind="stable")
    at, mixed = at[order], mixed[order]
    for w in np.unique(width[width > 0]):
        docs = width == w
        use = docs[at]
        yield int(w), ids[docs], n[docs].astype(np.int64), top[docs], (np.cumsum(docs) - 1)[at[use]], _places(mixed[use], np.uint64(w))


def _name(hashes: np.ndarray) -> np.ndarray:
    """What is kept of a term's hash; terms that share it are only found too often."""
    return hashes >> np.uint64(DOC_BITS)


def build(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: blocks, and rows of width 0 with numbers of documents and terms."""
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter(
        "text is not null").mapInArrow(_build, _INDEX)


@dataclass
class Queries:
    """A block of queries: its distinct terms with their weights, and the terms of each query."""

    terms: list[bytes]
    weight: np.ndarray
    of: list[np.ndarray]
    docs: int
    total: int

    def __post_init__(self):
        lens = np.array([len(t) for t in self.terms], np.int64)
        data = np.frombuffer(b" ".join(self.terms), np.uint8)
        ends = np.cumsum(lens) + np.arange(len(lens))
        names = _name(H.word_hashes(data, ends - lens, ends))
        self.mixed = [_mixed(names, level) for level in range(len(LEVELS))]
        self.used = np.concatenate(self.of)
        self.by = np.repeat(np.arange(len(self.of)), [len(ts) for ts in self.of])

    def norm(self, n):
        """A document's m from its number of terms."""
        return 10 + (90 * n * self.docs) // max(1, self.total)

    def bounds(self, width: int, n: np.ndarray, top: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Upper bounds (query, document) of a block's scores."""
        slices = bits.reshape(width, -1)
        m = self.norm(n)
        out = np.zeros((len(self.of), len(n)), np.int64)
        yes, before = None, np.zeros(len(n), np.int64)
        on = np.arange(len(self.terms))
        for level in range(len(LEVELS)):
            most = np.minimum(top, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else top
            adds = (1_000_000_000 * most) // (1000 * most + 8 * m)
            adds, before = np.maximum(adds - before, 0), np.maximum(adds, before)
            found = np.empty((len(on), slices.shape[1]), np.uint8)
            for a in range(0, len(on), 512):
                found[a:a + 512] = np.bitwise_and.reduce(slices[_places(self.mixed[level][on[a:a + 512]], np.uint64(width))], axis=1)
            yes = found if yes is None else yes & found
            some = yes.any(axis=1)
            on, yes = on[some], yes[some]
            if not len(on):
                break
            row = np.full(len(self.terms), -1)
            row[on] = np.arange(len(on))
            use = np.flatnonzero(row[self.used] >= 0)
            head = np.flatnonzero(np.append(True, np.diff(self.by[use]) != 0))
            for c in range(0, slices.shape[1], 32):  # 256 documents at a time
                said = np.unpackbits(yes[:, c:c + 32], axis=1, bitorder="little")[row[self.used[use]]]
                sums = np.add.reduceat(said * self.weight[self.used[use]][:, None], head, axis=0)
                docs = slice(8 * c, min(8 * c + 256, len(n)))
                out[self.by[use[head]], docs] += sums[:, :docs.stop - docs.start] * adds[None, docs]
        return out

    def score(self, text: str | None, wanted: list[int]) -> list[int]:
        """Exact scores of a text for the queries ``wanted``."""
        words = terms_of(text)
        m, tf = self.norm(len(words)), Counter(words)
        known: dict[int, int] = {}
        out = []
        for q in wanted:
            s = 0
            for t in self.of[q]:
                if t not in known:
                    k = tf.get(self.terms[t], 0)
                    known[t] = int(self.weight[t]) * ((1_000_000_000 * k) // (1000 * k + 8 * m))
                s += known[t]
            out.append(s)
        return out


def _blocks(batches):
    for batch in batches:
        for width, ids, n, top, bits in zip(*(batch.column(i) for i in range(5))):
            yield (width.as_py(), ids.values.to_numpy(), *(np.frombuffer(x.as_buffer(), np.int64) for x in (n, top)),
                   np.frombuffer(bits.as_buffer(), np.uint8))


_FOUND = "query int, doc_id long, bound long"


def _found_batch(query, ids, bound):
    return pa.record_batch([pa.array(query, pa.int32()), pa.array(ids, pa.int64()), pa.array(bound, pa.int64())], names=["query", "doc_id", "bound"])


def _best(queries: Queries, k: int):
    """The k highest bounds of each query in a task's blocks."""
    def work(batches):
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.of]
        for width, ids, n, top, bits in _blocks(batches):
            bounds = queries.bounds(width, n, top, bits)
            for q in range(len(queries.of)):
                at = np.flatnonzero(bounds[q] > (best[q][0].min() if len(best[q][0]) >= k else 0))
                if len(at):
                    b, d = np.append(best[q][0], bounds[q][at]), np.append(best[q][1], ids[at])
                    order = np.lexsort((d, -b))[:k]
                    best[q] = b[order], d[order]
        for q, (b, d) in enumerate(best):
            if len(b):
                yield _found_batch(np.full(len(b), q), d, b)
    return work


def _not_excluded(queries: Queries, least: np.ndarray, last: np.ndarray):
    """Documents whose bound is over a query's least score, or equal to it and of an id of at most ``last``."""
    def work(batches):
        for width, ids, n, top, bits in _blocks(batches):
            bounds = queries.bounds(width, n, top, bits)
            q, d = np.nonzero((bounds > least[:, None]) | (bounds == least[:, None]) & (ids[None, :] <= last[:, None]) & (bounds > 0))
            for a in range(0, len(q), 1 << 18):
                own = slice(a, a + (1 << 18))
                yield _found_batch(q[own], ids[d[own]], bounds[q[own], d[own]])
    return work


def _scores(queries: Queries):
    def work(batches):
        for batch in batches:
            rows = []
            for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                rows += [(q, doc, s) for q, s in zip(wanted, queries.score(text.as_py(), wanted)) if s > 0]
            if rows:
                q, d, s = zip(*rows)
                yield _found_batch(q, d, s)
    return work


def exact(docs: DataFrame, found: DataFrame, queries: Queries) -> DataFrame:
    """(query, doc_id, score) of the pairs ``found`` whose score is above 0."""
    wanted = stored(found.groupBy("doc_id").agg(F.collect_set("query").alias("wanted")), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    rows = docs.filter("text is not null").join(F.broadcast(wanted) if few else wanted, "doc_id")
    return rows.select("doc_id", "text", "wanted").mapInArrow(_scores(queries), _FOUND).withColumnRenamed("bound", "score")


def _term_counts(terms: frozenset):
    def work(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(terms.intersection(terms_of(text.as_py())))
        if held:
            yield pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["term", "df"])
    return work


def query_blocks(queries: DataFrame, item_id: str, text: str):
    """Lists of (item, terms) of at most about BLOCK_BYTES of text each, in the order of a hash of the id."""
    q = queries.select(F.col(item_id).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = 1 + (q.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
    number = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for i in range(parts):
        rows = q if parts == 1 else q.filter(number == i)
        yield [(r.item, list(dict.fromkeys(terms_of(r.text)))) for r in rows.toLocalIterator()]


def search(documents: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", index: DataFrame | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 of every query."""
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    index = stored(build(docs), "bloom-index") if index is None else index
    counted = index.filter("width = 0").agg(F.sum("docs").alias("n"), F.sum("terms").alias("l")).first()
    blocks = index.filter("width > 0").select("width", "doc_ids", "n", "top", "bits")
    item = queries.select(F.col(item_id)).schema[0].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item}, rank int, doc_id long, score long")
    for asked in query_blocks(queries, item_id, item_text):
        asked = [(i, ts) for i, ts in asked if ts]
        terms = list(dict.fromkeys(t for _, ts in asked for t in ts))
        if not terms or not counted.n:
            continue
        df = docs.filter("text is not null").select("text").mapInArrow(_term_counts(frozenset(terms)), "term binary, df long")
        df = {bytes(r.term): r.df for r in df.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()}
        weight = np.array([math.floor(1000 * math.log((2 * counted.n + 2) / (2 * df.get(t, 0) + 1))) for t in terms], np.int64)
        number = {t: x for x, t in enumerate(terms)}
        block = Queries(terms, weight, [np.array([number[t] for t in ts], np.int64) for _, ts in asked], counted.n, counted.l)

        by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id")
        seeds = blocks.mapInArrow(_best(block, SEEDS * k), _FOUND).withColumn("place", F.row_number().over(by_bound)).filter(
            F.col("place") <= SEEDS * k)
        by_score = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        place = F.row_number().over(by_score).alias("rank")
        least, last = np.zeros(len(asked), np.int64), np.full(len(asked), np.iinfo(np.int64).max)
        for r in exact(docs, seeds, block).select("*", place).filter(F.col("rank") == k).toLocalIterator():
            least[r.query], last[r.query] = r.score, r.doc_id
        left = blocks.mapInArrow(_not_excluded(block, least, last), _FOUND)
        items = spark.createDataFrame([(x, i) for x, (i, _) in enumerate(asked)], f"query int, item_id {item}")
        top = exact(docs, left, block).select("*", place).filter(F.col("rank") <= k)
        out = out.unionByName(stored(top.join(items, "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
    return out
