"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

A document's features x are the buckets of its lower-cased words (damped counts, of length 1 together), ratios
that describe its structure (``STATS``) and given metadata columns: numbers damped, strings hashed. Its score is

    sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j),

where the pairs are never formed: with rank-r vectors v their sum is 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i
(v_if x_i)^2), linear in the number of features.

``fit`` learns b, w and v by mini-batches of logistic loss on a bounded sample of labelled rows: the ``sample``
(8,000) rows with the smallest hash of their id. Their features are made in parallel, the fit is one task, and
the model (a few hundred KB, fixed by BUCKETS and RANK) goes to the tasks that score all documents.

Defined results: null and empty texts have no words and all ratios 0, and get the score that this means; null
metadata are no feature; rows that repeat an id or a text get equal scores; labels that are null or contradict
each other are left out; without any label every score is 0.5; other columns pass through, one named
``score`` is replaced; an empty table stays empty. A long text is read to its end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.llm import hashing as H
from market_engine.llm.common import stored

#: Word buckets (a power of two), buckets of metadata strings, and length of the pair vectors.
BUCKETS, META, RANK = 1 << 13, 256, 8
#: Kinds of bytes that the ratios count.
KINDS = {"letter": b"abcdefghijklmnopqrstuvwxyz", "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:",
         "mark": b"!?", "symbol": b"#*$%&|<>@^~_=+{}[]\\/", "line": b"\n", "wide": bytes(range(128, 256))}
STATS = ("bytes", "words", "word_length", *KINDS, "distinct", "again", "short")
_KIND = np.zeros(256, np.uint8)
for _i, _c in enumerate(KINDS.values()):
    _KIND[list(_c)] = _i + 1
_ROW = "hash long, label double, at array<int>, x array<float>"


def _ratio(a, b):
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _text_features(data: np.ndarray, offsets: np.ndarray):
    """(document, feature, value) of the words, and the table of the ratios."""
    n = len(offsets) - 1
    low = H.ASCII_LOWER[data]
    starts, ends, first = H.word_places(low, offsets)
    hashes = H.word_hashes(low, starts, ends)
    words, size = np.diff(first), np.diff(offsets)
    of = np.repeat(np.arange(n), words)
    kinds = np.bincount(np.repeat(np.arange(n), size) * (len(KINDS) + 1) + _KIND[data], minlength=n * (len(KINDS) + 1)).reshape(n, -1)[:, 1:]
    again = np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=n)
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(of[order], kind="stable")]
    h, d = hashes[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    key = d * BUCKETS + (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    x = np.log1p(np.diff(np.append(head, len(key))))
    doc = key[head] // BUCKETS
    x /= np.sqrt(np.bincount(doc, x * x, minlength=n))[doc]
    length = (ends - starts).astype(float)
    stats = np.column_stack([
        np.log1p(size) / 20, np.log1p(words) / 20, _ratio(np.bincount(of, length, minlength=n), words) / 20,
        *(_ratio(kinds[:, k], size) for k in range(len(KINDS))), _ratio(np.bincount(d[new], minlength=n), words),
        _ratio(again, words), _ratio(np.bincount(of[length == 1], minlength=n), words)])
    return doc, key[head] % BUCKETS, x, stats


def _meta_features(columns: list[pa.Array], names: Sequence[str]):
    """(document, feature, value) of the metadata columns."""
    for i, (column, name) in enumerate(zip(columns, names)):
        rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        kept = column.drop_null()
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            said = pa.array([f"{name}={v}" for v in kept.to_pylist()], pa.string())
            data, offsets = H.text_bytes(said)
            h = H.word_hashes(data, offsets[:-1], offsets[1:]) if len(said) else np.zeros(0, np.uint64)
            yield rows, BUCKETS + len(STATS) + len(names) + (h % np.uint64(META)).astype(np.int64), np.ones(len(rows))
        else:
            x = kept.cast(pa.float64()).to_numpy()
            yield rows, np.full(len(rows), BUCKETS + len(STATS) + i), np.sign(x) * np.log1p(np.abs(x)) / 20


def size_of(names: Sequence[str]) -> int:
    return BUCKETS + len(STATS) + len(names) + META


def features(batch: pa.RecordBatch, names: Sequence[str]):
    """Yields (first row, row after the last, starts, feature, value) for groups of a batch's rows: the text is its last
    column but the ``names``, which are the last ones."""
    k = batch.num_columns - len(names)
    data, offsets = H.text_bytes(batch.column(k - 1))
    for i, j in H.doc_groups(offsets):
        doc, at, x, stats = _text_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        meta = list(_meta_features([batch.column(k + c).slice(i, j - i) for c in range(len(names))], names))
        doc = np.concatenate([doc, np.repeat(np.arange(j - i), len(STATS)), *(m[0] for m in meta)])
        at = np.concatenate([at, np.tile(BUCKETS + np.arange(len(STATS)), j - i), *(m[1] for m in meta)])
        x = np.concatenate([x, stats.ravel(), *(m[2] for m in meta)])
        order = np.argsort(doc, kind="stable")
        yield i, j, np.searchsorted(doc[order], np.arange(j - i + 1)), at[order], x[order].astype(np.float32)


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    pair: np.ndarray

    def margin(self, starts: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """b + linear part + pairs of every row; rows have at least one feature."""
        vx = self.pair[at] * x[:, None]
        total = np.add.reduceat(vx, starts[:-1], axis=0, dtype=np.float64)
        squares = np.add.reduceat(vx * vx, starts[:-1], axis=0, dtype=np.float64)
        return self.bias + np.add.reduceat(self.weight[at] * x, starts[:-1], dtype=np.float64) + (total * total - squares).sum(axis=1) / 2


def learn(starts: np.ndarray, at: np.ndarray, x: np.ndarray, label: np.ndarray, size: int, steps: int = 600, rows: int = 128,
          rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> Model:
    """Mini-batches of logistic loss with Adam steps; equal input gives an equal model."""
    rng = np.random.default_rng(seed)
    p = np.zeros((size + 1, RANK + 1))  # the last row holds the bias; column 0 the weights, the others the pair vectors
    p[:-1, 1:] = rng.normal(0, 0.05, (size, RANK))
    m, v, queue = np.zeros_like(p), np.zeros_like(p), np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(queue) < rows:
            queue = np.append(queue, rng.permutation(len(label)))
        own, queue = queue[:rows], queue[rows:]
        n = starts[own + 1] - starts[own]
        where = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        i, xi = at[where], x[where].astype(float)
        model = Model(p[-1, 0], p[:-1, 0], p[:-1, 1:])
        begin = np.append(0, np.cumsum(n))
        wrong = 1 / (1 + np.exp(-np.clip(model.margin(begin, i, xi), -30, 30))) - label[own]
        vx = model.pair[i] * xi[:, None]
        total = np.add.reduceat(vx, begin[:-1], axis=0)
        row = np.repeat(np.arange(rows), n)
        part = np.column_stack([xi, xi[:, None] * (total[row] - vx)]) * wrong[row][:, None] / rows
        grad = decay * p
        grad[-1] = 0
        np.add.at(grad, i, part)
        grad[-1, 0] = wrong.mean()
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        p -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(float(p[-1, 0]), p[:-1, 0].astype(np.float32), p[:-1, 1:].astype(np.float32))


def _feature_rows(names: tuple[str, ...]):
    def work(batches):
        for batch in batches:
            for i, j, starts, at, x in features(batch, names):
                at_rows, x_rows = (pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(c, t)) for c, t in ((at, pa.int32()), (x, pa.float32())))
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in (0, 1)), at_rows, x_rows], names=["hash", "label", "at", "x"])
    return work


def _learn_task(size: int):
    def work(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        t = pa.Table.from_batches(rows).combine_chunks()
        label, at, x = t.column(1).to_numpy(), t.column(2).chunk(0), t.column(3).chunk(0)
        starts = at.offsets.to_numpy().astype(np.int64)
        model = learn(starts, at.values.to_numpy(), x.values.to_numpy(), label, size)
        yield pa.record_batch([pa.array([model.bias]), pa.array([model.weight.tobytes()]), pa.array([model.pair.tobytes()])],
                              names=["bias", "weight", "pair"])
    return work


def _inputs(documents: DataFrame, text: str, metadata: Sequence[str]) -> list[Column]:
    numbers = [F.col(f"`{c}`").alias(f"_m{i}") if t == "string" else F.col(f"`{c}`").cast("double").alias(f"_m{i}")
               for i, (c, t) in enumerate((c, documents.schema[c].dataType.simpleString()) for c in metadata)]
    return [F.col(f"`{text}`").alias("_text"), *numbers]


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 8000, doc_id: str = "doc_id", text: str = "text",
        metadata: Sequence[str] = ()) -> Model | None:
    """A model of ``label`` (1 or 0) from at most ``sample`` labelled rows; None where there are none."""
    one = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(
        F.min(label).alias("lo"), F.max(label).alias("hi")).filter("lo = hi")
    chosen = one.select("_id", F.col("lo").cast("double").alias("_label"), F.xxhash64("_id").alias("_h")).orderBy("_h", "_id").limit(sample)
    rows = documents.join(F.broadcast(chosen), F.col(f"`{doc_id}`") == F.col("_id"))  # at most ``sample`` ids
    names = tuple(metadata)
    made = rows.select(F.col("_h").alias("hash"), F.col("_label").alias("label"), *_inputs(documents, text, metadata)).mapInArrow(
        _feature_rows(names), _ROW)
    known = stored(made.distinct(), "labelled").orderBy("hash", "at", "x").limit(sample).mapInArrow(
        _learn_task(size_of(names)), "bias double, weight binary, pair binary").first()  # one row of a fixed size
    if known is None:
        return None
    return Model(known.bias, np.frombuffer(known.weight, np.float32), np.frombuffer(known["pair"], np.float32).reshape(-1, RANK))


def _scored(model: Model | None, names: tuple[str, ...]):
    def work(batches):
        for batch in batches:
            keep = batch.columns[:batch.num_columns - 1 - len(names)]
            kept_names = [*batch.schema.names[:len(keep)], "score"]
            if model is None:
                yield pa.record_batch([*keep, pa.array(np.full(batch.num_rows, 0.5))], names=kept_names)
                continue
            for i, j, starts, at, x in features(batch, names):
                score = 1 / (1 + np.exp(-np.clip(model.margin(starts, at, x), -30, 30)))
                yield pa.record_batch([*(c.slice(i, j - i) for c in keep), pa.array(np.round(score, 9))], names=kept_names)
    return work


def score(documents: DataFrame, model: Model | None, text: str = "text", metadata: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) of every document, with its ``score``: the probability of label 1."""
    keep = [c for c in (documents.columns if keep is None else keep) if c != "score"]
    kept = documents.select(*[F.col(f"`{c}`") for c in keep])
    rows = documents.select(*[F.col(f"`{c}`") for c in keep], *_inputs(documents, text, metadata))
    return rows.mapInArrow(_scored(model, tuple(metadata)), kept.schema.add("score", "double"))
