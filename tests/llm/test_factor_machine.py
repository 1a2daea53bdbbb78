"""The factorisation machine: pairs against the plain double sum, features against plain counts, held-out accuracy."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF01

from market_engine.llm import factor_machine as M
from market_engine.llm import queries
from market_engine.llm.common import table


def test_pairs_against_the_double_sum():
    rng = np.random.default_rng(3)
    model = M.Model(0.3, rng.normal(size=50), rng.normal(size=(50, M.RANK)))
    rows = [[(int(i), float(rng.normal())) for i in rng.choice(50, n, replace=False)] for n in (1, 2, 9, 30)]
    starts = np.cumsum([0, *map(len, rows)])
    at, x = (np.array([f[k] for r in rows for f in r]) for k in (0, 1))
    want = [0.3 + sum(model.weight[i] * v for i, v in r)
            + sum(model.pair[r[a][0]] @ model.pair[r[b][0]] * r[a][1] * r[b][1] for a in range(len(r)) for b in range(a))
            for r in rows]
    assert np.allclose(model.margin(starts, at, x), want)


def test_gradient_lowers_the_loss_and_learns_a_product():
    """Label 1 just where two features agree: no linear rule tells it, pairs do."""
    rng = np.random.default_rng(4)
    sign = rng.choice([-1.0, 1.0], size=(400, 2))
    model = M.learn(np.arange(0, 801, 2), np.tile([0, 1], 400), sign.ravel().astype(np.float32), (sign[:, 0] == sign[:, 1]).astype(float), 2)
    margin = model.margin(np.arange(0, 801, 2), np.tile([0, 1], 400), sign.ravel())
    assert ((margin > 0) == (sign[:, 0] == sign[:, 1])).mean() == 1


def test_features_against_plain_counts():
    texts = ["The the THE cat!!\n| x 12 É", "", None, "a", " \n "]
    meta = [3, None, 0, -5, 1]
    batch = pa.record_batch([pa.array(texts), pa.array(meta, pa.float64()), pa.array(["u", "v", None, "u", ""])], names=["t", "a", "b"])
    (i, j, starts, at, x), = M.features(batch, ("a", "b"))
    assert (i, j) == (0, 5)
    rows = [dict(zip(at[a:b].tolist(), x[a:b].tolist())) for a, b in zip(starts, starts[1:])]
    stat = {k: rows[0][M.BUCKETS + n] for n, k in enumerate(M.STATS)}
    text, words = texts[0], texts[0].split()
    raw = text.encode()
    assert stat["bytes"] == pytest.approx(math.log1p(len(raw)) / 20) and stat["words"] == pytest.approx(math.log1p(8) / 20)
    assert stat["word_length"] == pytest.approx(sum(len(w.encode()) for w in words) / 8 / 20)
    assert stat["capital"] == pytest.approx(4 / len(raw)) and stat["mark"] == pytest.approx(2 / len(raw)) and stat["wide"] == pytest.approx(2 / len(raw))
    assert stat["again"] == pytest.approx(2 / 8) and stat["distinct"] == pytest.approx(6 / 8) and stat["short"] == pytest.approx(2 / 8)
    own = [v for k, v in rows[0].items() if k < M.BUCKETS]
    assert sum(v * v for v in own) == pytest.approx(1) and max(own) / min(own) == pytest.approx(math.log(4) / math.log(2))
    assert all(v == 0 for k, v in rows[1].items() if k < M.BUCKETS + len(M.STATS)) and rows[2].keys() & rows[1].keys() >= {M.BUCKETS}
    number = M.BUCKETS + len(M.STATS)
    assert rows[0][number] == pytest.approx(math.log(4) / 20) and number not in rows[1] and rows[3][number] == pytest.approx(-math.log(6) / 20)
    assert {k for k in rows[0] if k > number} == {k for k in rows[3] if k > number} and not [k for k in rows[2] if k > number]


def test_held_out_accuracy(spark):
    out = {r.doc_id: r for r in queries.op12_factor_machine(spark, SF01).collect()}
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels").collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    own = [(out[r.doc_id], r.quality) for r in labels if out[r.doc_id].held_out]
    assert len(own) > 80
    assert sum(r.predicted == q for r, q in own) / len(own) >= 0.97
    good, bad = ([r.score for r, q in own if q == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.98


def test_nulls_repeats_clashes_and_empty_tables(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (3, 0), (4, None), (None, 1), (9, 1)], "doc_id long, quality int")
    rows = [(1, "good words here"), (2, "# # #"), (2, "# # #"), (3, None), (None, ""), (5, "x " * 60_000), (1, "good words here")]
    d = docs(rows).withColumnRenamed("ids", "score")
    model = M.fit(d, labels, metadata=["n_words", "lang"])
    out = M.score(d, model, metadata=["n_words", "lang"])
    assert out.columns == ["doc_id", "text", "lang", "n_words", "score"] and out.count() == len(rows)
    by = {}
    for r in out.collect():
        by.setdefault((r.doc_id, r.text), set()).add(r.score)
    assert all(len(s) == 1 for s in by.values()) and min(by[1, "good words here"]) > max(by[2, "# # #"])
    assert M.fit(d, labels.limit(0)) is None and {r.score for r in M.score(d, None).collect()} == {0.5}
    assert M.score(docs([]), model, metadata=["n_words", "lang"]).count() == 0
    assert M.fit(docs([]), labels) is None
