"""Ranked search against a plain scan of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from market_engine.llm import bloom_search as B

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
QUERY = "item_id string, text string, rank int, score string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in TERM.findall(text or "")]


def brute(docs, queries, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, tf, sum(tf.values())) for i, tf in held if tf]
    total, df = sum(n for _, _, n in held), Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in queries:
        found = []
        for i, tf, n in held:
            m = 10 + 90 * n * len(held) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t in set(terms(text)) if t in tf)
            if i is not None and score > 0:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def got(spark, docs, rows, queries, k):
    out = B.search(docs(rows), spark.createDataFrame([(*q, 1, "x") for q in queries], QUERY), k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(300)] + ["Straße", "ÉCOLE", "Ünï", "naïve", "日本"]
    say = lambda n: " ".join(vocab[int(len(vocab) * rng.random() ** 3)] for _ in range(n))
    rows = [(i, say(rng.choice([1, 3, 20, 60, 200]))) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [(8, rows[8][1]), (8, say(30)), (None, say(30)), (None, None), (500, None), (501, ""), (502, " .,- ")]
    rows += [(600, say(20_000)), (601, "w299 " * 3000), (602, "W299,w298;W298\tw298"), (-5, "x" * 50_000)]
    rng.shuffle(rows)
    queries = [(f"q{i}", say(rng.choice([1, 5, 40]))) for i in range(25)] + [
        ("none", ""), ("null", None), ("marks", "?!"), ("rare", "unheard " + "x" * 50_000), ("copy", rows[3][1] or "w1"), ("w", "w299 W299 w298")]
    return rows, queries


@pytest.mark.parametrize("k", [1, 10])
def test_search_against_a_scan(spark, docs, corpus, k):
    rows, queries = corpus
    assert got(spark, docs, rows, queries, k) == brute(rows, queries, k)


def test_small_blocks_and_a_shuffle_of_texts_change_nothing(spark, docs, corpus, monkeypatch):
    rows, queries = corpus
    monkeypatch.setattr(B, "BLOCK_BYTES", 300)
    monkeypatch.setattr(B, "BROADCAST_IDS", 0)
    queries = [q for q in queries if q[0] != "rare"][:12]
    assert got(spark, docs, rows, queries, 3) == brute(rows, queries, 3)


def test_empty_tables(spark, docs, corpus):
    assert got(spark, docs, [], corpus[1][:3], 10) == [] and got(spark, docs, corpus[0][:5], [], 10) == []
    assert got(spark, docs, [(1, None), (2, "")], corpus[1][:3], 10) == []


def test_bounds_hold(corpus):
    rows = [(i, t) for i, t in corpus[0] if t and i is not None]
    asked = [list(dict.fromkeys(B.terms_of(t))) for _, t in corpus[1] if B.terms_of(t)]
    names = list(dict.fromkeys(t for ts in asked for t in ts))
    number = {t: i for i, t in enumerate(names)}
    block = B.Queries(names, np.arange(len(names)) * 37 % 900, [np.array([number[t] for t in ts]) for ts in asked], 350, 40_000)
    import pyarrow as pa
    batch = pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], names=["doc_id", "text"])
    scores = {}
    for i, t in rows:
        scores.setdefault(i, []).append(block.score(t, range(len(asked))))
    seen = Counter()
    for index in B._build([batch]):
        whole = index.filter(pa.compute.greater(index.column(0), 0))
        for width, ids, n, top, bits in B._blocks([whole.select([0, 3, 4, 5, 6])]):
            bounds = block.bounds(width, n, top, bits)
            for d, i in enumerate(ids):
                seen[i] += 1
                assert (bounds[:, d] >= np.min(scores[i], axis=0)).all()
    assert seen == Counter(i for i, t in rows if terms(t))
