"""The conversation trie against a brute-force trie."""

import hashlib
import random
import zlib

import pytest

from market_engine.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, depth string, key string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def _turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, _turn_id(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    grown = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        grown[c] = own.get(first, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in grown.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        parents = {q[:-1] for q in below if len(q) > len(p)}
        ends = sorted(c for c in members if len(grown[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children),
                    sum(q not in parents for q in below), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, capacity):
    out = prefix_trie.prefix_trie(prefix_trie.regrown(prefix_trie.sequences(_frame(spark, rows))), capacity)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def _rows(rng, n):
    rows = []
    for c in [*range(-3, n), 100, 105, 203, 299]:
        for t in range(rng.randrange(0, 9)):
            text = rng.choice(["", "a", "bé", "ccc", None])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), text))
    shared = [(t, "user", f"say {t}") for t in range(12)]
    rows += [(400 + i, *x) for i in range(9) for x in shared] + [(420 + i, *x) for i in range(6) for x in [*shared, (20, "user", str(i % 4))]]
    rows += [(None, 0, "user", "lost"), rows[0], rows[-1]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("capacity,seed", [(1, 3), (3, 4), (256, 5)])
def test_trie_against_brute_force(spark, capacity, seed):
    rows = _rows(random.Random(seed), 24)
    assert got(spark, rows, capacity) == brute(rows)


def test_trie_of_nothing_of_copies_and_of_one_long_conversation(spark):
    assert got(spark, [], 4) == []
    copies = [(c, t, "user", "hello") for c in range(100, 140) for t in range(3)]
    assert got(spark, copies, 4) == brute(copies)
    long = [(700, t, "user", str(t)) for t in range(3000)] + [(800, t, "user", str(t)) for t in range(3000)]
    out = got(spark, long, 1)
    assert len(out) == len(set(out)) and max(r[1] for r in out) == 3000


def test_ends_of_many_conversations_span_several_ranges(spark):
    ids = [5, 70_000, 65_536, -1, 2 ** 40]
    seqs = spark.createDataFrame([(c, [("ab" * 16, 1)]) for c in ids], "conv_id long, turns array<struct<id:string,n:int>>")
    leaf = [r for r in prefix_trie.prefix_trie(seqs).collect() if r.depth == 1]
    assert [(r.conv_id, r.n_convs, r.ends_sha256) for r in leaf] == [
        (-1, 5, hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest())]
