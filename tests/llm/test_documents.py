"""Document operators on small hand-made inputs, against brute force."""

import hashlib
import random
import re
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests_llm_brute import components, removed

from market_engine.llm import common, parity_join, quality_rules, rendezvous, substring_dedup, token_cache, trie_bpe, winnowing

PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _text(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    shared, base = _text(rng, 70), _text(rng, 200).split()
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, _text(rng, 49)), (7, _text(rng, 50))]
    rows += [(10 + i, f"{_text(rng, 30)} {shared}\n{_text(rng, 25)}") for i in range(6)]
    rows += [(20 + i, " ".join(base)) for i in range(4)]
    for i in range(25):  # copies with edits of their own, at and around the bound of similarity
        w = list(base)
        for _ in range(rng.randrange(1, 7)):
            w[rng.randrange(200)] = f"e{rng.randrange(9999)}"
        rows.append((30 + i, " ".join(w[: 200 - rng.randrange(8)])))
    rows += [(60, "Of " * 120), (61, "Of " * 90), (62, _text(rng, 3000)), (63, "ÉÀ ß one two three " * 3), (21, " ".join(base))]
    rng.shuffle(rows)
    return rows


def test_substring_dedup_against_brute_force(docs, corpus):
    out = substring_dedup.remove_repeats(docs(corpus), carry=["doc_id", "lang"])
    assert out.columns == ["doc_id", "lang", "n_words", "n_removed", "kept"]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()) == removed(corpus)


def test_substring_rewrite_keeps_columns_and_untouched_texts(docs, corpus):
    d = docs([*corpus, (None, corpus[0][1])])
    out = substring_dedup.rewrite(d)
    assert set(out.columns) <= set(d.columns)
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[3] == " \n\t" and kept[1] is None and len(kept) == len({i for i, _ in corpus}) + 1
    assert substring_dedup.remove_repeats(docs([]), carry=["doc_id"]).count() == 0


def test_substring_dedup_with_a_repeated_source(docs):
    rng = random.Random(11)
    passage = _text(rng, 120).split()
    edited = [*passage[:70], "edit", *passage[71:]]
    around = lambda w: f"{_text(rng, 20)} {' '.join(w)} {_text(rng, 20)}"
    rows = [(1, around(passage))] * 2 + [(2, around(edited)), (3, around(passage)), (3, around(edited))]
    out = substring_dedup.remove_repeats(docs(rows), carry=["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == removed(rows)
    assert sum(r.n_removed > 0 for r in out) == 3
    texts = sorted((r.doc_id, len(r.text.split())) for r in substring_dedup.rewrite(docs(rows)).collect())
    assert texts == sorted((d, n - gone) for d, n, gone, _ in removed(rows))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_parity_join_against_all_pairs(docs, corpus, k, percent):
    out = parity_join.label(docs(corpus), k, percent).collect()
    want = components(corpus, k, percent)
    assert len(out) == len(corpus)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want


def _thue_morse(a, b):
    """Word of 1,024 letters; with its complement it defeats polynomial hashes modulo powers of two."""
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(1024))


def test_words_that_defeat_polynomial_hashes(docs):
    x, y = _thue_morse("a", "b"), _thue_morse("b", "a")
    rows = [(1, " ".join([*map(str, range(49)), x])), (2, " ".join([*map(str, range(49)), y])), (3, f"x y {x}"), (4, f"x y {y}")]
    out = substring_dedup.remove_repeats(docs(rows), carry=["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == removed(rows)
    out = parity_join.label(docs(rows), 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == components(rows, 3, 90)


def _families(seed):
    """Groups of edited copies around the bound, a passage that many texts share, and a large family without its base."""
    rng = random.Random(seed)
    passage, rows = _text(rng, 60, 5000), []
    for family in range(4):
        base = _text(rng, rng.choice([30, 90, 160]), 5000).split()
        for _ in range(18):
            w = list(base)
            for _ in range(rng.randrange(0, 2 + len(base) // 12)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(99999)}"
            rows.append(" ".join(w[rng.randrange(3):len(w) - rng.randrange(4)]))
    rows += [f"{_text(rng, rng.randrange(5, 120), 5000)} {passage} {_text(rng, rng.randrange(5, 120), 5000)}" for _ in range(40)]
    rows += [passage, passage + " end", "a b", "a b", "", _text(rng, 700, 5000)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,k,percent", [(1, 3, 90), (2, 5, 80), (3, 1, 80), (4, 2, 70), (5, 5, 90)])
def test_parity_join_on_families(docs, seed, k, percent):
    rows = _families(seed)
    out = parity_join.label(docs(rows), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == components(rows, k, percent)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(6)
    for n in (3, 40, 300, 3000):
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        y = np.unique(np.append(x[rng.random(len(x)) < 0.8], rng.integers(0, 2 ** 63, n // 8).astype(np.uint64)))
        a, b = parity_join._sketch(x), parity_join._sketch(y)
        m = min(len(a), len(b))
        fold = [np.bitwise_xor.reduce(s.reshape(-1, m)) for s in (a, b)]
        apart = sum(bin(int(v) & (1 << 64) - 1).count("1") for v in fold[0] ^ fold[1])
        assert apart <= len(np.setxor1d(x, y)) and apart % 2 == len(np.setxor1d(x, y)) % 2


def test_parity_join_empty_null_and_bands(docs):
    assert parity_join.label(docs([])).count() == 0
    rows = parity_join.label(docs([(None, "a b c d"), (1, "a b c d"), (2, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (1, 1), (2, 2)]
    assert parity_join.keep_first(docs([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")])).count() == 2
    for percent in (80, 90):
        for lo, hi, p, spare in parity_join.bands(percent, 30_000):
            worst = max(parity_join.most_different(a, a * 100 // percent, percent) for a in range(lo, min(hi, lo + 500)))
            assert p == 0 and worst == 0 or p > worst + spare - 1


def test_quality_measures_against_brute_force(docs, corpus):
    rows = [*corpus, (70, "a # b\na # b\n\n c"), (71, "the cat " * 40), (72, "| x | $$$ " * 30)]
    for r in quality_rules.judge(docs(rows)).collect():
        t = r.text or ""
        w = WORD.findall(t)
        grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        rep = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)} if len(w) < 1000 else set()
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(rep) > 30 * len(w))
        assert r.kept == (not r.base_failed and not r.broken_rules)
    kept = quality_rules.keep_good(docs(rows))
    assert kept.columns == docs([]).columns and 0 < kept.count() < len(rows)


def test_winnowing_with_short_items(spark, docs, corpus):
    rng = random.Random(9)
    items = [("a", _text(rng, 14)), ("b", "Rare-Phrase here"), ("c", None), ("d", "..."), ("e", "rare phrase HERE"), (None, "w1")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [*corpus, (80, "x y " + items[0][1] + " z"), (81, "a rare, phrase: HERE ok"), (82, " ".join(items[0][1].split()[:9])),
            (83, items[0][1].upper() + " " + items[0][1]), (None, "rare phrase here")]
    got = {r.doc_id: r for r in winnowing.report(docs(rows), bench).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert (got[80].n_hit, got[80].items_sha256) == (14, sha("a")) and got[80].n_words == 17
    assert (got[81].n_hit, got[81].n_items, got[81].items_sha256) == (3, 2, sha("b,e"))
    assert got[82].n_hit == 0 and got[83].n_hit == 28 and got[None].n_hit == 3 and not got[1].contaminated
    left = winnowing.drop_contaminated(docs(rows), bench)
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in corpus) + [82]
    assert winnowing.report(docs([]), bench).count() == 0
    assert not any(r.contaminated for r in winnowing.report(docs(corpus), bench.limit(0)).collect())


ODD = [None, "", "   ", "don't we'll 1234 <|endoftext|>x<|startoftext|>", "ΟΔΟΣ ΣΑΣ İstanbul", "a\x1cb\x1f c", "é é ﬁ Å 中文 日本",
       "aaaa aaaaaaaaaa hahahahahaha", "<| endoftext|> |>", "\x00\x7f !!!???...", "👍🏽🙂 word\u00a0word\u2003x\u3000y", "x" * 300]


def _library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_trie_bpe_is_the_library(docs, corpus):
    lib = _library()
    rows = [*corpus, *((200 + i, t) for i, t in enumerate(ODD))]
    out = trie_bpe.encode(docs(rows), PATH, decoded=True)
    assert "ids" in out.columns and out.columns.count("ids") == 1
    for r in out.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == lib.decode(ids, skip_special_tokens=False)
    again = trie_bpe.decode(out.drop("decoded"), PATH).join(out.select("doc_id", "text", "decoded").withColumnRenamed("decoded", "d"), ["doc_id", "text"])
    assert again.filter("decoded <> d").count() == 0 and trie_bpe.encode(docs([]), PATH).count() == 0


def test_trie_bpe_fuzz():
    rng, lib, own = random.Random(4), _library(), trie_bpe.WordBpe(PATH)
    texts = ["".join(rng.choice("aabcdeinthrso's ÉéßΣ①½٣\u0301中🙂!?.<|>019\x1c\x85") for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["".join(rng.choice("aeinsth") for _ in range(rng.randrange(1, 30))) for _ in range(8000)]
    for b, e in zip(own.encode(texts), lib.encode_batch(texts, add_special_tokens=False)):
        assert [int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)] == e.ids


def test_trie_bpe_very_long_words():
    rng, lib, own = random.Random(6), _library(), trie_bpe.WordBpe(PATH)
    for text in ("a" * 100_000, "".join(rng.choice("acgt") for _ in range(1_000_000)), "a" * 300 + " " + "a" * 200 + " " + "a" * 1000 + "b"):
        e = own.encode([text])[0]
        assert [int.from_bytes(e[i:i + 4], "little") for i in range(0, len(e), 4)] == lib.encode(text, add_special_tokens=False).ids


def test_token_cache_encodes_each_miss_once(spark, docs, corpus, tmp_path_run):
    lib, cache = _library(), tmp_path_run + "/cache"
    rows = [*corpus, *((200 + i, t) for i, t in enumerate(ODD)), (None, "one")]
    for _ in range(2):
        out = token_cache.count_tokens(docs(rows), PATH, cache).collect()
        want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in out) == sorted((i or -1, b, n) for i, b, n in want)
        assert spark.read.parquet(cache).count() == len({(t or "").strip(" \t\n\x0b\x0c\r") for _, t in rows})
    assert token_cache.count_tokens(docs([]), PATH, cache).count() == 0
    other = token_cache.counter(public_tokenizers.path("piece_bpe_32k.model"))
    assert other(["", "hello world"])[0] == 0


def test_rendezvous_slots_and_growth(docs, corpus):
    weights = {s: 1.0 for s in range(5)}
    rows = [*corpus, *[(99, "same")] * 40, (None, None)]
    out = rendezvous.manifest(docs(rows), "doc_id", "text", weights, grown=(5, 1.0)).collect()
    assert len(out) == len(rows)
    for s in weights:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert all(r.grown_shard in (r.shard, 5) for r in out) and len({r.shard for r in out if r.key == 99}) == 1
    again = rendezvous.assign(docs(rows), "doc_id", {**weights, 5: 1.0}).select("doc_id", "shard").distinct().collect()
    assert {r.doc_id: r.shard for r in again} == {r.key: r.grown_shard for r in out}
    heavy = rendezvous.assign(docs([(i, "") for i in range(3000)]), "doc_id", {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()
    assert 0.7 < {r.shard: r["count"] for r in heavy}[1] / 3000 < 0.8
    assert rendezvous.manifest(docs([]), "doc_id", "text", weights).count() == 0


def test_trie_bpe_decodes_from_the_ids_of_each_text(docs):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "one  two\nthree")]
    out = {r.doc_id: r for r in trie_bpe.encode(docs(rows), PATH, decoded=True).collect()}
    bpe = trie_bpe.tokenizer(PATH)
    assert all(out[d].decoded == bpe.decode(out[d].ids) for d, _ in rows)
    assert out[1].decoded == out[2].decoded == "" and out[3].ids == out[4].ids[:len(out[3].ids)]


def test_a_worker_gives_up_the_tables_of_its_former_step():
    bpe = trie_bpe.tokenizer(PATH)
    assert bpe.encode(["some words to know"]) and trie_bpe.tokenizer(PATH) is bpe
    gone = weakref.ref(bpe)
    del bpe
    assert [len(s) for s in parity_join._sets(pa.array(["a b c d"]), 3)] == [2]
    assert gone() is None and trie_bpe.tokenizer(PATH).encode(["some words"])


def test_keys_are_exchanged_once_in_small_batches(docs, spark, monkeypatch):
    seen = []

    def stored(df, name, batch_bytes=None):
        seen.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"), batch_bytes))
        return common.stored(df, name, batch_bytes)
    before = spark.conf.get(common.BATCH_BYTES, None)
    monkeypatch.setattr(parity_join, "stored", stored)
    base = " ".join(map(str, range(60)))
    rows = parity_join.label(docs([(i, f"{base} end{i}") for i in range(4)]), 5, 80).collect()
    assert {r.component_id for r in rows} == {0} and spark.conf.get(common.BATCH_BYTES, None) == before
    assert sum(n for name, n, _ in seen if name in ("meeting", "met")) == 1  # the sets' keys are made once
    assert all(b == parity_join.BATCH for _, n, b in seen if n)


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_have_the_keys_in_common_that_each_needs(percent):
    rng = np.random.default_rng(percent)
    new = lambda n: rng.integers(0, 2 ** 63, n).astype(np.uint64)
    for n in [*range(4, 60), 200, 450, 700, 1500]:
        x, known = np.unique(new(n)), []
        for gone, more in ((n * (100 - percent) // 100, 0), (0, n * (100 - percent) // percent), (n * (100 - percent) // 220,) * 2):
            y = np.unique(np.append(x[gone:], new(more)))
            if 100 * len(np.intersect1d(x, y)) < percent * len(np.union1d(x, y)):
                continue
            sets = [({b: parity_join._blocks(s, q, spare, b) for b, (_, _, q, spare) in parity_join._joined(len(s), percent, known)},
                     {v & 63: v >> 6 for v in parity_join._needs(s, percent, known)}) for s in (x, y)]
            both = sets[0][0].keys() & sets[1][0].keys()
            assert len(x) == len(y) == len(np.intersect1d(x, y)) or any(
                len(np.intersect1d(sets[0][0][b], sets[1][0][b])) >= max(sets[0][1][b], sets[1][1][b]) for b in both), (n, gone, more)
            assert all(int(k) & 63 == b for keys, _ in sets for b in keys for k in keys[b])


def test_texts_that_share_a_passage_only_form_no_groups(docs, monkeypatch):
    rng, groups = random.Random(9), []

    def stored(df, name, batch_bytes=None):
        out = common.stored(df, name, batch_bytes)
        groups.extend([out.count()] * (name == "groups"))
        return out
    monkeypatch.setattr(parity_join, "stored", stored)
    passage = _text(rng, 60, 5000)
    rows = [(i, f"{_text(rng, 120, 5000)} {passage} {_text(rng, 120, 5000)}") for i in range(60)]
    assert all(r.component_id == r.doc_id for r in parity_join.label(docs(rows), 5, 80).collect())
    assert groups == [0]
