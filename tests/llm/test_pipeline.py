"""The registered names, and the pipeline against a brute-force version."""

import random
import re

from tests_llm_brute import components, removed

import corpus_pipeline
from market_engine.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS
from market_engine.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_names():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14)) and "pipeline" in QUERIES
    assert {n for n, (_, sql) in QUERIES.items() if sql is None} == {
        "op3_block_rules", "op8_trie_bpe", "op9_digest_cache", "op12_factor_machine", "pipeline"}


def _good(t):
    w = WORD.findall(t)
    n, chars = len(w), sum(map(len, w))
    grams = [tuple(w[i:i + 8]) for i in range(n - 7)]
    rep = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    stop = {x for words in STOP_WORDS.values() for x in words.split()}
    if n < 20 or 100 * len(rep) > 30 * n:
        return False
    m = {"mean_word_chars": chars / n, "symbol_ratio": sum(c in SYMBOLS for c in t) / chars, "stop_ratio": sum(x in stop for x in w) / n,
         "dup_line_ratio": (len(lines) - len(set(lines))) / len(lines)}
    return all(n < r.from_words or (r.low is None or m[r.metric] >= r.low) and (r.high is None or m[r.metric] <= r.high) for r in RULES)


def test_pipeline_against_brute_force(spark, tmp_path_run):
    from tokenizers import Tokenizer
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(["the", "of", "and", f"w{rng.randrange(900)}", f"v{rng.randrange(900)}"]) for _ in range(n))
    item, passage, base = text(15), text(60), text(150)
    rows = [(1, None), (2, ""), (3, "of " * 60), (4, "# $ | " * 40)] + [(5 + i, text(rng.randrange(21, 120))) for i in range(12)]
    rows += [(30 + i, f"{text(40)}\n{passage} {text(30)}") for i in range(5)] + [(40 + i, base + f" the end{i}") for i in range(5)]
    rows += [(50, f"{text(40)} {item.upper()} {text(20)}"), (51, base), (52, text(2500))]
    rng.shuffle(rows)
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(tmp_path_run + "/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(tmp_path_run + "/benchmark.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids, r.decoded) for r in corpus_pipeline.run(spark, tmp_path_run).collect()}

    left = [(i, t) for i, t in rows if t and _good(t)]
    first = components(left, 5, 80)
    left = [(i, t) for i, t in left if first[i][1] == i]
    texts = dict(left)
    left = [(i, kept if n_removed else texts[i]) for i, _, n_removed, kept in removed(left)]
    gram = lambda t: {tuple(w[i:i + 10]) for w in [PLAIN.findall(t.lower())] for i in range(len(w) - 9)}
    left = [(i, t) for i, t in left if not gram(t) & gram(item)]
    lib = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    ids = {i: lib.encode(t, add_special_tokens=False).ids for i, t in left}
    assert got == {i: (len(x), x, lib.decode(x, skip_special_tokens=False)) for i, x in ids.items()}
    assert 50 not in got and 3 not in got and 4 not in got and 41 not in got and 30 in got


def test_pipeline_stages_take_empty_documents_and_clashing_columns(spark, tmp_path_run):
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, component string"
    spark.createDataFrame([(1, "some words of the item")], "item_id long, text string").write.parquet(tmp_path_run + "/benchmark.parquet")
    for rows in ([], [(1, "the words of a text are here and they go on " * 3 + str(i), "en", "s", 9, 1, True, "x") for i in range(2)] + [(None, None, None, None, None, None, None, None)]):
        docs = spark.createDataFrame(rows, schema)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = spark.createDataFrame(stage(spark, docs, tmp_path_run).collect(), stage(spark, docs, tmp_path_run).schema)
            assert i == 4 or set(schema.replace(",", "").split()[::2]) == set(docs.columns), name
