"""Benchmark decontamination by winnowing.

Texts become words (ASCII letters lower-cased, digits, everything beyond ASCII). Of all hashes of k
consecutive words, the smallest of every sliding window of w hashes is kept as a fingerprint, with its
place. Two texts that share ``k + w - 1`` words or more share the fingerprint of every such span, so
joining the fingerprints of corpus and benchmark finds each shared span of that length. A joined
fingerprint is extended to the windows around it, and those are joined with the benchmark's windows
word by word: what is reported is exact.

A window is ``length`` words of an item. Shorter items are one window of their own length; the lengths
that occur (at most ``length`` values) each get their own k and w, so the guarantee holds for them too.

Built-in functions only. Texts are hashed where they are read and only the fingerprints' places move.
The benchmark's fingerprints and windows are broadcast when their counted rows are at most
``broadcast_rows``, else they are shuffled; the result is the same.

Defined results: a null text has no words and no hits; an item without words has no window; repeated
document rows get their own equal results; items with the same text count each, repeated rows of one
item id once; a null item id is left out; other columns are ignored; empty tables give no hits or no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.llm.common import pair_shift, stored
from market_engine.llm.url_reputation import LOWER, UPPER

GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD_ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_PLACE_BITS = 12
_PLACE = (1 << _PLACE_BITS) - 1


def plain_words(text: Column) -> Column:
    """Array of the words; pure ASCII texts take the faster way to lower case."""
    t = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(lowered, GAP), "")


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_ANY_CASE)).cast("long")


def gram_size(length: int) -> int:
    """k for windows of ``length`` words: half the window, so that w = length - k + 1 stays useful."""
    return max(1, (length + 1) // 2)


def _grams(df: DataFrame, keep: list[str], k: int) -> DataFrame:
    """Column _g: hashes of k consecutive words from the word hashes _h, by doubling."""
    d, have = df.select(*keep, "_h", F.col("_h").alias("_g")), 1
    for bit in bin(k)[3:]:
        d = d.select(*keep, "_h", pair_shift("_g", have, lambda x, y: F.xxhash64(x, y)).alias("_g"))
        have *= 2
        if bit == "1":
            n = F.greatest(F.size("_h") - have, F.lit(0))
            d = d.select(*keep, "_h", F.zip_with(F.slice("_g", F.lit(1), n), F.slice("_h", F.lit(1 + have), n),
                                                 lambda x, y: F.xxhash64(x, y)).alias("_g"))
            have += 1
    return d.select(*keep, "_g")


def fingerprints(words: DataFrame, keep: list[str], k: int, w: int) -> DataFrame:
    """Rows (*keep, fp, place): window minima of the k-gram hashes of column ``_w``, each place once.

    The low bits of a hash give way to its place, so the minimum carries both; a run of windows with
    one minimum gives one row."""
    d = _grams(words.select(*keep, F.transform("_w", lambda x: F.xxhash64(x)).alias("_h")), keep, k)
    d = d.select(*keep, F.transform("_g", lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(
        i.cast("long").bitwiseAND(F.lit(_PLACE)))).alias("_m"))
    span = 1
    while span < w:
        step = min(span, w - span)
        d = d.select(*keep, pair_shift("_m", step, lambda x, y: F.least(x, y)).alias("_m"))
        span += step
    first = F.transform("_m", lambda m, i: F.when(
        (i == 0) | (F.get("_m", i - 1) != m),
        F.struct(F.shiftright(m, _PLACE_BITS).alias("fp"),
                 (i + (m - i).bitwiseAND(F.lit(_PLACE))).cast("int").alias("place"))))
    d = d.select(*keep, F.explode(F.array_compact(first)).alias("_f"))
    return d.select(*keep, "_f.fp", "_f.place")


def item_windows(benchmark: DataFrame, item_id: str, text: str, length: int) -> DataFrame:
    """Rows (item_id, size, win): every window of every item, words joined by a space."""
    d = benchmark.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), plain_words(F.col(text)).alias("_w"))
    d = d.filter(F.size("_w") > 0).withColumn("size", F.least(F.lit(length), F.size("_w")))
    starts = F.sequence(F.lit(1), F.size("_w") - F.col("size") + 1)
    return d.select("item_id", "size", F.explode(F.transform(starts, lambda s: F.array_join(
        F.slice("_w", s, F.col("size")), " "))).alias("win")).distinct()


def _id(doc_id: str) -> Column:
    """The id inside a struct: join keys then match null ids too."""
    return F.struct(F.col(doc_id).alias("id")).alias("doc_id")


def hits(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", length: int = 10, broadcast_rows: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(places, pairs), doc_id as struct (id): places (doc_id, text_key, spans) with the sorted distinct (start, size) of every
    benchmark window in a document, and pairs (doc_id, text_key, item_id), distinct."""
    small = lambda df, n: F.broadcast(df) if n <= broadcast_rows else df
    key = ["doc_id", "text_key"]
    docs = documents.select(_id(doc_id), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("_text"))
    windows = stored(item_windows(benchmark, item_id, item_text, length), "windows")
    sizes = [(r["size"], r["n"]) for r in windows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()]
    n_windows = sum(n for _, n in sizes)
    words = docs.select(*key, plain_words(F.col("_text")).alias("_w"))
    found = None
    for size, n in sizes:  # at most ``length`` lengths
        k = gram_size(size)
        w = size - k + 1
        own = windows.filter(F.col("size") == size).select("win").distinct().select(F.split("win", " ").alias("_w"))
        prints = fingerprints(own, [], k, w).select("fp").distinct()
        own_hits = fingerprints(words, key, k, w).join(small(prints, n), "fp").select(
            *key, F.lit(size).alias("size"), F.lit(size - k).alias("back"), "place")
        found = own_hits if found is None else found.unionByName(own_hits)
    if found is None:
        empty = docs.filter(F.lit(False)).select(*key)
        return (empty.withColumn("spans", F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("size")))),
                empty.join(windows.select("item_id"), F.lit(False)))
    near = stored(found.groupBy(*key).agg(F.collect_set(F.struct("size", "back", "place")).alias("near")), "near")
    cand = docs.join(near, key).select(*key, "near", plain_words(F.col("_text")).alias("_w"))
    starts = F.array_distinct(F.flatten(F.transform("near", lambda x: F.transform(
        F.sequence(F.greatest(F.lit(0), x["place"] - x["back"]), x["place"]),
        lambda s: F.struct(x["size"].alias("size"), s.alias("start"))))))
    cand = cand.select(*key, "_w", F.filter(starts, lambda s: s["start"] + s["size"] <= F.size("_w")).alias("_s"))
    cand = cand.select(*key, F.explode(F.transform("_s", lambda s: F.struct(
        s["start"].alias("start"), s["size"].alias("size"),
        F.array_join(F.slice("_w", s["start"] + 1, s["size"]), " ").alias("win")))).alias("c")).select(*key, "c.*")
    hit = stored(cand.join(small(windows.select("size", "win").distinct(), n_windows), ["size", "win"]), "hits")
    places = hit.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans"))
    pairs = hit.select(*key, "size", "win").distinct().join(small(windows, n_windows), ["size", "win"]).select(*key, "item_id").distinct()
    return places, pairs


def covered(spans: Column) -> Column:
    """Words covered by sorted (start, size) spans, as long."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))

    def add(acc, s):
        end = s["start"] + s["size"]
        more = F.greatest(F.lit(0), end - F.greatest(s["start"], acc["end"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["sum"] + more).alias("sum"))
    return F.aggregate(spans, zero, add, lambda a: a["sum"])


def report(documents: DataFrame, benchmark: DataFrame, length: int = 10, **names) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    doc_id, text = names.get("doc_id", "doc_id"), names.get("text", "text")
    key = ["doc_id", "text_key"]
    places, pairs = hits(documents, benchmark, length=length, **names)
    items = pairs.groupBy(*key).agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    found = places.join(items, key).select(
        "doc_id", "text_key", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    docs = documents.select(_id(doc_id), F.xxhash64(F.col(text)).alias("text_key"), count_words(F.col(text)).alias("n_words"))
    zero = F.lit(0).cast("long")
    return docs.join(found, key, "left").select(
        F.col("doc_id.id").alias("doc_id"), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, length: int = 10, doc_id: str = "doc_id", text: str = "text",
                      **names) -> DataFrame:
    """The rows of ``documents`` without any benchmark window, with their own columns."""
    places, _ = hits(documents, benchmark, doc_id=doc_id, text=text, length=length, **names)
    hit = places.select(F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key"))
    same = (F.struct(F.col(f"`{doc_id}`").alias("id")) == F.col("_hit_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_hit_key"))
    return documents.join(hit, same, "left_anti")
