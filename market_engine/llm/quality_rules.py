"""Quality rules: a table of thresholds compiled into one Spark projection.

``measure`` adds the counts of every text, ``compile_rules`` turns threshold rows
(metric, lower bound, upper bound, from how many words on) into boolean columns of a single
projection. Only built-in functions; no shuffle, so a text is judged where it is read.

Defined results: a null text counts as empty and fails ``min_words``; a ratio without a denominator
is 0; repeated rows are judged alike; a metric column that the input already has is replaced in
``measure``'s output, all other columns pass through; an empty table gives an empty table. A text of
any length takes O(n log n): repeated windows are found by sorting their hashes, once per text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_engine.llm.common import SPACE_CHARS, pair_shift, split_words, sum_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of the four languages; compared as written, so shouted text has none.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from an or not he she they we you",
    "de": "der die und in den von zu das mit sich des auf für im nicht ist dem eine ein als auch an es so wie",
    "fr": "de la le et les des en un du une est que pour dans qui au sur par pas avec ce il elle ne se plus",
    "es": "de la que el en y los se del un las por con una no su es para al lo como más o pero sus le",
}


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; texts of fewer than ``from_words`` words are not judged by it."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: Texts that fail any of these are dropped by every consumer of the base measures.
BASE_RULES = (
    Rule("min_words", "n_words", low=20),
    Rule("repeated_windows", "repeat_ratio", high=0.30),
)
#: The verdict proper: length, symbol, stop-word and line ratios. Wide on purpose: clean text stays.
RULES = (
    Rule("word_length", "mean_word_chars", low=2.0, high=12.0, from_words=20),
    Rule("symbols", "symbol_ratio", high=0.20),
    Rule("stop_words", "stop_ratio", low=0.01, from_words=50),
    Rule("duplicate_lines", "dup_line_ratio", high=0.50),
)
METRICS = ("n_words", "word_chars", "n_symbols", "n_stop", "n_lines", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measure(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds METRICS (long). ``window`` must be a power of two: hashes of 2, 4, 8 words are built from
    the halves."""
    keep = [c for c in df.columns if c not in METRICS]
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    t = F.coalesce(F.col(text), F.lit(""))
    d = df.select(*keep, t.alias("_t"), split_words(F.col(text)).alias("_w"), F.split(t, "\n", -1).alias("_l"))
    counts = [
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(_without(F.col("_t"), SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.octet_length("_t") - F.octet_length(_without(F.col("_t"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size(F.filter("_w", lambda w: w.isin(stop))).cast("long").alias("n_stop"),
        F.filter("_l", lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_l"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    ]
    d = d.select(*keep, *counts)
    done = ["n_words", "word_chars", "n_symbols", "n_stop"]
    d = d.select(*keep, *done, F.size("_l").cast("long").alias("n_lines"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), "_h")
    done += ["n_lines", "n_dup_lines"]
    width = 1
    while width < window:
        d = d.select(*keep, *done, pair_shift("_h", width, lambda x, y: F.xxhash64(x, y)).alias("_h"))
        width *= 2
    # texts without a repeated window leave an empty array: the rest costs them nothing
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.select(*keep, *done, F.when(repeats, F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    twice = F.filter("_s", lambda x, i: F.coalesce(
        (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"]),
        F.get("_s", i - 1)["h"] == x["h"], F.get("_s", i + 1)["h"] == x["h"], F.lit(False)))
    d = d.select(*keep, *done, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_p"))
    covered = F.transform("_p", lambda p, i: F.least(F.lit(window), F.coalesce(F.get("_p", i + 1) - p, F.lit(window))))
    return d.select(*keep, *done, F.coalesce(sum_of(covered), F.lit(0).cast("long")).alias("n_repeat_words"))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def metric_columns() -> dict[str, Column]:
    """The ratios that rules may name, over the columns of ``measure``."""
    return {
        **{m: F.col(m) for m in METRICS},
        "mean_word_chars": _ratio("word_chars", "n_words"),
        "symbol_ratio": _ratio("n_symbols", "word_chars"),
        "stop_ratio": _ratio("n_stop", "n_words"),
        "dup_line_ratio": _ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": F.when(F.col("n_words") > 0, F.col("n_repeat_words") / F.col("n_words")).otherwise(F.lit(0.0)),
    }


def compile_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row breaks, as an array: one expression for the whole table."""
    m = metric_columns()
    broken = []
    for r in rules:
        x, bad = m[r.metric], F.lit(False)
        if r.low is not None:
            bad = bad | (x < F.lit(r.low))
        if r.high is not None:
            bad = bad | (x > F.lit(r.high))
        broken.append(F.when(bad & (F.col("n_words") >= r.from_words), F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def judge(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``measure`` plus base_failed, broken_rules and kept. The share of repeated words is compared in
    whole numbers, so that the bound itself passes exactly."""
    base = (F.col("n_words") < int(BASE_RULES[0].low)) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(round(100 * BASE_RULES[1].high)) * F.col("n_words"))
    d = measure(df, text).withColumns({"base_failed": base, "broken_rules": compile_rules(rules)})
    return d.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def keep_good(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``df`` that pass, with df's own columns."""
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(text).alias("_text"))
    # a filter is moved below deterministic projections, which would put every step of ``measure`` into
    # one expression, over and over; the row number keeps it here
    judged = judge(row, "_text", rules).withColumn("_place", F.monotonically_increasing_id())
    return judged.filter("kept and _place >= 0").select("_row.*")
