"""The corpus pipeline: documents through five operators of ``market_engine.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``run`` writes
every stage's rows as Parquet in the shared folder and reads them again for the next, so a lost
executor or driver costs at most one stage. All but the last return the columns of documents.

1. Quality rules: documents that fail the base measures or a threshold go.
2. N-gram Jaccard join: of each group linked by a similarity of 0.8 on five-word shingles, the document
   with the smallest id stays.
3. Substring dedup: passages of 50 words and more that an earlier document has are cut from the text.
4. Benchmark decontamination: documents that hold ten words in a row of a benchmark item go.
5. BPE encoding and decoding: token ids, their number, and the text that they decode to.

Defined results: as the operators'; rows with a null id are judged for quality and benchmark and are never
duplicates; a text that is cut away whole stays as an empty text with no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.llm import parity_join, quality_rules, substring_dedup, trie_bpe, winnowing
from market_engine.llm.common import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return parity_join.keep_first(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.rewrite(docs, size=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = trie_bpe.encode(docs.select("doc_id", "text"), TOKENIZER, decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

#: BPE cannot be expressed in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
