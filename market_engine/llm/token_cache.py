"""Token counts through a digest cache.

The cache is a Parquet table (digest, version, n_tokens). A text's key is the sha256 of its normalised
content, a tokenizer's version the sha256 of its file. Documents join the stored counts by key; of the
digests that are not stored, one text each is encoded, and the new counts are appended for the next
run. So copies are encoded once, texts seen in earlier runs never, and another tokenizer file makes
keys of its own.

Normalising must not change a count: for word tokenizers, which drop white space, texts are trimmed;
for others only null becomes empty.

Texts move once, to meet the choice of one row per missing digest; everything else that moves is
digests and counts. A digest that a third of all rows share is aggregated in part first, and in the
join back its rows are digest and id only.

Defined results: a null text is the empty text with 0 bytes and the tokenizer's count for it; repeated
rows, also with the same id, share a count and keep a row each; a null id counts like any; rows that a
failed and repeated run appended twice are read as one; other columns are ignored; an empty table
appends nothing and gives an empty table.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_engine.llm import trie_bpe
from market_engine.llm.common import SPACE_CHARS, stored

SCHEMA = "digest binary, version string, n_tokens long"


def file_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def by_words(path: str) -> bool:
    """The file is a tokenizer whose words never span white space."""
    try:
        return path.endswith(".json") and bool(trie_bpe.tokenizer(path))
    except (ValueError, KeyError, TypeError):
        return False


def counter(path: str):
    """A function from a list of texts to their token counts, as the file's library gives them."""
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    if by_words(path):
        bpe = trie_bpe.tokenizer(path)
        return lambda texts: [len(x) // 4 for x in bpe.encode(texts)]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda texts: [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def _counts(path: str):
    def work(batches):
        count = counter(path)
        for batch in batches:
            for part in trie_bpe.text_slices(batch, 1):
                yield pa.record_batch([part.column(0), pa.array(count(part.column(1).to_pylist()), pa.int64())],
                                      names=["digest", "n_tokens"])
    return work


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """Stored counts (digest, n_tokens) of a tokenizer version, one row a digest; empty before the first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(SCHEMA).parquet(cache).filter(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(documents: DataFrame, tokenizer: str, cache: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens. Appends the counts of new digests to ``cache``."""
    spark, version = documents.sparkSession, file_version(tokenizer)
    t = F.coalesce(F.col(text), F.lit(""))
    content = F.btrim(t, F.lit(SPACE_CHARS)) if by_words(tokenizer) else t
    row_id = F.struct(F.col(doc_id).alias("id")).alias("row_id")  # in a struct, null ids match too
    docs = documents.select(row_id, content.alias("content"), F.octet_length(t).cast("long").alias("n_bytes"),
                            F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"))
    keys = stored(docs.select("row_id", "digest", "n_bytes"), "digests")
    missing = keys.groupBy("digest").agg(F.min("row_id").alias("row_id")).join(
        read_cache(spark, cache, version), "digest", "left_anti")
    fresh = docs.select("row_id", "digest", "content").join(missing, ["row_id", "digest"]).select("digest", "content").mapInArrow(
        _counts(tokenizer), "digest binary, n_tokens long")
    fresh.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    return keys.join(read_cache(spark, cache, version), "digest").select(F.col("row_id.id").alias("doc_id"), "n_bytes", "n_tokens")
