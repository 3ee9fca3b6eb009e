"""Token counts with a digest cache (operator 5).

A document's key is the SHA-256 of its normalised content beside that of the tokenizer file. Normalised means here: null is empty, and
nothing else; any other change of the text could change its ids, and the counts must be those of the text itself. Counts already in the cache come by a
join; of each missing key one text is encoded, and the new counts are appended to the cache before the join reads it.

Defined results: a null text counts as empty (0 tokens); equal texts are encoded once; an empty table gives no rows;
further columns are not looked at. The cache may hold a key twice if two runs append at once; the counts are equal then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import prepare, shared_folder, table, to_batch
from sheaf.llm.tokens import encoder, tokenizer_path

CACHE_DDL = "digest string, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache's rows; none if nothing was ever appended."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_DDL)
    return spark.read.schema(CACHE_DDL).parquet(path)


def _counter(path: str, version: str, library: str):
    schema = pa.schema([("digest", pa.string()), ("tokenizer", pa.string()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if library == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            sizes = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            encode = encoder(path)
            sizes = lambda texts: [len(x) for x in encode.lists(texts)]
        for b in batches:
            yield to_batch({"digest": b.column(0), "tokenizer": [version] * b.num_rows, "n_tokens": sizes(b.column(1).to_pylist())}, schema)

    return count


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; cache: folder of the stored counts, a fresh one if none is named."""
    spark = prepare(docs.sparkSession)
    cache = cache or shared_folder(spark, "token-counts")
    version = tokenizer_digest(tokenizer)
    library = "sentencepiece" if tokenizer.endswith(".model") else "tokenizers"
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest")
    # One text of each key: combined before the shuffle, so copies of a hot text don't travel.
    missing = docs.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    missing.select("digest", "text").mapInArrow(_counter(tokenizer, version, library), CACHE_DDL).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    keys = docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())
