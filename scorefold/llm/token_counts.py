"""Token counts through a digest cache: equal contents are encoded once, ever."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.components import written
from scorefold.llm.tokens import encoder, file_digest
from scorefold.llm.words import batch_of, slices

CACHE = "tokenizer string, digest binary, n_tokens long"


def normalised(text: Column, tokenizer: str) -> Column:
    """The content that decides the count; white space counts as one space where the tokenizer drops it."""
    if encoder(tokenizer).words_apart:
        return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return text


def token_counts(docs: DataFrame, cache: str, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row; counts of new contents are appended to ``cache``.

    ``cache`` is a Parquet folder of (tokenizer, digest, n_tokens): the SHA-256 of
    the normalised content and of the tokenizer's file.  Copies of a content
    meet per task first and then by digest, so each unknown content is encoded
    once; a run over known contents encodes nothing.  NULL is the empty text
    with zero tokens; NULL ids and repeated rows stay as they are.
    """
    spark = docs.sparkSession
    version = file_digest(tokenizer)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    body = normalised(F.col("text"), tokenizer)
    digest = F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest")
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version).select("digest")
    contents = plain.select(digest, body.cast("binary").alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = contents.join(known.distinct(), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch, texts in slices(batches, "text"):
            counts = [len(ids) // 4 for ids in encode(texts)]
            yield batch_of(["digest", "n_tokens"], batch.column("digest"), pa.array(counts, pa.int64()))

    (misses.mapInArrow(encode, "digest binary, n_tokens long").withColumn("tokenizer", F.lit(version))
     .write.mode("append").partitionBy("tokenizer").parquet(cache))
    # Two runs at once may both add a content.  Written, so that the join below can split a digest of very many rows.
    counts = written(spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
                     .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token_counts")
    return plain.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest).join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens")
