"""Token counts with a digest cache.

The cache is a Parquet table of (digest, tokenizer, n_tokens): the digest of a normalised content and that of the
tokenizer's file and version. Contents are looked up by both; each distinct content that is missing is encoded once and
appended. Counts of contents that certainly occur once, in the input and the cache together, need no shuffle at all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.llm.common import Batches, map_batches, new_path, stored, text_slices
from riskflow.llm.exact_dedup import repeated_cells, with_repeated
from riskflow.llm.tokens import check_byte_level, encoder

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    """The stored counts; none if nothing was stored yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    return spark.createDataFrame([], CACHE_SCHEMA)


def _encoded(rows: DataFrame, vocabulary: str) -> DataFrame:
    """The rows with n_tokens in place of _text."""

    def count(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                counts = encoder(vocabulary).counts(part.column("_text"))
                kept = [part.column(i) for i, n in enumerate(part.schema.names) if n != "_text"]
                names = [n for n in part.schema.names if n != "_text"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts.astype(np.int64))], names=[*names, "n_tokens"])

    schema = rows.drop("_text").withColumn("n_tokens", F.lit(0).cast("long")).schema
    return map_batches(rows, count, schema)


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    limit: int,
    cache_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens. Normalisation for the digest is the identity, since any other would
    change counts. Without `cache_path` the cache is a new table of the work folder.
    """
    spark = docs.sparkSession
    check_byte_level(vocabulary)
    version = tokenizer_digest(vocabulary)
    cache_path = cache_path or new_path(spark, "token-cache")
    # Steps that append must not read what they append to: look the cache up as it is now.
    cache = stored(read_cache(spark, cache_path).filter(F.col("tokenizer") == version).select("digest", "n_tokens").dropDuplicates(["digest"]), "cached")

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("_text")).select(
        "doc_id", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("digest"), F.octet_length("_text").cast("long").alias("n_bytes"), "_text"
    )
    hashed = rows.withColumn("_hash", F.xxhash64("digest"))
    known = hashed.select("_hash").unionByName(cache.select(F.xxhash64("digest").alias("_hash")))
    flagged = with_repeated(hashed, "_hash", stored(repeated_cells(known), "filter"), "_repeated").drop("_hash")

    # Certainly distinct and certainly missing: encoded where they are read.
    single = stored(_encoded(flagged.filter("not _repeated").drop("_repeated"), vocabulary), "single")
    # The others: one text of each digest that the cache does not have.
    repeated = flagged.filter("_repeated")
    misses = repeated.groupBy("digest").agg(F.first("_text").alias("_text")).join(cache, "digest", "left_anti")
    encoded = stored(_encoded(misses, vocabulary), "encoded")

    added = single.select("digest", "n_tokens").unionByName(encoded)
    added.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    counts = stored(encoded.unionByName(cache), "counts")
    looked_up = repeated.select("doc_id", "digest", "n_bytes").join(counts, "digest")
    return (
        single.unionByName(looked_up.select(*single.columns))
        .withColumn("over_limit", F.col("n_tokens") > limit)
        .select("doc_id", "n_bytes", "n_tokens", "over_limit")
    )
