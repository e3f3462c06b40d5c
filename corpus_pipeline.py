"""A training corpus from `documents`: five stages, each a whole job over what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.llm import decontamination, exact_dedup, jaccard, langid, packing
from riskflow.llm.common import PlainNames, new_path
from riskflow.llm.tokens import VOCABULARY

PIECES = "piece_bpe_32k.model"
# A document whose language is less certain than this is rejected, as is one without letters.
LEAST_SCORE = 0.5
END_ID = 1
WINDOW = 2048

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters or without a clear language."""
    plain = PlainNames(docs)  # columns of any name may be there
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"), 4, 2)), public_tokenizers.path(PIECES))
    predicted = langid.predict(plain.df, model, plain["text"])
    return plain.restored(predicted.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal after lower-casing A-Z: that of the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one_of_each_class(docs, width=5, percent=80)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences: one row per piece."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), END_ID, WINDOW)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("decontamination", clean),
    ("packing", sequences),
]

# SQL expresses neither the first stage (a learned model) nor the last (a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
