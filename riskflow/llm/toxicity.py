"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashed single words, word pairs, and pairs with one or two words between. Learning
goes through a bounded sample of labelled texts, one text at a time, with a learning rate for each coordinate; the L1
term keeps the weights of most features at exactly zero, so the model that is sent out is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import ALPHANUMERIC, Batches, map_batches, mix, ship, stored, text_bytes, text_slices, word_hashes, word_spans

# Labelled texts to learn from, at most: those of the smallest id hashes.
SAMPLE = 10_000
EPOCHS = 5
FEATURE_BITS = 20
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
# Distances between the two words of a pair; 1 is a plain word pair.
DISTANCES = (1, 2, 3)

_MULTIPLIER = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Model:
    bias: float
    index: np.ndarray  # of the features with a weight
    weight: np.ndarray


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text, repeats included, and the text of each."""
    data, ends = text_bytes(texts)
    starts, stops, first = word_spans(data, ends, ALPHANUMERIC)
    words = word_hashes(data, starts, stops, ALPHANUMERIC)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    shift = np.uint64(64 - FEATURE_BITS)
    out, of = [words >> shift], [doc]
    for distance in DISTANCES:
        same = np.flatnonzero(doc[distance:] == doc[:-distance]) if len(doc) > distance else np.zeros(0, np.int64)
        pair = mix(words[same] * _MULTIPLIER + words[same + distance] + np.uint64(distance))
        out.append(pair >> shift)
        of.append(doc[same])
    return np.concatenate(out).astype(np.int64), np.concatenate(of)


def _distinct(features: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort((doc << FEATURE_BITS) | features)
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return keys & ((1 << FEATURE_BITS) - 1), keys >> FEATURE_BITS


def train(examples: Iterator[tuple[np.ndarray, int]], epochs: int) -> Model:
    """FTRL-proximal over (distinct features, label). The bias is a feature of all texts without L1."""
    examples = list(examples)
    size = (1 << FEATURE_BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    l1 = np.full(size, L1)
    l1[-1] = 0

    def weights(index: np.ndarray) -> np.ndarray:
        zi = z[index]
        w = (np.sign(zi) * l1[index] - zi) / ((BETA + np.sqrt(n[index])) / ALPHA + L2)
        return np.where(np.abs(zi) <= l1[index], 0.0, w)

    for _ in range(epochs):
        for index, label in examples:
            index = np.append(index, size - 1)
            w = weights(index)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[index] + gradient * gradient) - np.sqrt(n[index])) / ALPHA
            z[index] += gradient - sigma * w
            n[index] += gradient * gradient
    w = weights(np.arange(size))
    index = np.flatnonzero(w[:-1])
    return Model(float(w[-1]), index, w[index])


def _train_group(epochs: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("id", "ascending")])
        examples = []
        for batch in table.to_batches():
            for part in text_slices(batch, "_text"):
                index, doc = _distinct(*features(part.column("_text")))
                bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
                for i, label in enumerate(part.column("label").to_pylist()):
                    examples.append((index[bounds[i] : bounds[i + 1]].astype(np.int32), label))
        model = train(iter(examples), epochs)
        return pa.table({"feature": pa.array([-1, *model.index.tolist()], pa.int64()), "weight": pa.array([model.bias, *model.weight.tolist()])})

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    epochs: int = EPOCHS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    """Learn from the documents of at most `sample` labelled ids, in one task.

    Labels other than 0 and 1 and null ids are left out; an id with several labels has the greatest. Without labelled
    documents the model gives one half for every text.
    """
    known = labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    by_id = known.groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("label"))
    chosen = stored(by_id.withColumn("order", F.xxhash64("id")).orderBy("order", "id").limit(sample), "sample")
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    examples = rows.join(F.broadcast(chosen), "id")  # `sample` rows
    ship(docs.sparkSession)
    weights = examples.groupBy(F.lit(1).alias("all")).applyInArrow(_train_group(epochs), "feature long, weight double").drop("all")
    found = sorted((r["feature"], r["weight"]) for r in weights.toLocalIterator())  # at most 2^FEATURE_BITS
    if not found:
        return Model(0.0, np.zeros(0, np.int64), np.zeros(0))
    return Model(found[0][1], np.array([f for f, _ in found[1:]], np.int64), np.array([w for _, w in found[1:]]))


def score(docs: DataFrame, model: Model, threshold: float, text_column: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from `threshold` on).

    Null and empty texts have no features and get the score of the bias. Columns of these names are replaced.
    """
    base = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        known = shared.value
        weights = np.zeros(1 << FEATURE_BITS)
        weights[known.index] = known.weight
        for batch in batches:
            for part in text_slices(batch, text_column):
                index, doc = features(part.column(text_column))
                some = weights[index] != 0
                index, doc = _distinct(index[some], doc[some])
                total = known.bias + np.bincount(doc, weights=weights[index], minlength=part.num_rows)
                value = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                columns = [*part.columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "score", "predicted"])

    schema = base.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema
    return map_batches(base, run, schema)
