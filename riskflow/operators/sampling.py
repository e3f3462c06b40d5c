"""Class-balanced sampling and train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskflow import constants as C
from riskflow.functions import columns as X


def balanced_sample(
    df: DataFrame,
    label_col: str = C.LABEL_COLUMN,
    non_fraud_fraction: float = C.NON_FRAUD_FRACTION,
    seed: int = C.SEED,
    key: str | None = None,
) -> DataFrame:
    """All rows of class 1 and a share of class 0, in one pass over `df`.

    With `key` a row is chosen by a hash of its key, so the sample is the same however the data is partitioned.
    """
    label = F.col(label_col)
    if key is None:
        return df.sampleBy(label, fractions={1: 1.0, 0: non_fraud_fraction}, seed=seed)
    return df.filter((label == 1) | ((label == 0) & (X.unit_hash(F.col(key), seed) < F.lit(non_fraud_fraction))))


def split(
    df: DataFrame, weights: Sequence[float] = tuple(C.TRAIN_TEST_SPLIT), seed: int = C.SEED, key: str | None = None
) -> list[DataFrame]:
    """Random split by weights, by key hash if `key` is given."""
    if key is None:
        return df.randomSplit(list(weights), seed=seed)
    position = X.unit_hash(F.col(key), seed, "split:")
    parts, low = [], 0.0
    for number, weight in enumerate(weights):
        high = low + weight / sum(weights)
        lower = position >= F.lit(low)
        # No position is below 0: one test, and so one digest a row, does for the first part.
        inside = lower if number == len(weights) - 1 else position < F.lit(high) if number == 0 else lower & (position < F.lit(high))
        parts.append(df.filter(inside))
        low = high
    return parts


def balanced_train_test_split(
    df: DataFrame,
    categorical_columns: Sequence[str] = tuple(C.CATEGORICAL_COLUMNS),
    numeric_columns: Sequence[str] = tuple(C.NUMERIC_COLUMNS),
    label_col: str = C.LABEL_COLUMN,
    non_fraud_fraction: float = C.NON_FRAUD_FRACTION,
    train_test_split: Sequence[float] = tuple(C.TRAIN_TEST_SPLIT),
    seed: int = C.SEED,
    key: str | None = None,
) -> tuple[DataFrame, ...]:
    """Balanced sample, cut to the model columns and split. A `key` column is kept in the result."""
    sample = balanced_sample(df, label_col, non_fraud_fraction, seed, key).select(
        *([key] if key else []), *categorical_columns, *numeric_columns, label_col
    )
    return tuple(split(sample, train_test_split, seed, key))
