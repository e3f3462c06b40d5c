"""Training: features, balanced sample, split, fit, save."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskflow import constants as C
from riskflow.operators import ml, sampling
from riskflow.plans.features import preprocess_data
from riskflow.schemas import SCHEMAS
from riskflow.sources.storage import stored


def train(
    features: DataFrame,
    categorical_columns: Sequence[str] = tuple(C.CATEGORICAL_COLUMNS),
    numeric_columns: Sequence[str] = tuple(C.NUMERIC_COLUMNS),
    non_fraud_fraction: float = C.NON_FRAUD_FRACTION,
    train_test_split: Sequence[float] = tuple(C.TRAIN_TEST_SPLIT),
    seed: int = C.SEED,
    key: str | None = None,
    work_dir: str | None = None,
) -> tuple[PipelineModel, PipelineModel, DataFrame]:
    """Random forest, gradient-boosted trees and the held-out rows.

    The balanced sample, cut to the model columns, is stored once: every tree level of both fits reads it again.
    """
    sample = stored(
        sampling.balanced_sample(features, C.LABEL_COLUMN, non_fraud_fraction, seed, key).select(
            *([key] if key else []), *categorical_columns, *numeric_columns, C.LABEL_COLUMN
        ),
        work_dir,
    )
    train_rows, test_rows = sampling.split(sample, train_test_split, seed, key)
    pipelines = ml.create_ml_pipelines(categorical_columns, numeric_columns, seed=seed)
    return pipelines["rf_pipeline"].fit(train_rows), pipelines["gbt_pipeline"].fit(train_rows), test_rows


@dataclass(frozen=True)
class Trained:
    """Both fitted models, and the metrics of each on the held-out rows."""

    forest: PipelineModel
    boosted: PipelineModel
    quality: dict[str, dict[str, float]]

    def __iter__(self) -> Iterator[PipelineModel]:
        return iter((self.forest, self.boosted))


def preprocess_and_train(
    spark: SparkSession,
    data_paths: Mapping[str, str],
    model_save_path: str,
    schemas: Mapping[str, StructType] = SCHEMAS,
    categorical_columns: Sequence[str] = tuple(C.CATEGORICAL_COLUMNS),
    numeric_columns: Sequence[str] = tuple(C.NUMERIC_COLUMNS),
    as_of: dt.date | None = None,
    browsing_events: Sequence[str] = C.BROWSING_EVENTS,
    csv_options: Mapping[str, str] | None = None,
    **train_options: object,
) -> Trained:
    """Fit both models on CSV inputs, save the gradient-boosted trees and evaluate both on the held-out rows.

    With a fixed `as_of` and a `key` for sampling, the rows learned from do not depend on the day or on partitioning.
    """
    needed = [*categorical_columns, *numeric_columns, C.LABEL_COLUMN]
    if train_options.get("key"):
        needed = [train_options["key"], *needed]
    features = preprocess_data(spark, data_paths, schemas, as_of, csv_options, browsing_events=browsing_events, columns=needed)
    forest, boosted, held_out = train(features, categorical_columns, numeric_columns, **train_options)
    ml.save_model(boosted, model_save_path)
    scored = {name: model.transform(held_out) for name, model in (("forest", forest), ("boosted", boosted))}
    return Trained(forest, boosted, {name: ml.evaluate(rows) for name, rows in scored.items()})
