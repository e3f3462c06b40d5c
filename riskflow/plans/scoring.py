"""Scoring: features, model, nearest city, sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskflow import constants as C
from riskflow.operators import geo, marts, ml
from riskflow.plans.features import preprocess_data
from riskflow.plans.training import preprocess_and_train
from riskflow.schemas import SCHEMAS
from riskflow.sources.readers import read_predictions
from riskflow.sources.storage import stored
from riskflow.sources.sinks import write_jdbc, write_parquet


def load_or_train(
    spark: SparkSession,
    training_paths: Mapping[str, str],
    model_path: str,
    schemas: Mapping[str, StructType] = SCHEMAS,
    **train_options: object,
) -> PipelineModel:
    """The saved model; trained first, with the options of `preprocess_and_train`, if there is none."""
    if not ml.model_exists(spark, model_path):
        preprocess_and_train(spark, training_paths, model_path, schemas, **train_options)
    return ml.load_model(model_path)


def score_transactions(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Features with index, vector, probability and prediction columns."""
    return model.transform(features)


def run_scoring(
    spark: SparkSession,
    data_paths: Mapping[str, str],
    training_paths: Mapping[str, str],
    model_path: str,
    places: DataFrame,
    output_path: str,
    jdbc: Mapping[str, object] | None = None,
    schemas: Mapping[str, StructType] = SCHEMAS,
    as_of: dt.date | None = None,
    browsing_events: Sequence[str] = C.BROWSING_EVENTS,
    csv_options: Mapping[str, str] | None = None,
    key: str | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """Score new transactions, write all columns to parquet and, if `jdbc` is given, the served ones to a database.

    The parquet output is the stored form that serving reads, and the served rows are stored as well, so nothing is
    computed twice. Both outputs are replaced as a whole or not at all. `jdbc` holds the arguments of `write_jdbc`. Returns the served predictions. `key` is the column by
    which a first training samples; with it and `as_of` the run can be repeated.
    """
    shared = {"as_of": as_of, "browsing_events": browsing_events, "csv_options": csv_options}
    model = load_or_train(spark, training_paths, model_path, schemas, **shared, key=key, work_dir=work_dir)
    features = preprocess_data(spark, data_paths, schemas, **shared)
    write_parquet(score_transactions(features, model), output_path)
    scored = read_predictions(spark, output_path, view=None)
    cells = geo.place_cells(places, work_dir=work_dir)
    served = stored(marts.served_predictions(geo.add_city_features(scored, cells, work_dir=work_dir)), work_dir)
    if jdbc is not None:
        write_jdbc(served, **{"rows": served.count(), **jdbc})
    return served
