"""Spark ML pipelines: index and encode categories, assemble the feature vector, fit tree ensembles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskflow import constants as C
from riskflow.sources.published import current_path, publish
from riskflow.sources.storage import stored


def feature_stages(
    categorical_columns: Sequence[str] = tuple(C.CATEGORICAL_COLUMNS),
    numeric_columns: Sequence[str] = tuple(C.NUMERIC_COLUMNS),
) -> list:
    """Stages that turn columns into `features`: encoded categories first, then numbers.

    A row with a missing category, or one unknown at fit time, is skipped. All columns share one indexer and one
    encoder stage, so the categories are counted in a single job.
    """
    categorical = list(categorical_columns)
    indexes, vectors = [f"{c}_index" for c in categorical], [f"{c}_vec" for c in categorical]
    encode = (
        [
            StringIndexer(inputCols=categorical, outputCols=indexes, handleInvalid="skip"),
            OneHotEncoder(inputCols=indexes, outputCols=vectors),
        ]
        if categorical
        else []
    )
    return [*encode, VectorAssembler(inputCols=[*vectors, *numeric_columns], outputCol="features")]


def create_ml_pipelines(
    categorical_columns: Sequence[str] = tuple(C.CATEGORICAL_COLUMNS),
    numeric_columns: Sequence[str] = tuple(C.NUMERIC_COLUMNS),
    label_col: str = C.LABEL_COLUMN,
    seed: int = C.SEED,
) -> dict[str, Pipeline]:
    """A random forest and a gradient-boosted tree pipeline over the same feature stages."""
    classifiers = {"rf_pipeline": RandomForestClassifier, "gbt_pipeline": GBTClassifier}
    return {
        name: Pipeline(
            stages=[
                *feature_stages(categorical_columns, numeric_columns),
                classifier(featuresCol="features", labelCol=label_col, seed=seed),
            ]
        )
        for name, classifier in classifiers.items()
    }


def save_model(model: PipelineModel, path: str) -> None:
    """Publish the model at `path`. If that fails, the one saved before stays."""
    publish(SparkSession.active(), path, lambda target: model.write().save(target))


def load_model(path: str) -> PipelineModel:
    """The latest model published at `path`, or a plain one saved there."""
    return PipelineModel.load(current_path(SparkSession.active(), path))


def model_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(f"{current_path(spark, path)}/metadata")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def evaluate(scored: DataFrame, label_col: str = C.LABEL_COLUMN) -> dict[str, float]:
    """Accuracy, F1 and area under the ROC curve on scored, labelled rows."""
    by_class = MulticlassClassificationEvaluator(labelCol=label_col)
    return {
        "accuracy": by_class.setMetricName("accuracy").evaluate(scored),
        "f1": by_class.setMetricName("f1").evaluate(scored),
        "areaUnderROC": BinaryClassificationEvaluator(labelCol=label_col).evaluate(scored),
    }


def area_under_roc(scored: DataFrame, score_col: str, label_col: str = C.LABEL_COLUMN, ranges: int = 200) -> DataFrame:
    """Exact area under the ROC curve, as one row (area, positives, negatives); null if there is no row of a class.

    Rows are counted by distinct score. Scores are cut into ranges; positives above a score are those of the higher ranges
    plus those above it in its own, so that no window runs over all scores. Rows without a score or class are left out.
    """
    positive = F.col(label_col) == 1
    counts = (
        scored.filter(F.col(score_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(score_col).cast("double").alias("score"))
        .agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"))
    )
    # The range of a score is fixed by being stored.
    cut = stored(stored(counts).repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id()))
    higher = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)  # over `ranges` rows
    totals = cut.groupBy("range").agg(F.sum("p").alias("of_range")).select("range", F.coalesce(F.sum("of_range").over(higher), F.lit(0)).alias("higher"))
    above = Window.partitionBy("range").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.withColumn("own", F.coalesce(F.sum("p").over(above), F.lit(0))).join(F.broadcast(totals), "range")  # `ranges` rows
    # A negative row counts the positives above it, and half of those beside it.
    pairs = F.sum(F.col("n").cast("decimal(20,0)") * (2 * (F.col("own") + F.col("higher")) + F.col("p")).cast("decimal(20,0)"))
    sums = ranked.agg(pairs.alias("pairs"), F.coalesce(F.sum("p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("n"), F.lit(0)).alias("negatives"))
    area = F.try_divide(F.col("pairs").cast("double"), 2.0 * F.col("positives") * F.col("negatives"))
    return sums.select(area.alias("area"), "positives", "negatives")
