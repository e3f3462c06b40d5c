"""Summary tables over the served predictions. Each is one aggregation down to a few rows."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow import constants as C
from riskflow.functions import columns as X
from riskflow.sources.storage import stored


def with_label_name(df: DataFrame, label_col: str = C.LABEL_COLUMN, name_col: str = "label") -> DataFrame:
    return df.withColumn(name_col, X.label_name(F.col(label_col)))


def served_predictions(scored: DataFrame) -> DataFrame:
    """Columns that are served. `scored` has the city."""
    return scored.select(C.SERVED_COLUMNS)


def rows_of_class(df: DataFrame, label: int, label_col: str = C.LABEL_COLUMN) -> DataFrame:
    return df.filter(F.col(label_col) == label)


def average_purchases_by_label(
    df: DataFrame, label_col: str = C.LABEL_COLUMN, value_col: str = "purchases_count"
) -> DataFrame:
    """Mean purchases per class, in the order of the class values. An unknown class is named null."""
    return (
        df.filter(F.col(label_col).isNotNull())
        .groupBy(label_col)
        .agg(F.avg(value_col).alias(value_col))
        .orderBy(label_col)
        .select(X.label_name(F.col(label_col)).alias(label_col), value_col)
    )


def payment_method_fraud_rate(
    df: DataFrame, label_col: str = C.LABEL_COLUMN, group_col: str = "payment_method"
) -> DataFrame:
    """Transactions, frauds and fraud rate in percent per payment method."""
    return (
        df.filter(F.col(group_col).isNotNull())
        .groupBy(group_col)
        .agg(
            F.count(label_col).alias("total_transactions"),
            F.count_if(F.col(label_col) == 1).alias("fraud_count"),
        )
        .withColumn("fraud_rate", F.try_divide("fraud_count", "total_transactions") * 100)
        .orderBy(group_col)
    )


def confusion_matrix(
    df: DataFrame, actual_col: str = C.LABEL_COLUMN, predicted_col: str = "prediction"
) -> DataFrame:
    """Rows per actual class, one column per predicted class; rows with another class value are left out."""
    names = sorted(C.LABEL_NAMES.values())
    return (
        df.select(
            X.label_name(F.col(actual_col)).alias("actual"), X.label_name(F.col(predicted_col)).alias("predicted")
        )
        .filter("actual is not null and predicted is not null")
        .groupBy("actual")
        .agg(*[F.count_if(F.col("predicted") == name).alias(name) for name in names])
        .orderBy("actual")
    )


def purchases_histogram(
    df: DataFrame,
    value_col: str = "purchases_count",
    label_col: str = C.LABEL_COLUMN,
    bins: int = C.HISTOGRAM_BINS,
) -> DataFrame:
    """Equal-width bins over the whole range of the value, in percent of the rows of each class."""
    counts = (
        df.select(X.label_name(F.col(label_col)).alias("label"), F.col(value_col).cast("double").alias("value"))
        .filter("label is not null and value is not null")
        .groupBy("label", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _binned(stored(counts), bins)


def _binned(counts: DataFrame, bins: int) -> DataFrame:
    """Histogram of stored counts (label, value, n)."""
    low, high = counts.agg(F.min("value")).scalar(), counts.agg(F.max("value")).scalar()
    width = (high - low) / F.lit(float(bins))
    number = F.when(width > 0, F.least(F.floor((F.col("value") - low) / width), F.lit(bins - 1))).otherwise(0)
    share = F.col("transactions") / F.sum("transactions").over(Window.partitionBy("label")) * 100
    return (
        counts.withColumns({"bin": number, "bin_start": low + number * width})
        .groupBy("label", "bin", "bin_start")
        .agg(F.sum("n").alias("transactions"))
        .withColumn("percent", share)
    )


# What each summary row counts, by the columns it is grouped by.
BY_CLASSES, BY_METHOD, BY_CLASS, BY_VALUE = "classes", "method", "class", "value"


def dashboard_summary(df: DataFrame) -> DataFrame:
    """Counts and sums from which all marts follow, by one aggregation over grouping sets and so one scan of `df`.

    `df` has is_fraud, prediction, payment_method, purchases_count and the two coordinates. The result has a row for each
    pair of actual and predicted class, each payment method, each class, and each class and number of purchases.
    """
    sets = {BY_CLASSES: ["is_fraud", "prediction"], BY_METHOD: ["payment_method"], BY_CLASS: ["is_fraud"], BY_VALUE: ["is_fraud", "purchases_count"]}
    keys = ["is_fraud", "prediction", "payment_method", "purchases_count"]
    rows = df.select(
        F.col("is_fraud"), F.col("prediction").cast("double").alias("prediction"), "payment_method", F.col("purchases_count").cast("double").alias("purchases_count"),
        F.col("is_fraud").alias("_class"), F.col("purchases_count").cast("double").alias("_purchases"),
        F.col("shipment_location_lat").alias("_lat"), F.col("shipment_location_long").alias("_long"),
    )
    # The number of a set has a bit for each key that it leaves out.
    numbers = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in columns): name for name, columns in sets.items()}
    kind = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col("_set").cast("int")]
    counted = rows.groupingSets([[F.col(c) for c in columns] for columns in sets.values()], *keys).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"), F.count("_class").alias("labelled"), F.count_if(F.col("_class") == 1).alias("frauds"),
        F.sum("_purchases").alias("purchases"), F.count("_purchases").alias("with_purchases"),
        *[f(c).alias(f"{name}{c}") for c in ("_lat", "_long") for f, name in ((F.sum, "sum"), (F.count, "count"))],
    )
    return counted.withColumn("kind", kind).drop("_set")


def dashboard_marts(df: DataFrame, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """All marts of the dashboard as one table: mart, label, item, n, value. `df` is scanned once.

    confusion_matrix: actual and predicted class, rows. fraud_rate: payment method, rows with a class, percent of frauds.
    average_purchases: class, rows, mean. histogram: class, bin, rows, percent of the class. map_center: coordinate, rows
    of class 1, mean (0 without rows). Rows without a known class, method or value are left out where it is grouped by.
    """
    summary = stored(dashboard_summary(df))
    of = lambda kind: summary.filter(F.col("kind") == kind)
    label, none = X.label_name(F.col("is_fraud")), F.lit(None).cast("string")

    def mart(rows: DataFrame, name: str, label: Column, item: Column, n: Column, value: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("mart"), label.alias("label"), item.alias("item"), n.cast("long").alias("n"), value.cast("double").alias("value"))

    predicted = X.label_name(F.col("prediction"))
    pairs = of(BY_CLASSES).filter(label.isNotNull() & predicted.isNotNull())
    methods = of(BY_METHOD).filter("payment_method is not null")
    values = of(BY_VALUE).filter(label.isNotNull() & F.col("purchases_count").isNotNull())
    binned = _binned(values.select(label.alias("label"), F.col("purchases_count").alias("value"), "n"), bins)
    frauds = of(BY_CLASS).filter("is_fraud = 1").agg(*[F.sum(c).alias(c) for c in ("n", "sum_lat", "count_lat", "sum_long", "count_long")])
    centers = [
        mart(frauds, "map_center", none, F.lit(item), F.coalesce("n", F.lit(0)), F.coalesce(F.try_divide(f"sum{c}", f"count{c}"), F.lit(0.0)))
        for item, c in (("latitude", "_lat"), ("longitude", "_long"))
    ]
    tables = [
        mart(pairs, "confusion_matrix", label, predicted, F.col("n"), F.lit(None)),
        mart(methods, "fraud_rate", none, F.col("payment_method"), F.col("labelled"), F.try_divide("frauds", "labelled") * 100),
        mart(of(BY_CLASS).filter("is_fraud is not null"), "average_purchases", label, none, F.col("n"), F.try_divide("purchases", "with_purchases")),
        mart(binned, "histogram", F.col("label"), F.col("bin").cast("string"), F.col("transactions"), F.col("percent")),
        *centers,
    ]
    return reduce(DataFrame.unionByName, tables)


def map_points(df: DataFrame, classes: Collection[int] = (1, 0), label_col: str = C.LABEL_COLUMN) -> DataFrame:
    """Locations of the chosen classes with their colour; no class gives no rows."""
    return (
        df.filter(F.col(label_col).isin(list(classes)) if classes else F.lit(False))
        .select(C.MAP_COLUMNS)
        .withColumn("color", X.label_color(F.col(label_col)))
    )


def map_center(points: DataFrame) -> DataFrame:
    """Mean latitude and longitude, 0 without points."""
    return points.agg(
        F.coalesce(F.avg("shipment_location_lat"), F.lit(0.0)).alias("latitude"),
        F.coalesce(F.avg("shipment_location_long"), F.lit(0.0)).alias("longitude"),
    )
