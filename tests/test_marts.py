"""Summary tables on hand-written and random rows."""

import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import marts

SCORED = "is_fraud int, prediction double, payment_method string, purchases_count bigint"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [
            (0, 0.0, "OVO", 1), (0, 0.0, "OVO", 3), (0, 1.0, None, 5), (1, 1.0, "Gopay", 10), (1, 0.0, "OVO", None),
            (2, 1.0, "Gopay", 7), (None, 0.0, "Gopay", 9), (0, None, "LinkAja", 2),
        ],
        SCORED,
    )


def test_confusion_matrix_leaves_out_unknown_classes(scored):
    assert marts.confusion_matrix(scored).columns == ["actual", "Fraud", "Non-Fraud"]
    assert rows(marts.confusion_matrix(scored)) == [("Fraud", 1, 1), ("Non-Fraud", 1, 2)]


def test_confusion_matrix_keeps_a_class_never_predicted(scored):
    only = scored.filter("prediction = 0")
    assert rows(marts.confusion_matrix(only)) == [("Fraud", 0, 1), ("Non-Fraud", 0, 2)]


def test_average_purchases_skips_nulls_and_names_classes(scored):
    assert rows(marts.average_purchases_by_label(scored)) == [("Non-Fraud", 11 / 4), ("Fraud", 10.0), (None, 7.0)]


def test_fraud_rate_per_payment_method(scored):
    assert rows(marts.payment_method_fraud_rate(scored)) == [
        ("Gopay", 2, 1, 50.0), ("LinkAja", 1, 0, 0.0), ("OVO", 3, 1, 1 / 3 * 100),
    ]


def test_fraud_rate_is_null_without_labels(spark):
    df = spark.createDataFrame([("A", None)], "payment_method string, is_fraud int")
    assert rows(marts.payment_method_fraud_rate(df)) == [("A", 0, 0, None)]


def test_histogram_sums_to_100_per_class(spark):
    rng = random.Random(1)
    data = [(rng.choice([0, 0, 1, 2]), 0.0, "A", rng.choice([None, rng.randrange(300)])) for _ in range(2000)]
    df = spark.createDataFrame(data, SCORED)
    known = [(r[0], r[3]) for r in data if r[0] in (0, 1) and r[3] is not None]
    low, high = min(v for _, v in known), max(v for _, v in known)
    width = (high - low) / 50
    expected = {}
    for label, value in known:
        key = ("Fraud" if label else "Non-Fraud", min(int((value - low) / width), 49))
        expected[key] = expected.get(key, 0) + 1
    got = marts.purchases_histogram(df).collect()
    assert {(r.label, r.bin): r.transactions for r in got} == expected
    for label in ("Fraud", "Non-Fraud"):
        assert sum(r.percent for r in got if r.label == label) == pytest.approx(100)
    assert all(r.bin_start == pytest.approx(low + r.bin * width) for r in got)


def test_histogram_of_one_value_has_one_bin(spark):
    df = spark.createDataFrame([(0, 0.0, "A", 4), (1, 0.0, "A", 4)], SCORED)
    assert sorted(rows(marts.purchases_histogram(df))) == [("Fraud", 0, 4.0, 1, 100.0), ("Non-Fraud", 0, 4.0, 1, 100.0)]


def test_histogram_of_nothing_is_empty(spark):
    assert rows(marts.purchases_histogram(spark.createDataFrame([], SCORED))) == []


@pytest.fixture
def located(spark):
    return spark.createDataFrame(
        [(1.0, 2.0, "a", 1), (3.0, None, "b", 0), (5.0, 6.0, None, 0)],
        "shipment_location_lat double, shipment_location_long double, city string, is_fraud int",
    )


@pytest.mark.parametrize("classes,cities", [((1, 0), ["a", "b", None]), ((1,), ["a"]), ((0,), ["b", None]), ((), [])])
def test_map_points_of_chosen_classes(located, classes, cities):
    got = marts.map_points(located, classes).collect()
    assert [r.city for r in got] == cities
    assert all(r.color == ([255, 0, 0] if r.is_fraud else [0, 0, 255]) for r in got)


def test_map_center_is_zero_without_points(located):
    assert rows(marts.map_center(located)) == [(3.0, 4.0)]
    assert rows(marts.map_center(located.filter(F.lit(False)))) == [(0.0, 0.0)]


def test_label_names(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "is_fraud int")
    assert [r.label for r in marts.with_label_name(df).collect()] == ["Non-Fraud", "Fraud", None, None]


def test_rows_of_class(scored):
    assert marts.rows_of_class(scored, 1).count() == 2


DASHBOARD = "is_fraud int, prediction double, payment_method string, purchases_count long, shipment_location_lat double, shipment_location_long double"


def test_dashboard_marts_are_those_of_the_single_operators(spark):
    rng = random.Random(9)
    pick = lambda *v: rng.choice(v)
    rows = [(pick(0, 0, 1, 2, None), pick(0.0, 1.0, None), pick("a", "b", None), pick(None, *range(90)), pick(None, 1.5, 2.5), pick(None, 8.0)) for _ in range(500)]
    df = spark.createDataFrame(rows, DASHBOARD)
    got = {}
    for r in marts.dashboard_marts(df).collect():
        got.setdefault(r["mart"], {})[r["label"], r["item"]] = (r["n"], None if r["value"] is None else round(r["value"], 9))
    matrix = {(r["actual"], n): (r[n], None) for r in marts.confusion_matrix(df).collect() for n in ("Fraud", "Non-Fraud")}
    assert got["confusion_matrix"] == matrix
    rates = marts.payment_method_fraud_rate(df).collect()
    assert got["fraud_rate"] == {(None, r["payment_method"]): (r["total_transactions"], round(r["fraud_rate"], 9)) for r in rates}
    means = {r["is_fraud"]: round(r["purchases_count"], 9) for r in marts.average_purchases_by_label(df).collect()}
    assert {k[0]: v[1] for k, v in got["average_purchases"].items()} == means
    bins = {(r["label"], str(r["bin"])): (r["transactions"], round(r["percent"], 9)) for r in marts.purchases_histogram(df).collect()}
    assert got["histogram"] == bins
    center = marts.map_center(marts.rows_of_class(df, 1)).first()
    assert [got["map_center"][None, i][1] for i in ("latitude", "longitude")] == [round(center["latitude"], 9), round(center["longitude"], 9)]
    empty = marts.dashboard_marts(df.limit(0)).collect()
    assert [tuple(r)[0] for r in empty] == ["map_center"] * 2 and all(r["value"] == 0 for r in empty)


def test_dashboard_summary_scans_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "1 as is_fraud", "1.0D as prediction", "o_orderpriority as payment_method", "o_custkey as purchases_count", "1.0D as shipment_location_lat", "1.0D as shipment_location_long"
    )
    plan = marts.dashboard_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1
