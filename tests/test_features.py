"""The fast feature table against the chain of single operators, on messy rows with heavy keys."""

import datetime as dt
import random
import re

import pytest

from riskflow import constants as C
from riskflow.operators import skew
from riskflow.plans import features
from riskflow.plans.features import feature_table, feature_table_stepwise
from riskflow.schemas import SCHEMAS

AS_OF = dt.date(2024, 6, 30)
START = dt.datetime(2024, 3, 1)


def messy_tables(spark, seed, unique):
    rng = random.Random(seed)
    types = ["AP", "ATC", "VC", "SER", "SCR", "HP", "XYZ", None]
    session = lambda: rng.choice(["hot"] * 8 + [None] * 2 + [f"s{rng.randrange(25)}" for _ in range(14)])
    customer = lambda: rng.choice([1] * 8 + [None] + [rng.randrange(30) for _ in range(12)])
    events = [
        (session(), rng.choice(types), START + dt.timedelta(seconds=rng.randrange(200_000)), "WEB", "iOS")
        for _ in range(500)
    ]
    customers = [
        (i, "a", "b", "c", "d", rng.choice("FM"), dt.date(1960 + i, 1, 1) if i % 5 else None,
         rng.choice(["2019-05-05", "bad", None, "2021-01-01"]))
        for i in range(24)
    ] + [(1, "a", "b", "c", "d", "F", dt.date(1990, 1, 1), "2018-08-08")]
    metadata = ['[{"product_id":1,"quantity":2,"item_price":3},{"quantity":5}]', "[]", "bad", None, '[{"quantity":null}]',
                '[{"product_id":4,"quantity":1,"item_price":9}]']
    transactions = []
    for i in range(400):
        key = f"t{i}" if unique else rng.choice(["hot"] * 8 + [None] + [f"t{rng.randrange(120)}" for _ in range(15)])
        transactions.append(
            (START + dt.timedelta(minutes=i), customer(), key, session(), rng.choice(metadata), "Gopay", "Success",
             0.0, rng.choice([None, "P1"]), 1.0, rng.uniform(-80, 80), rng.uniform(-170, 170), float(i), 1)
        )
    labels = [(f"t{rng.randrange(120)}", rng.choice(["true", "false", "True", None])) for _ in range(100)]
    labels += [("hot", "true"), ("t5", "true")] * 40 + [(None, "true")]
    make = lambda data, name: spark.createDataFrame(data, SCHEMAS[name]).repartition(4)
    return (
        make(transactions, "transactions"), make(events, "browsing_behaviour"), make(customers, "customer"),
        make(labels, "fraud_transaction"),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,limit", [(1, 10), (2, 1_000_000)])
def test_fast_equals_stepwise(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    tables = messy_tables(spark, seed, unique=False)
    fast, steps = feature_table(*tables, as_of=AS_OF), feature_table_stepwise(*tables, as_of=AS_OF)
    assert fast.columns == steps.columns == C.FEATURE_COLUMNS
    assert fast.dtypes == steps.dtypes
    got = rows(fast)
    assert len(got) > 60 and got == rows(steps)


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_unique_ids_give_the_same_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", limit)
    tables = messy_tables(spark, 3, unique=True)
    got = rows(feature_table(*tables, as_of=AS_OF, unique_ids=True))
    assert len(got) > 60 and got == rows(feature_table(*tables, as_of=AS_OF))


def test_types_of_the_feature_table(spark):
    types = dict(feature_table(*messy_tables(spark, 1, True), as_of=AS_OF).dtypes)
    expected = {
        "L1_count": "int", "L1_ratio": "float", "start_time": "timestamp", "midpoint_time": "timestamp", "hour": "int",
        "age": "bigint", "first_join_year": "int", "purchases_count": "bigint", "is_fraud": "int",
        "account_age": "bigint", "age_bin": "string", "promo_code_used": "int", "total_browsing_time": "bigint",
        "geolocation": "string", "total_amount": "float",
    }
    assert {k: types[k] for k in expected} == expected


def test_only_named_columns_are_shuffled(spark, tmp_path):
    tables = []
    for number, table in enumerate(messy_tables(spark, 1, True)):
        table.write.parquet(str(tmp_path / str(number)))
        tables.append(spark.read.parquet(str(tmp_path / str(number))))
    df = feature_table(*tables, as_of=AS_OF, columns=["transaction_id", *C.NUMERIC_COLUMNS, "is_fraud"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "traffic_source" not in plan and "first_name" not in plan
    # Columns that are not named are read for the hash that ends ties, and go no further.
    assert not any(re.search("Aggregate|Join|Exchange|Window|Sort", x) for x in plan.splitlines() if "shipment_fee" in x)
    unique = feature_table(*tables, as_of=AS_OF, columns=["transaction_id", *C.NUMERIC_COLUMNS, "is_fraud"], unique_ids=True)
    assert "shipment_fee" not in unique._jdf.queryExecution().executedPlan().toString()


def plan_text(spark, df):
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("keys,expected", [
    (["a", "b", "c"], True), (["a", "b", None], True), (["a", "b", "a"], False), ([None, "a", None], False), ([], True),
])
def test_repeats_are_found(spark, keys, expected):
    assert skew.no_repeats(spark.createDataFrame([(k,) for k in keys], "k string"), "k") is expected


def test_rows_are_merged_only_where_ids_repeat(spark, monkeypatch):
    merged = []
    monkeypatch.setattr(features, "_merged", lambda *args, f=features._merged: merged.append(1) or f(*args))
    once, twice = messy_tables(spark, 3, unique=True), messy_tables(spark, 1, unique=False)
    got = rows(feature_table(*once, as_of=AS_OF))
    assert merged == []
    assert len(got) > 60 and got == rows(feature_table(*once, as_of=AS_OF, unique_ids=False))
    feature_table(*twice, as_of=AS_OF)
    assert merged == [1, 1]


def test_merged_rows_carry_only_what_the_columns_need(spark):
    tables = messy_tables(spark, 1, unique=False)
    few = ["transaction_id", "total_amount", "hour", "age_bin", "is_fraud"]
    table = feature_table(*tables, as_of=AS_OF, columns=few)
    assert rows(table) == rows(feature_table(*tables, as_of=AS_OF).select(few))
    assert "gender" not in plan_text(spark, table).split("Aggregate [transaction_id", 1)[1].split("\n", 1)[0]
    assert "geolocation" not in plan_text(spark, table)
    assert "start_time" not in plan_text(spark, feature_table(*tables, as_of=AS_OF, columns=["transaction_id", "is_fraud"]))
