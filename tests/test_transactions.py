"""Transaction and customer operators on hand-written rows."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from riskflow.fixtures import input_table
from riskflow.functions import columns as X
from riskflow.operators import skew, transactions as T

AS_OF = dt.date(2024, 6, 30)


def rows(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)


def test_purchases_read_json_like_the_declared_type(spark):
    texts = {
        "one": '[{"product_id":1,"quantity":2,"item_price":100}]',
        "single_quotes": "[{'product_id':1,'quantity':4,'item_price':100}]",
        "none": "[]",
        "empty": "",
        "bad": "bad",
        "null": None,
        "object": '{"product_id":1,"quantity":5,"item_price":100}',
        "fraction": '[{"product_id":1,"quantity":6,"item_price":100.5}]',
        "quoted": '[{"product_id":1,"quantity":"3","item_price":1}]',
        "null_item": "[null]",
        "two": '[{"quantity":1},{"quantity":null},{"quantity":7}]',
    }
    df = spark.createDataFrame(list(texts.items()), "transaction_id string, product_metadata string")
    got = dict(rows(T.purchases(df), "transaction_id", "purchases_count"))
    assert got == {
        "one": 2, "single_quotes": 4, "object": 5, "fraction": 6, "quoted": None, "null_item": None, "two": 8,
    }
    items = {r.transaction_id: r for r in T.transaction_items(df).filter("transaction_id <> 'two'").collect()}
    assert (items["fraction"].quantity, items["fraction"].item_price) == (6, None)


def test_purchases_sum_over_repeated_ids(spark):
    df = spark.createDataFrame(
        [("t", '[{"quantity":2}]'), ("t", '[{"quantity":3}]'), ("u", "bad"), (None, '[{"quantity":9}]')],
        "transaction_id string, product_metadata string",
    )
    assert rows(T.add_purchases_count(df, df), "transaction_id", "purchases_count") == [("t", 5), ("t", 5)]


def test_geolocation_is_null_when_a_part_is(spark):
    df = spark.createDataFrame(
        [(1.5, -2.0), (None, 1.0), (1e-5, 12345678.9)], "shipment_location_lat double, shipment_location_long double"
    )
    got = [r.geolocation for r in T.add_geolocation(df).collect()]
    assert got == ["1.5,-2.0", None, "1.0E-5,1.23456789E7"]


def test_customer_profile_edges(spark):
    step = AS_OF - dt.timedelta(days=365)
    df = spark.createDataFrame(
        [
            (1, "F", step, "2020-01-02"),
            (2, "F", step + dt.timedelta(days=1), "2020-01-02 10:00:00"),
            (3, "M", AS_OF, "notadate"),
            (4, "M", None, None),
        ],
        "customer_id int, gender string, birthdate date, first_join_date string",
    )
    assert rows(T.customer_profile(df, AS_OF), "customer_id", "age", "first_join_year") == [
        (1, 1, 2020), (2, 0, 2020), (3, 0, None), (4, None, None),
    ]


def test_ages_follow_the_clock_without_a_fixed_day(spark):
    born = dt.date.today() - dt.timedelta(days=3650)
    df = spark.createDataFrame([(born,)], "d date")
    assert df.select(X.whole_years(F.col("d"), None)).first()[0] == 10


def test_age_bins(spark):
    ages = [0, 9, 10, 19, 20, 35, 49, 50, 59, 60, 99, None]
    df = spark.createDataFrame([(a,) for a in ages], "age bigint")
    got = [r[0] for r in df.select(X.age_bin(F.col("age"))).collect()]
    assert got == ["<10", "<10", "10-19", "10-19", "20-29", "30-39", "40-49", "50-59", "50-59", "60+", "60+", "60+"]


def test_account_and_promo(spark):
    df = spark.createDataFrame(
        [("2022-07-01", 5, None), ("oops", None, ""), (None, 61, "P")],
        "first_join_date string, age bigint, promo_code string",
    )
    got = [tuple(r)[3:] for r in T.add_account_and_promo_features(df, AS_OF).collect()]
    assert got == [(2, "<10", 0), (None, "60+", 1), (None, "60+", 1)]


def test_labels_are_exact_and_repeat_rows(spark):
    features = spark.createDataFrame([(i,) for i in "abcdefg"] + [(None,)], "transaction_id string")
    labels = spark.createDataFrame(
        [("a", "true"), ("b", "True"), ("c", "false"), ("d", None), ("f", "true"), ("f", "false"), ("f", "true"),
         ("z", "true"), (None, "true")],
        "transaction_id string, is_fraud string",
    )
    expected = [(None, 0), ("a", 1), ("b", 0), ("c", 0), ("d", 0), ("e", 0), ("f", 0), ("f", 1), ("f", 1), ("g", 0)]
    assert rows(T.add_fraud_labels(features, labels), "transaction_id", "is_fraud") == sorted(expected, key=repr)


def test_heavy_label_ids_are_spread(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 8)
    features = spark.createDataFrame([("hot", 1), ("b", 2), ("c", 3)], "transaction_id string, x int")
    labels = spark.createDataFrame(
        [("hot", "true" if i % 4 == 0 else "false") for i in range(200)] + [("b", "true")],
        "transaction_id string, is_fraud string",
    ).repartition(7)
    heavy = skew.heavy_keys(labels, "transaction_id")
    assert T.spread_for_labels(features, heavy).filter("transaction_id = 'hot'").count() == 20
    got = T.add_fraud_labels(features, labels).groupBy("transaction_id", "x", "is_fraud").count()
    assert rows(got, "transaction_id", "x", "is_fraud", "count") == [
        ("b", 2, 1, 1), ("c", 3, 0, 1), ("hot", 1, 0, 150), ("hot", 1, 1, 50),
    ]


def test_dedup_keeps_the_first_row(spark):
    t = dt.datetime(2024, 1, 1)
    day = dt.timedelta(days=1)
    df = spark.createDataFrame(
        [("a", "s2", t, 1, None, 1.0), ("a", "s1", t + day, 1, None, 1.0), ("a", "s1", t, 1, None, 2.0),
         ("b", None, t, 1, None, 3.0), ("b", "s1", t, 1, None, 4.0)],
        "transaction_id string, session_id string, created_at timestamp, customer_id int, product_metadata string, "
        "total_amount double",
    )
    assert rows(T.dedup_transactions(df), "transaction_id", "total_amount") == [("a", 2.0), ("b", 3.0)]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    t = dt.datetime(2024, 1, 1)
    tied = [("a", "s1", t, 1, None, 1.0, method) for method in ("A", "B", "C")]
    schema = (
        "transaction_id string, session_id string, created_at timestamp, customer_id int, product_metadata string, "
        "total_amount float, payment_method string"
    )
    found = set()
    for order in itertools.permutations(tied):
        for parts in (1, 3):
            df = spark.createDataFrame(list(order), schema).repartition(parts)
            found |= {r["payment_method"] for r in T.dedup_transactions(df).collect()}
    assert len(found) == 1


@pytest.mark.parametrize("copies", [1, 7, 8, 9, 25])
def test_repeat_rows_numbers_every_copy(spark, monkeypatch, copies):
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 8)
    df = spark.createDataFrame([("a", copies)], "k string, n bigint")
    assert sorted(r.i for r in skew.repeat_rows(df, "n", "i").collect()) == list(range(1, copies + 1))


def enriched_inputs(spark):
    t = dt.datetime(2024, 1, 1)
    features = spark.createDataFrame(
        [("a", "s1", t, 1, '[{"quantity":1}]', 1.0, 2.0, 3.0), ("a", "s0", t, 9, "x", 1.0, 2.0, 3.0), ("a", "s1", t, 1, None, 1.0, 2.5, 3.0),
         ("b", "s2", t, 1, "y", 4.0, None, 3.0), (None, "s1", t, 1, "z", 5.0, 1.0, 1.0), ("c", None, t, 1, "z", 5.0, 1.0, 1.0)],
        "transaction_id string, session_id string, created_at timestamp, customer_id int, product_metadata string, "
        "total_amount double, shipment_location_lat double, shipment_location_long double",
    )
    times = spark.createDataFrame([("s0", 0), ("s1", 1), ("s2", 2)], "session_id string, hour int")
    customers = spark.createDataFrame([(1, "F", dt.date(1990, 1, 1), "2019-05-05")], "customer_id int, gender string, birthdate date, first_join_date string")
    return features, times, customers


def test_enrichment_keeps_the_first_complete_row(spark):
    found = T.enrich_feature_data(*enriched_inputs(spark), AS_OF)
    assert found.columns == [
        "customer_id", "session_id", "transaction_id", "created_at", "product_metadata", "total_amount", "shipment_location_lat",
        "shipment_location_long", "geolocation", "hour", "age", "first_join_year", "gender", "first_join_date",
    ]
    got = rows(found, "transaction_id", "session_id", "hour", "geolocation")
    assert [r for r in got if r[0] != "a"] == [("b", "s2", 2, None), (None, "s1", 1, "1.0,1.0")]
    assert [r[:3] for r in got if r[0] == "a"] == [("a", "s1", 1)]


def test_item_text_is_not_shuffled_for_a_caller_who_drops_it(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    found = T.enrich_feature_data(*enriched_inputs(spark), AS_OF).drop("product_metadata")
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    lowest = max(i for i, line in enumerate(plan) if "Join Inner" in line)
    assert not any("product_metadata" in line for line in plan[:lowest])
    assert any("xxhash64(product_metadata" in line for line in plan[lowest:])


def test_items_are_dealt_out_as_numbers(spark, tmp_path):
    write = lambda name, data, schema: spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write("lineitem", [(1, 7, 2.0, 10.5), (1, 8, 3.0, 20.0), (None, 9, 1.0, 1.0)], "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double")
    order = (5, "O", 9.5, dt.datetime(2024, 1, 1), "1-URGENT")
    write("orders", [(1, *order), (2, *order)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    df = input_table(spark, str(tmp_path), "transactions")
    found = rows(T.transaction_items(df), "transaction_id", "product_id", "quantity", "item_price")
    assert found == [("1", 7, 2, 10), ("1", 8, 3, 20)]
    assert rows(df.filter("product_metadata is null"), "transaction_id") == [("2",)]
    below = df._jdf.queryExecution().optimizedPlan().toString().split("string_agg", 1)[1]
    assert below.index("concat(") < below.index("RepartitionByExpression [l_orderkey")
