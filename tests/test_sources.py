"""Readers, sinks and the whole scoring run from CSV files."""

import csv
import datetime as dt
import os
import random

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow import constants as C
from riskflow.plans import scoring
from riskflow.plans.features import preprocess_data
from riskflow.plans.training import preprocess_and_train
from riskflow.schemas import SCHEMAS
from riskflow.sources import published, readers, sinks


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_schema_is_applied_by_position(spark, tmp_path):
    path = write(tmp_path / "a.csv", "is_fraud,transaction_id\nt1,true\nt2\n,false\n")
    df = readers.read_csv(spark, path, SCHEMAS["fraud_transaction"])
    assert [tuple(r) for r in df.collect()] == [("t1", "true"), ("t2", None), (None, "false")]


def test_without_schema_every_column_is_a_string(spark, tmp_path):
    path = write(tmp_path / "a.csv", "transaction_id,is_fraud\n1,true\n")
    df = readers.read_labels(spark, path)
    assert df.dtypes == [("transaction_id", "string"), ("is_fraud", "string")]


def test_json_fields(spark, tmp_path):
    head = ",".join(SCHEMAS["transactions"].names)
    single = "2024-01-01 00:00:00,1,t,s,\"[{'product_id':1,'quantity':2}]\",Gopay,Success,0,,1,1.5,2.5,9,1"
    doubled = single.replace("'", '""')
    one = readers.read_csv(spark, write(tmp_path / "a.csv", f"{head}\n{single}\n"), SCHEMAS["transactions"]).first()
    assert one.product_metadata == "[{'product_id':1,'quantity':2}]" and one.clear_payment == 1
    path = write(tmp_path / "b.csv", f"{head}\n{doubled}\n")
    two = readers.read_csv(spark, path, SCHEMAS["transactions"], escape='"').first()
    assert two.product_metadata == '[{"product_id":1,"quantity":2}]' and two.promo_code is None


def test_load_data_skips_unknown_names_and_raises_on_missing_paths(spark, tmp_path, capsys):
    path = write(tmp_path / "a.csv", "category_id,cat_level1,cat_level2,cat_level3\n1,a,b,c\n")
    tables = readers.load_data(spark, {"category": path, "other": path})
    assert list(tables) == ["category"] and tables["category"].first().category_id == 1
    assert "other" in capsys.readouterr().out
    with pytest.raises(AnalysisException):
        readers.load_data(spark, {"category": str(tmp_path / "none.csv")})


def test_parquet_is_replaced_and_read_as_a_view(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(5), path)
    sinks.write_parquet(spark.range(3), path)
    readers.read_predictions(spark, path)
    assert readers.fetch_data(spark, "select count(*) as n from predictions").first().n == 3


def test_a_failed_write_leaves_the_old_data(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_parquet(spark.range(5), path)
    before = readers.read_predictions(spark, path, view=None)
    # Some tasks write their files before another fails.
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_parquet(broken, path)
    assert before.count() == readers.read_predictions(spark, path, view=None).count() == 5
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 1
    # The same data may be read and replaced; who still reads the version before can end; older ones go.
    sinks.write_parquet(readers.read_predictions(spark, path, view=None).union(spark.range(2)), path)
    assert (before.count(), readers.read_predictions(spark, path, view=None).count()) == (5, 7)
    sinks.write_parquet(spark.range(1), path)
    assert published.published_versions(spark, path)[0] == published.current_path(spark, path)
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 2
    assert readers.read_predictions(spark, path, view=None).count() == 1


def test_a_failure_between_write_and_pointer_leaves_the_old_data(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    sinks.write_parquet(spark.range(5), path)

    def fail(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(published, "_move_pointer", fail)
    with pytest.raises(OSError):
        sinks.write_parquet(spark.range(3), path)
    assert readers.read_predictions(spark, path, view=None).count() == 5


def test_plain_parquet_is_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(4).write.parquet(path)
    assert readers.read_predictions(spark, path, view=None).count() == 4
    sinks.write_parquet(spark.range(2), path)
    assert readers.read_predictions(spark, path, view=None).count() == 2


BROKEN = "id,day,amount\n1,2024-01-02,1.5\nx,2024-01-02,1.5\n2,never,2\n3,,\n4,2024-01-02\n5,2024-01-02,1,9\n,,\n6,2024-01-02,2\n"


def test_bad_rows_are_kept_apart_and_counted(spark, tmp_path):
    path = write(tmp_path / "a.csv", BROKEN)
    schema = StructType().add("id", "integer").add("day", "date").add("amount", "float")
    found = readers.read_checked_csv(spark, path, schema)
    day = dt.date(2024, 1, 2)
    assert found.good.dtypes == [("id", "int"), ("day", "date"), ("amount", "float")]
    assert sorted(map(tuple, found.good.collect()), key=repr) == sorted([(1, day, 1.5), (3, None, None), (None, None, None), (6, day, 2.0)], key=repr)
    assert sorted(r["line"] for r in found.bad.collect()) == ["2,never,2", "4,2024-01-02", "5,2024-01-02,1,9", "x,2024-01-02,1.5"]
    assert all(r["file"].endswith("a.csv") for r in found.bad.collect())
    assert (found.good_count, found.bad_count) == (4, 4)
    assert found.good.select("id").count() == 4  # a pruned read has the same rows
    with pytest.raises(ValueError, match="4 of 8 rows"):
        readers.read_checked_csv(spark, path, schema, max_bad_share=0.4)


def test_checked_rows_of_odd_files(spark, tmp_path):
    schema = StructType().add("_line", "string").add("_file", "integer")
    found = readers.read_checked_csv(spark, write(tmp_path / "a.csv", "_line,_file\na,1\nb,z\n"), schema)
    assert [tuple(r) for r in found.good.collect()] == [("a", 1)] and found.bad.first()["line"] == "b,z"
    empty = readers.read_checked_csv(spark, write(tmp_path / "b.csv", "_line,_file\n"), schema, max_bad_share=0.0)
    assert (empty.good.count(), empty.bad.count(), empty.good_count, empty.bad_count) == (0, 0, 0, 0)
    untyped = readers.read_checked_csv(spark, write(tmp_path / "c.csv", "t,f\n1,true\n2\n"))
    assert [tuple(r) for r in untyped.good.collect()] == [("1", "true")] and untyped.bad_count == 1


def test_features_leave_bad_rows_out(spark, csv_inputs, tmp_path):
    with open(csv_inputs["transactions"]) as f:
        text = f.read()
    path = write(tmp_path / "t.csv", text + "not a time,x\n")
    inputs = {**csv_inputs, "transactions": path}
    checked = preprocess_data(spark, inputs, max_bad_share=0.1, work_dir=str(tmp_path))
    assert checked.exceptAll(preprocess_data(spark, csv_inputs)).count() == 0 and checked.count() == 400
    with pytest.raises(ValueError, match="1 of 401 rows"):
        preprocess_data(spark, inputs, max_bad_share=0.001, work_dir=str(tmp_path))


class Recorder:
    """Stands for DataFrame.write or SparkSession.read; keeps what it was called with."""

    def jdbc(self, *args, **kwargs):
        self.call = (args, kwargs)
        return self

    def createOrReplaceTempView(self, name):
        self.view = name


class Database:
    """Stands for a connection; keeps the statements that were committed."""

    def __init__(self, rows=3, fails=""):
        self.rows, self.fails, self.open, self.committed, self.asked = rows, fails, [], [], []

    def setAutoCommit(self, on):
        assert not on

    def createStatement(self):
        return self

    def execute(self, text):
        if self.fails and self.fails in text:
            raise OSError(text)
        self.open.append(text)

    def executeQuery(self, text):
        self.asked.append(text)
        return self

    def next(self):
        return True

    def getLong(self, column):
        return self.rows

    def commit(self):
        self.committed, self.open = self.committed + self.open, []

    def rollback(self):
        self.open = []

    def close(self):
        pass


def frame_for(writer):
    return type("D", (), {"write": writer, "sparkSession": None, "repartition": lambda self, n: setattr(writer, "tasks", n) or self})()


@pytest.mark.parametrize("url", ["jdbc:postgresql://h/d", "jdbc:mysql://h/d"])
def test_a_table_is_staged_and_swapped(monkeypatch, url):
    # No database is started for tests; this checks what Spark and the database are asked to do.
    writer, database = Recorder(), Database()
    monkeypatch.setattr(sinks, "connect", lambda *_: database)
    sinks.write_jdbc(frame_for(writer), url, "shop.predictions", {"user": "u"}, connections=4, rows=3)
    (_, staged), options = writer.call
    assert staged.startswith("shop.predictions_new_") and writer.tasks == 4
    assert options == {"mode": "overwrite", "properties": {"batchsize": "10000", "user": "u"}}
    assert database.asked == [f"SELECT COUNT(*) FROM {staged}"]
    if "mysql" in url:
        assert database.committed[1] == f"RENAME TABLE shop.predictions TO {staged}_old, {staged} TO shop.predictions"
    else:
        assert database.committed == ["DROP TABLE IF EXISTS shop.predictions", f"ALTER TABLE {staged} RENAME TO predictions"]


@pytest.mark.parametrize("fault", ["write", "rows", "swap"])
def test_a_failed_run_leaves_the_old_table(monkeypatch, fault):
    writer, database = Recorder(), Database(rows=6 if fault == "rows" else 3, fails="ALTER" if fault == "swap" else "")
    monkeypatch.setattr(sinks, "connect", lambda *_: database)
    if fault == "write":
        def fail(url, table, **_):
            writer.call = ((url, table), {})
            raise RuntimeError("task failed")

        writer.jdbc = fail
    with pytest.raises((RuntimeError, OSError)):
        sinks.write_jdbc(frame_for(writer), "jdbc:postgresql://h/d", rows=3)
    assert database.committed == [f"DROP TABLE IF EXISTS {writer.call[0][1]}"]  # never the table itself


def test_jdbc_read_options():
    reader = Recorder()
    readers.read_jdbc(
        type("S", (), {"read": reader})(), "jdbc:x", properties={"user": "u"}, column="clear_payment", lowerBound=0,
        upperBound=1, numPartitions=2,
    )
    assert reader.call == (
        ("jdbc:x", "predictions"),
        {"properties": {"user": "u"}, "column": "clear_payment", "lowerBound": 0, "upperBound": 1, "numPartitions": 2},
    )
    assert reader.view == "predictions"
    session = type("S", (), {"read": reader})()
    readers.read_jdbc(session, "jdbc:x", connections=5)
    assert len(reader.call[1]["predicates"]) == 5
    readers.read_jdbc(session, "jdbc:x", one_connection=True)
    assert reader.call == (("jdbc:x", "predictions"), {"properties": {}})


def test_buckets_cover_a_table_once():
    con = duckdb.connect()
    con.execute("create table t as select 'id' || range as transaction_id from range(3000) union all select null union all select ''")
    counts = [con.execute(f"select count(*) from t where {p}").fetchall()[0][0] for p in readers.bucket_predicates("transaction_id", 16)]
    assert sum(counts) == 3002 and max(counts) < 2 * 3002 / 16


@pytest.fixture(scope="module")
def csv_inputs(scratch):
    rng = random.Random(9)
    start = dt.datetime(2024, 5, 1)
    folder = f"{scratch}/csv"
    os.makedirs(folder)

    def save(name, schema, data):
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(SCHEMAS[schema].names)
            out.writerows(data)
        return f"{folder}/{name}.csv"

    customers = [(i, "a", "b", "c", "d", "F", dt.date(1960 + i, 1, 1), "2020-01-02") for i in range(30)]
    transactions, events, labels = [], [], []
    for i in range(400):
        fraud = i % 4 == 0
        quantity = rng.randrange(1, 4) + (30 if fraud else 0)
        metadata = "[{'product_id': 1, 'quantity': %d, 'item_price': 5}]" % quantity
        time = start + dt.timedelta(minutes=i)
        transactions.append(
            (time, rng.randrange(30), f"t{i}", f"s{i}", metadata, rng.choice(["Gopay", "OVO"]), "Success", 0,
             rng.choice(["", "P"]), 1, rng.uniform(-60, 60), rng.uniform(-170, 170), rng.uniform(1, 90), 1)
        )
        events += [(f"s{i}", kind, time + dt.timedelta(seconds=s), "WEB", "iOS") for kind, s in [("HP", 0), ("SCR", 9), ("ATC", 20)]]
        if fraud or i % 3:
            labels.append((f"t{i}", "true" if fraud else "false"))
    return {
        "customer": save("customer", "customer", customers),
        "transactions": save("transactions", "transactions", transactions),
        "browsing_behaviour": save("browsing_behaviour", "browsing_behaviour", events),
        "fraud_transaction": save("fraud_transaction", "fraud_transaction", labels),
    }


def test_preprocess_from_csv(spark, csv_inputs):
    df = preprocess_data(spark, csv_inputs)
    assert df.columns == C.FEATURE_COLUMNS
    assert df.count() == 400
    row = df.filter("transaction_id = 't4'").first()
    assert (row.L1_count, row.L3_count, row.total_browsing_time, row.is_fraud) == (1, 2, 9, 1)
    assert row.purchases_count > 30


def test_scoring_run(spark, csv_inputs, scratch, monkeypatch):
    places = spark.createDataFrame([("east", 0.0, 90.0), ("west", 0.0, -90.0)], "city string, lat double, lon double")
    sent = {}
    monkeypatch.setattr(scoring, "write_jdbc", lambda df, **options: sent.update(df=df, options=options))
    model, output = f"{scratch}/gbt", f"{scratch}/predictions"
    served = scoring.run_scoring(
        spark, csv_inputs, csv_inputs, model, places, output, jdbc={"url": "jdbc:x", "table": "predictions"}
    )
    assert served.columns == C.SERVED_COLUMNS and sent["df"] is served and sent["options"] == {"url": "jdbc:x", "table": "predictions", "rows": 400}
    rows = served.collect()
    assert len(rows) == 400
    assert all(r.city == ("east" if r.shipment_location_long > 0 else "west") for r in rows)
    assert sum(r.prediction == r.is_fraud for r in rows) > 380
    stored = readers.read_predictions(spark, output)
    assert {*C.FEATURE_COLUMNS, "probability", "prediction", "payment_method_index", "age_bin_vec"} <= set(stored.columns)
    assert "city" not in stored.columns

    def fail(*_, **__):
        raise AssertionError("trained again")

    monkeypatch.setattr(scoring, "preprocess_and_train", fail)
    scoring.load_or_train(spark, csv_inputs, model)


def test_runs_can_be_repeated(spark, csv_inputs, scratch, tmp_path):
    places = spark.createDataFrame([("east", 0.0, 90.0), ("west", 0.0, -90.0)], "city string, lat double, lon double")
    found = []
    for parts in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        served = scoring.run_scoring(
            spark, csv_inputs, csv_inputs, f"{scratch}/again{parts}", places, f"{scratch}/scored{parts}",
            as_of=dt.date(2024, 6, 30), key="transaction_id", csv_options={"escape": '"'}, work_dir=str(tmp_path),
        )
        found.append(sorted(map(repr, served.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_training_returns_held_out_quality(spark, csv_inputs, scratch):
    trained = preprocess_and_train(spark, csv_inputs, f"{scratch}/quality", key="transaction_id")
    assert trained.quality["boosted"]["areaUnderROC"] > 0.9 and trained.quality["forest"]["accuracy"] > 0.8
    assert len(list(trained)) == 2
