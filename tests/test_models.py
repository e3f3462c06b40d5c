"""Sampling, feature stages, training and evaluation."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskflow import constants as C, registry
from riskflow.operators import ml, sampling, trees
from riskflow.plans import training
from riskflow.sources import storage

ROW = (
    "transaction_id string, payment_method string, age_bin string, account_age bigint, promo_code_used int, "
    "total_amount float, purchases_count bigint, L1_ratio float, total_browsing_time bigint, is_fraud int"
)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    data = []
    for i in range(4000):
        fraud = int(rng.random() < 0.2)
        data.append(
            (f"t{i}", rng.choice(["OVO", "OVO", "Gopay", "Card"]), rng.choice(["20-29", "60+"]), rng.randrange(12),
             rng.randrange(2), rng.uniform(1, 100), rng.randrange(5) + 20 * fraud, rng.uniform(0, 100),
             rng.randrange(500), fraud)
        )
    return spark.createDataFrame(data, ROW)


def keys(df):
    return {r.transaction_id for r in df.select("transaction_id").collect()}


@pytest.mark.parametrize("key", [None, "transaction_id"])
def test_balanced_sample_keeps_all_frauds_and_a_share_of_the_rest(labelled, key):
    odd = labelled.unionByName(labelled.limit(50).withColumn("is_fraud", F.lit(2)))
    sample = sampling.balanced_sample(odd, key=key)
    counts = {r.is_fraud: r["count"] for r in sample.groupBy("is_fraud").count().collect()}
    frauds, clean = (labelled.filter(f"is_fraud = {c}").count() for c in (1, 0))
    assert counts.keys() == {0, 1} and counts[1] == frauds
    assert abs(counts[0] - 0.2 * clean) < 5 * (0.16 * clean) ** 0.5


def test_key_sample_does_not_depend_on_partitioning(labelled):
    samples = [keys(sampling.balanced_sample(labelled.repartition(n), key="transaction_id")) for n in (2, 7)]
    assert samples[0] == samples[1]
    other = keys(sampling.balanced_sample(labelled, key="transaction_id", seed=43))
    assert other != samples[0]


@pytest.mark.parametrize("key", [None, "transaction_id"])
def test_split_is_complete_and_disjoint(labelled, key):
    parts = sampling.split(labelled, [0.5, 0.3, 0.2], key=key)
    sets = [keys(p) for p in parts]
    assert sum(map(len, sets)) == labelled.count() and set.union(*sets) == keys(labelled)
    for part, share in zip(sets, [0.5, 0.3, 0.2]):
        assert abs(len(part) / 4000 - share) < 0.05


def test_balanced_train_test_split_has_the_model_columns(labelled):
    train, test = sampling.balanced_train_test_split(labelled)
    expected = [*C.CATEGORICAL_COLUMNS, *C.NUMERIC_COLUMNS, "is_fraud"]
    assert train.columns == test.columns == expected
    assert 0.7 < train.count() / (train.count() + test.count()) < 0.9


def test_stages_order_and_encoding(spark, labelled):
    model = Pipeline(stages=ml.feature_stages()).fit(labelled)
    row = model.transform(labelled.filter("payment_method = 'OVO' and age_bin = '60+'").limit(1)).first()
    assert row.payment_method_index == 0.0
    # Two of three methods, one of two bins, then the six numbers.
    values = row.features.toArray()
    assert len(values) == 9 and list(values[:2]) == [1.0, 0.0]
    assert list(values[3:]) == [float(row[c]) for c in C.NUMERIC_COLUMNS]


def test_missing_or_unknown_category_skips_the_row(labelled):
    model = Pipeline(stages=ml.feature_stages()).fit(labelled)
    few = labelled.limit(10)
    assert model.transform(few.withColumn("payment_method", F.lit(None).cast("string"))).count() == 0
    assert model.transform(few.withColumn("age_bin", F.lit("new"))).count() == 0


def test_missing_number_raises(labelled):
    model = Pipeline(stages=ml.feature_stages()).fit(labelled)
    bad = labelled.limit(5).withColumn("account_age", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="(?i)null"):
        model.transform(bad).select(vector_to_array("features")).collect()


def test_pipelines_use_the_default_ensembles():
    pipelines = ml.create_ml_pipelines()
    forest, boosted = (pipelines[n].getStages()[-1] for n in ("rf_pipeline", "gbt_pipeline"))
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (20, 5, 42)
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth(), boosted.getSeed()) == (20, 0.1, 5, 42)


def test_train_save_load_and_evaluate(spark, labelled, scratch):
    forest, boosted, test = training.train(labelled, key="transaction_id")
    for model in (forest, boosted):
        scores = ml.evaluate(model.transform(test))
        assert scores["accuracy"] > 0.95 and scores["f1"] > 0.95 and scores["areaUnderROC"] > 0.95
    path = f"{scratch}/saved_model"
    assert not ml.model_exists(spark, path)
    ml.save_model(boosted, path)
    assert ml.model_exists(spark, path)
    columns = ["transaction_id", "prediction", vector_to_array("probability").alias("p")]
    before, after = (m.transform(test).select(columns).orderBy("transaction_id").collect() for m in (boosted, ml.load_model(path)))
    assert before == after


def test_stored_rows_use_the_shared_folder(spark, scratch, tmp_path):
    df = storage.stored(spark.range(5).withColumn("x", F.lit(1)))
    assert df.count() == 5 and f"{scratch}/checkpoints" in df.inputFiles()[0]
    assert "ReadSchema: struct<x:int>" in df.select("x")._jdf.queryExecution().executedPlan().toString()
    other = storage.stored(spark.range(3), str(tmp_path))
    assert str(tmp_path) in other.inputFiles()[0]
    storage.delete_stored(spark, str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_a_cluster_without_a_shared_folder_raises(spark, monkeypatch):
    class Cluster:
        conf = type("conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("sc", (), {"master": "yarn", "applicationId": "a"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.work_dir(Cluster)
    assert storage.work_dir(Cluster, "/shared").startswith("/shared/")


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_trees_as_nodes_score_like_the_model(spark, kind):
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    rng = random.Random(4)
    rows = [(rng.random(), rng.choice("abcd"), rng.randrange(50)) for _ in range(1500)]
    df = spark.createDataFrame([(*r, int(r[0] > 0.6 or r[1] == "c" and r[2] > 20)) for r in rows], "x double, c string, k int, is_fraud int")
    df = StringIndexer(inputCol="c", outputCol="ci").fit(df).transform(df)  # the trees split it by categories
    df = VectorAssembler(inputCols=["x", "ci", "k"], outputCol="features").transform(df)
    model = (GBTClassifier(labelCol="is_fraud", maxIter=5, seed=1) if kind == "gbt" else RandomForestClassifier(labelCol="is_fraud", numTrees=5, seed=1)).fit(df)
    nodes = trees.tree_nodes(model)
    assert any(n.categories for n in nodes)
    x = vector_to_array("features")
    probability = trees.boosted_probability if kind == "gbt" else trees.forest_probability
    scored = model.transform(df).select("x", "ci", "k", vector_to_array("probability")[1].alias("theirs"), probability(nodes, lambda i: x[i]).alias("ours"))
    assert scored.filter("abs(theirs - ours) > 1e-12").isEmpty()
    # The same as SQL text, run by Spark.
    sql = trees.margin_sql(nodes, lambda i: f"cast({['x', 'ci', 'k'][i]} as double)")
    margin = trees.margin(nodes, lambda i: x[i])
    assert model.transform(df).filter(F.abs(margin - F.expr(sql)) > 1e-12).isEmpty()


def brute_area(rows):
    p, n = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in p for b in n) / (len(p) * len(n))


@pytest.mark.parametrize("distinct", [1, 3, 400])
def test_area_under_roc_is_exact(spark, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.3)) for _ in range(600)]
    df = spark.createDataFrame([*rows, (None, 1), (0.5, None)], "score double, is_fraud int")
    found = ml.area_under_roc(df, "score", ranges=7).first()
    assert math.isclose(found["area"], brute_area(rows), rel_tol=1e-12)
    assert (found["positives"], found["negatives"]) == (sum(y for _, y in rows), sum(1 - y for _, y in rows))
    evaluator = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="score", numBins=0)
    assert math.isclose(found["area"], evaluator.evaluate(df.na.drop()), rel_tol=1e-9)


def test_area_under_roc_of_one_class_or_no_rows(spark):
    df = spark.createDataFrame([(0.5, 1), (0.6, 1)], "score double, is_fraud int")
    assert tuple(ml.area_under_roc(df, "score").first()) == (None, 2, 0)
    assert tuple(ml.area_under_roc(df.limit(0), "score").first()) == (None, 0, 0)


def test_the_first_part_needs_one_digest(labelled):
    first, last = sampling.split(labelled, key="transaction_id")
    assert first.count() + last.count() == labelled.count()
    assert first._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


@pytest.mark.parametrize("name", ["held_out_quality", "score_transactions", "rf_train_score"])
def test_training_rows_are_chosen_once(spark, monkeypatch, sf_dir, labelled, name):
    plans = []

    class Pipelines:
        def fit(self, train):
            plans.append(train._jdf.queryExecution().optimizedPlan().toString())
            raise InterruptedError

    class Given(registry.Inputs):
        def model_rows(self):
            return labelled

    monkeypatch.setattr(ml, "create_ml_pipelines", lambda: {"gbt_pipeline": Pipelines(), "rf_pipeline": Pipelines()})
    monkeypatch.setattr(registry, "Inputs", Given)
    with pytest.raises(InterruptedError):
        registry.QUERIES[name](spark, sf_dir)
    assert len(plans) == 1 and "md5" not in plans[0]
