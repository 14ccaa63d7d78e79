"""Fitted tree pipelines as expressions, run by Spark and by another SQL engine."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orefold.ml import features, models
from orefold.ml.expression import to_expression


@pytest.fixture(scope="module")
def passengers(spark):
    n = F.col("id")
    rows = spark.range(400).select(
        n.cast("string").alias("k"), F.when(n % 11 > 0, (n * 37 % 97) / 3).alias("age"), (n * 13 % 29).cast("double").alias("fare"),
        F.when(n % 7 > 0, F.element_at(F.array(*map(F.lit, ("S", "C", "it's", "Q"))), (n % 4 + 1).cast("int"))).alias("port"),
        (((n * 37 % 97 > 40) != (n % 4 == 2)) != (n % 13 == 0)).cast("double").alias("label"))
    return spark.createDataFrame(rows.collect(), rows.schema)


def in_duckdb(expression, rows, *keep):
    db = duckdb.connect()
    db.execute("CREATE TABLE t (k VARCHAR, age DOUBLE, fare DOUBLE, port VARCHAR, label DOUBLE)")
    db.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", [tuple(r) for r in rows.collect()])
    return sorted(db.execute(expression.select("t", *keep)).fetchall())


@pytest.mark.parametrize("drop_last,impute", [(True, True), (False, True)])
def test_tree(spark, passengers, drop_last, impute):
    spec = features.FeatureSpec(["age", "fare"], ["port"], impute, drop_last)
    model = models.train(passengers, spec, models.decision_tree(maxDepth=5, minInstancesPerNode=2))
    expression = to_expression(model)
    unseen = spark.createDataFrame([("u1", None, 3.0, "new", 0.0), ("u2", float("nan"), 8.5, None, 0.0)], passengers.schema)
    rows = passengers.unionByName(unseen)
    expected = sorted((r.k, r.prediction, *r.probability) for r in models.predict(model, rows, "k").collect())
    found = sorted((r.k, r.prediction, *r.probability) for r in expression.score(rows, "k").collect())
    assert found == expected and len({p for _, p, *_ in found}) == 2
    assert in_duckdb(expression, rows, "k") == expected
    plan = expression.score(rows, "k")._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan


def test_boosted_trees(passengers):
    spec = features.FeatureSpec(["age", "fare"], ["port"])
    model = models.train(passengers, spec, models.boosted_trees(maxIter=4, maxDepth=3))
    scored = model.transform(passengers).select("k", "prediction", vector_to_array("probability").alias("p"))
    expected = sorted((r.k, r.prediction, *r.p) for r in scored.collect())
    found = in_duckdb(to_expression(model), passengers, "k")
    assert [(k, float(p)) for k, p, *_ in found] == [(k, p) for k, p, *_ in expected]
    assert all(a[2:] == pytest.approx(b[2:]) for a, b in zip(found, expected))


def test_other_models_are_refused(passengers):
    from pyspark.ml.classification import LogisticRegression
    model = models.train(passengers, features.FeatureSpec(["age"], ["port"]), LogisticRegression(maxIter=1))
    with pytest.raises(ValueError, match="cannot be written"):
        to_expression(model)
