import pytest
from pyspark.sql import functions as F

from orefold.ml import features, models, tuning
from orefold.ml.registry import ModelRegistry


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, None if i % 9 == 0 else float(i % 50), None if i % 7 == 0 else "abc"[i % 3], i % 50 > 20)
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, age double, home string, moved boolean")
    return features.with_label(features.cast_flags(df, ["moved", "absent"], ["id"]), "moved")


SPEC = features.FeatureSpec(["age"], ["home"])


def test_casts_and_type_split(people):
    assert dict(people.dtypes)["moved"] == "int" and dict(people.dtypes)["id"] == "string"
    spec = features.FeatureSpec.from_types(people, exclude=["id", "label", "moved"])
    assert (list(spec.numeric), list(spec.categorical)) == (["age"], ["home"])


def test_unknown_category_slot(people):
    kept = features.fit_features(people, features.FeatureSpec(["age"], ["home"], drop_last=False)).transform(people)
    dropped = features.fit_features(people, SPEC).transform(people)
    missing = F.col("home").isNull()
    assert kept.filter(missing).first().home_ohe.toArray().tolist() == [0.0, 0.0, 0.0, 1.0]
    assert dropped.filter(missing).first().home_ohe.toArray().tolist() == [0.0, 0.0, 0.0]


def test_split_does_not_depend_on_partitions(people):
    train, test = features.split(people, "id")
    again, _ = features.split(people.repartition(7), "id")
    ids = {r.id for r in train.select("id").collect()}
    assert ids == {r.id for r in again.select("id").collect()}
    assert train.count() + test.count() == people.count() and 0.7 < train.count() / people.count() < 0.9


def test_tree_learns_and_survives_the_registry(spark, people, tmp_path):
    model = models.train(people, SPEC, models.decision_tree())
    scored = models.predict(model, people, "id", "label")
    assert models.accuracy(scored).first().accuracy > 0.9
    importance = {r.feature: r.importance for r in models.feature_importance(model, people).collect()}
    assert importance["age_imputed"] > 0.8
    assert "feature 0 <=" in models.tree_rules(model)
    registry = ModelRegistry(spark, str(tmp_path / "models"))
    assert registry.register("tree", model, people, models.TREE, {"accuracy": 0.95}, {"note": "first"}) == 1
    assert registry.register("tree", model, people) == 2
    assert registry.versions("tree") == [1, 2]
    loaded = models.predict(registry.load("tree", 1), people, "id", "label")
    assert sorted(map(str, loaded.collect())) == sorted(map(str, scored.collect()))
    first = registry.describe("tree").first()
    assert (first.params["impurity"], first.metrics["accuracy"], first.tags["note"]) == ("entropy", 0.95, "first")
    assert "age" in registry.input_columns("tree", 1)
    with pytest.raises(LookupError):
        registry.load("tree", 5)


def test_boosted_trees_without_imputation(people):
    spec = features.FeatureSpec(["age"], ["home"], impute=False, drop_last=False)
    rows = people.filter("age is not null")
    model = models.train(rows, spec, models.boosted_trees(maxIter=3))
    assert models.accuracy(models.predict(model, rows, "label")).first().accuracy > 0.9


def test_search_records_failures_and_repeats(spark, people, monkeypatch):
    first = tuning.search(people, SPEC, "id", trials=3, folds=2)
    again = tuning.search(people, SPEC, "id", trials=3, folds=2)
    assert [(t.params, t.value) for t in first.trials] == [(t.params, t.value) for t in again.trials]
    assert first.best.value > 0.9 and first.failed == 0
    real = tuning.classifier
    monkeypatch.setattr(tuning, "classifier", lambda p: real({**p, "maxDepth": 99}) if p["maxDepth"] < 20 else real(p))
    mixed = tuning.search(people, SPEC, "id", trials=4, space=tuning.WIDE_SPACE, folds=2)
    assert mixed.failed == mixed.table(spark).filter("state = 'FAIL'").count() > 0
    assert mixed.top(spark, 10).count() == 4 - mixed.failed


def test_registered_queries_run_the_whole_search(spark, sample, monkeypatch):
    from orefold.queries import learning

    seen = []
    monkeypatch.setattr(models, "train", lambda rows, spec, classifier: seen.append(classifier.getMaxIter()))
    monkeypatch.setattr(models, "predict", lambda *a: None)
    learning.boosted_predict(spark, sample)
    assert seen == [models.BOOSTED["maxIter"]] == [300]
    monkeypatch.setattr(tuning, "classifier", lambda params: None)  # every trial fails at once, and is counted
    assert learning.trials(spark, sample).count() == 200
    search = tuning.search
    monkeypatch.setattr(tuning, "search", lambda *a: seen.append(len(search(*a).trials)) or tuning.Study())
    learning.top_trials(spark, sample)
    assert seen[1:] == [100]


def test_search_scores_as_a_cross_validator_with_shared_fits(spark, monkeypatch):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = spark.createDataFrame(
        [(i, float(i * 37 % 101), "abcd"[i * 7 % 4], float((i * 37 % 101 > 40) ^ (i * 7 % 4 == 1) ^ (i % 31 == 0))) for i in range(200)],
        "id int, age double, home string, label double")
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    real, fits = tuning.classifier, []
    ready = features.fit_features(rows, SPEC).transform(rows).select(
        "features", "label", features.bucket("id", 42, 2).cast("int").alias("fold"))

    class Counted:
        def __init__(self, params):
            self.inner = real(params)

        def fit(self, data):
            fits.append(1)
            return self.inner.fit(data)

    narrow = tuning.Space(depth=(3, 7), leaf_share=(1e-6, 1e-2))
    wide = tuning.Space(depth=(3, 7), min_gain=(0.0, 0.05), feature_choices=("sqrt", "all"))
    for space, trials, most in ((narrow, 5, 9), (wide, 3, 6)):  # one fit for each trial and fold, if none were shared
        fits.clear()
        monkeypatch.setattr(tuning, "classifier", Counted)
        study = tuning.search(rows, SPEC, "id", trials=trials, space=space, folds=2)
        assert study.failed == 0 and 2 <= len(fits) <= most
        for trial in study.trials:
            cv = CrossValidator(estimator=real(trial.params), estimatorParamMaps=ParamGridBuilder().build(),
                                evaluator=evaluator, numFolds=2, foldCol="fold")
            assert trial.value == float(cv.fit(ready).avgMetrics[0]), trial.params


def test_search_with_an_empty_fold_fails_every_trial(spark, people):
    study = tuning.search(people.filter("id = '1'"), SPEC, "id", trials=3, folds=2)
    assert study.failed == 3 and "empty" in study.trials[0].error
