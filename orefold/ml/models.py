"""Classifiers, predictions and accuracy."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.ml.features import FeatureSpec, feature_stages

# Parameters of the two classifiers.
TREE = {"impurity": "entropy", "maxDepth": 3, "minInstancesPerNode": 10, "seed": 42}
BOOSTED = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
           "featureSubsetStrategy": "0.8", "seed": 42}


def decision_tree(**changes) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", **{**TREE, **changes})


def boosted_trees(**changes) -> GBTClassifier:
    return GBTClassifier(labelCol="label", featuresCol="features", **{**BOOSTED, **changes})


def train(df: DataFrame, spec: FeatureSpec, classifier) -> PipelineModel:
    """Feature stages and classifier fitted as one pipeline on a table with ``label``."""
    return Pipeline(stages=[*feature_stages(spec), classifier]).fit(df)


def predict(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with prediction and class probabilities."""
    scored = model.transform(df)
    return scored.select(*keep, "prediction", vector_to_array("probability").alias("probability"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label, as a one-row table."""
    right = F.count_if(F.col(label) == F.col(prediction))
    return df.agg((right.cast("double") / F.count(F.lit(1))).alias("accuracy"))


def feature_names(scored: DataFrame) -> list[str]:
    """Names of the slots of ``features``, from the column's metadata."""
    attrs = scored.schema["features"].metadata["ml_attr"]["attrs"]
    listed = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(listed, key=lambda a: a["idx"])]


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row per feature slot: name and importance in the fitted trees."""
    names = feature_names(model.transform(df.limit(0)))
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(names, weights)), "feature string, importance double")


def tree_rules(model: PipelineModel) -> str:
    """The fitted tree as nested if/else text."""
    return model.stages[-1].toDebugString
