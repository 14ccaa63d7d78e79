"""Classifier steps on labelled documents: predict quality from length, language, source and a flag.

Gaps follow the data: lengths of Spanish documents and sources of toxic documents count as unknown.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.ml import features, models, tuning
from orefold.ml.expression import to_expression
from orefold.ml.registry import ModelRegistry
from orefold.queries.common import utc
from orefold.session import work_dir
from orefold.sinks.files import write_csv
from orefold.sources.readers import read_csv, read_parquet

NUMERIC = ["n_chars", "n_words"]
CATEGORICAL = ["lang", "source", "toxic"]
SPEC = features.FeatureSpec(NUMERIC, CATEGORICAL)


def documents(spark, folder) -> DataFrame:
    spark = utc(spark)
    labels = read_parquet(spark, folder, "labels")
    texts = read_parquet(spark, folder, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.size(F.split("text", " ")).alias("words"))
    return labels.join(texts, "doc_id").select(
        "doc_id",
        "lang",
        F.when(F.col("toxic") == 0, F.col("source")).alias("source"),
        (F.col("toxic") == 1).alias("toxic"),
        F.when(F.col("lang") != "es", F.col("n_chars")).cast("double").alias("n_chars"),
        F.col("words").cast("double").alias("n_words"),
        (F.col("quality") == 1).alias("quality"),
    )


def cast_flags(spark, folder) -> DataFrame:
    return features.cast_flags(documents(spark, folder), ["toxic", "quality"], ["doc_id"])


def labelled(spark, folder) -> DataFrame:
    """Flags cast, label column added; the flag is used as a category."""
    return features.with_label(cast_flags(spark, folder), "quality").withColumn("toxic", F.col("toxic").cast("string"))


def impute(spark, folder):
    rows = cast_flags(spark, folder)
    return features.imputer(["n_chars"]).fit(rows).transform(rows).select("doc_id", "n_chars", "n_chars_imputed")


def _indexed(spark, folder) -> DataFrame:
    rows = cast_flags(spark, folder)
    return features.indexer(["source"]).fit(rows).transform(rows)


def string_index(spark, folder):
    return _indexed(spark, folder).select("doc_id", "source", "source_indexed")


def one_hot(spark, folder):
    rows = _indexed(spark, folder)
    slots = features.encoder(["source"]).fit(rows).transform(rows).withColumn("slots", vector_to_array("source_ohe"))
    bits = F.transform("slots", lambda x: x.cast("int").cast("string"))
    return slots.select("doc_id", F.concat_ws(",", bits).alias("source_ohe"))


def assembled(spark, folder):
    rows = labelled(spark, folder)
    return features.fit_features(rows, SPEC).transform(rows).select(
        "doc_id", vector_to_array("features").alias("features"))


def _tree(spark, folder):
    rows = labelled(spark, folder)
    return rows, models.train(rows, SPEC, models.decision_tree())


def tree_predict(spark, folder):
    rows, model = _tree(spark, folder)
    return models.predict(model, rows, "doc_id", "label")


def tree_importance(spark, folder):
    rows, model = _tree(spark, folder)
    return models.feature_importance(model, rows)


def split_rows(spark, folder):
    """Every row with the side of the 80/20 split it falls on."""
    train, test = features.split(cast_flags(spark, folder), "doc_id")
    return (train.select("doc_id", F.lit("train").alias("part"))
            .unionByName(test.select("doc_id", F.lit("test").alias("part"))))


# Fixed value: trials of the wider search.
WIDE_TRIALS = 200


def boosted_predict(spark, folder):
    train, test = features.split(labelled(spark, folder), "doc_id")
    model = models.train(train, SPEC, models.boosted_trees())
    return models.predict(model, test, "doc_id", "label")


def rule_accuracy(spark, folder):
    """Accuracy of the rule that calls a document good when it is not toxic."""
    rows = cast_flags(spark, folder).withColumn("prediction", 1 - F.col("toxic"))
    return models.accuracy(rows, "quality", "prediction")


def trials(spark, folder):
    rows = labelled(spark, folder)
    return tuning.search(rows, SPEC, "doc_id", WIDE_TRIALS, tuning.WIDE_SPACE).table(spark)


def top_trials(spark, folder):
    rows = labelled(spark, folder)
    return tuning.search(rows, SPEC, "doc_id").top(spark)


def model_roundtrip(spark, folder):
    """Predictions of a model that was registered and loaded again by name and version."""
    rows, model = _tree(spark, folder)
    registry = ModelRegistry(spark, work_dir(spark, "models"))
    version = registry.register("quality_tree", model, rows, models.TREE, {}, {"kind": "decision tree"})
    return models.predict(registry.load("quality_tree", version), rows, "doc_id", "label")


def score_to_csv(spark, folder):
    """Predictions written as CSV and read back."""
    rows, model = _tree(spark, folder)
    path = work_dir(spark, "scores")
    write_csv(models.predict(model, rows, "doc_id").select("doc_id", F.col("prediction").cast("int").alias("quality")), path)
    return read_csv(spark, path, "doc_id string, quality int")


def tree_expression(spark, folder):
    """Every document scored twice, by the fitted pipeline and by the same model as an expression."""
    rows, model = _tree(spark, folder)
    scored = models.predict(model, rows, "doc_id", "label", *NUMERIC, *CATEGORICAL)
    prediction, probability = to_expression(model).columns()
    return scored.withColumns({"_prediction": prediction, "_probability": probability}).select(
        "doc_id", "label", F.col("prediction").isin(0.0, 1.0).alias("known_class"),
        (F.col("prediction") == F.col("_prediction")).alias("same_prediction"),
        (F.col("probability") == F.col("_probability")).alias("same_probability"),
        (F.col("probability")[F.col("prediction").cast("int")] == F.array_max("probability")).alias("likeliest_class"))


def registered_expression(spark, folder):
    """A registered model, loaded by name and version, against the one in memory and its expression."""
    rows, model = _tree(spark, folder)
    registry = ModelRegistry(spark, work_dir(spark, "models"))
    version = registry.register("quality_tree", model, rows, models.TREE, {}, {"kind": "decision tree"})
    loaded = registry.load("quality_tree", version)
    scored = models.predict(loaded, models.predict(model, rows, "doc_id", *NUMERIC, *CATEGORICAL).withColumnsRenamed(
        {"prediction": "_before", "probability": "_shares"}), "doc_id", "_before", "_shares", *NUMERIC, *CATEGORICAL)
    return scored.select(
        "doc_id", (F.col("prediction") == F.col("_before")).alias("same_prediction"),
        (F.col("probability") == F.col("_shares")).alias("same_probability"),
        F.lit(to_expression(loaded) == to_expression(model)).alias("same_expression"))


def expression_to_csv(spark, folder):
    """Scores of the expression written as CSV and read back, against the pipeline's."""
    rows, model = _tree(spark, folder)
    path = work_dir(spark, "scores")
    found = to_expression(model).score(rows, "doc_id").select("doc_id", F.col("prediction").cast("int").alias("quality"))
    write_csv(found, path)
    told = models.predict(model, rows, "doc_id")
    return read_csv(spark, path, "doc_id string, quality int").join(told, "doc_id").select(
        "doc_id", (F.col("quality") == F.col("prediction")).alias("same_quality"))


def importance_checks(spark, folder):
    """Importances of the fitted tree: one row per slot, not negative, one in sum; slots without a split have none."""
    rows, model = _tree(spark, folder)
    found = models.feature_importance(model, rows)
    slots_used = [s for s in range(found.count()) if f"feature {s} " in models.tree_rules(model)]
    numbered = found.collect()  # one row per slot of the vector
    return found.agg(
        F.count(F.lit(1)).alias("slots"), F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 6).alias("total")).withColumn(
        "unused_with_weight", F.lit(sum(r.importance > 0 for k, r in enumerate(numbered) if k not in slots_used)).cast("bigint"))


QUERIES = {
    "ml_tree_expression": tree_expression,
    "model_registered_expression": registered_expression,
    "score_expression_to_csv": expression_to_csv,
    "ml_importance_checks": importance_checks,
    "ml_cast_flags": cast_flags,
    "ml_impute_mean": impute,
    "ml_string_index": string_index,
    "ml_one_hot": one_hot,
    "ml_features": assembled,
    "ml_tree_predict": tree_predict,
    "ml_feature_importance": tree_importance,
    "ml_split": split_rows,
    "ml_gbt_predict": boosted_predict,
    "ml_accuracy": rule_accuracy,
    "tuning_trials": trials,
    "tuning_top10": top_trials,
    "model_roundtrip": model_roundtrip,
    "score_to_csv": score_to_csv,
}

_DOCS = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN toxic = 0 THEN source END AS source,
    CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS toxic, CASE WHEN lang <> 'es' THEN CAST(n_chars AS DOUBLE) END AS n_chars,
    CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS quality
    FROM labels JOIN documents USING (doc_id)"""
_INDEX = f"""ranked AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS place
      FROM ({_DOCS}) WHERE source IS NOT NULL GROUP BY source),
    indexed AS (SELECT d.doc_id, d.source, coalesce(r.place, (SELECT count(*) FROM ranked)) AS place
      FROM ({_DOCS}) d LEFT JOIN ranked r ON d.source = r.source)"""

ORACLE = {
    "ml_cast_flags": _DOCS,
    "ml_impute_mean": f"""SELECT doc_id, n_chars,
        coalesce(n_chars, (SELECT sum(n_chars) / count(n_chars) FROM ({_DOCS}))) AS n_chars_imputed FROM ({_DOCS})""",
    "ml_string_index": f"WITH {_INDEX} SELECT doc_id, source, CAST(place AS DOUBLE) AS source_indexed FROM indexed",
    "ml_one_hot": f"""WITH {_INDEX} SELECT doc_id, array_to_string(list_transform(
        range(0, (SELECT count(*) FROM ranked)), lambda i: CASE WHEN i = place THEN '1' ELSE '0' END), ',') AS source_ohe
        FROM indexed""",
    "ml_split": f"""SELECT doc_id, CASE WHEN CAST('0x' || substr(md5(doc_id || '|42'), 1, 8) AS BIGINT) % 100 < 80
        THEN 'train' ELSE 'test' END AS part FROM ({_DOCS})""",
    "ml_tree_expression": f"""SELECT doc_id, CAST(quality AS DOUBLE) AS label, TRUE AS known_class, TRUE AS same_prediction,
        TRUE AS same_probability, TRUE AS likeliest_class FROM ({_DOCS})""",
    "model_registered_expression": f"""SELECT doc_id, TRUE AS same_prediction, TRUE AS same_probability, TRUE AS same_expression
        FROM ({_DOCS})""",
    "score_expression_to_csv": f"SELECT doc_id, TRUE AS same_quality FROM ({_DOCS})",
    # two numbers, then a slot per value of each category (the shared one for NULL and unseen values is the last, and left out)
    "ml_importance_checks": f"""SELECT 2 + count(DISTINCT lang) + count(DISTINCT source) + count(DISTINCT toxic) AS slots,
        CAST(0 AS BIGINT) AS negative, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS unused_with_weight FROM ({_DOCS})""",
    "ml_accuracy": f"""SELECT CAST(sum(CASE WHEN 1 - toxic = quality THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy
        FROM ({_DOCS})""",
}
