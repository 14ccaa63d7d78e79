"""A fitted tree pipeline as one expression.

The steps of a ``PipelineModel`` (mean imputer, text index, one-hot slots, assembled vector, tree or boosted trees) become
nested CASE expressions over the input columns: text that Spark evaluates inside generated code, without vectors
or an ML runtime, and that other SQL engines run unchanged. The text grows with the model (one CASE branch per tree
node), never with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel
from pyspark.ml.feature import ImputerModel, OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ModelExpression:
    """SQL text for the prediction and for the probability of each class."""

    prediction: str
    probabilities: tuple[str, ...]

    def columns(self) -> tuple[Column, Column]:
        """``prediction`` and ``probability`` as a fitted model's ``transform`` gives them."""
        return (F.expr(self.prediction).cast("double").alias("prediction"),
                F.array(*[F.expr(p).cast("double") for p in self.probabilities]).alias("probability"))

    def score(self, df: DataFrame, *keep: str) -> DataFrame:
        return df.select(*keep, *self.columns())

    def select(self, table: str, *keep: str) -> str:
        """The scoring query as SQL text."""
        listed = [*keep, f"{self.prediction} AS prediction"]
        listed += [f"{p} AS probability_{k}" for k, p in enumerate(self.probabilities)]
        return f"SELECT {', '.join(listed)} FROM {table}"


def _number(value: float) -> str:
    """A double literal that reads back as the same double."""
    text = repr(float(value))
    if text in ("inf", "-inf", "nan"):
        raise ValueError(f"{text} has no literal")
    return f"CAST({text} AS DOUBLE)" if "e" not in text else f"CAST('{text}' AS DOUBLE)"


def _text(value: str) -> str:
    """A text literal; a backslash would be read differently by Spark and by other engines."""
    if "\\" in value:
        raise ValueError("a category with a backslash has no common literal")
    return "concat(" + ", CHR(39), ".join(f"'{part}'" for part in value.split("'")) + ")" if "'" in value else f"'{value}'"


def slots(stages: Sequence) -> list[str]:
    """SQL text of each slot of the assembled vector."""
    columns: dict[str, list[str]] = {}  # output column -> its slots
    labels: dict[str, list[str]] = {}  # indexed column -> categories
    inputs: dict[str, str] = {}  # indexed column -> text column
    for stage in stages:
        if isinstance(stage, ImputerModel):
            filled = stage.surrogateDF.first().asDict()
            for source, out in zip(stage.getInputCols(), stage.getOutputCols()):
                value = f"CAST({source} AS DOUBLE)"
                columns[out] = [f"CASE WHEN {source} IS NULL OR isnan({value}) THEN {_number(filled[source])} ELSE {value} END"]
        elif isinstance(stage, StringIndexerModel):
            for source, out, names in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                labels[out], inputs[out] = list(names), source
        elif isinstance(stage, OneHotEncoderModel):
            for source, out, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes):
                known = [f"CASE WHEN {inputs[source]} = {_text(v)} THEN 1 ELSE 0 END" for v in labels[source]]
                other = " OR ".join(f"{inputs[source]} = {_text(v)}" for v in labels[source])
                everything = [*known, f"CASE WHEN {other} THEN 0 ELSE 1 END" if known else "1"]  # NULL and unseen values
                columns[out] = everything[:size - 1] if stage.getDropLast() else everything[:size]
        elif isinstance(stage, VectorAssembler):
            return [slot for c in stage.getInputCols() for slot in columns.get(c, [f"CAST({c} AS DOUBLE)"])]
    raise ValueError("the pipeline assembles no vector")


def _branches(node, values: Sequence[str], leaf) -> str:
    """Nested CASE of a tree; ``node`` is the JVM tree's node."""
    if node.getClass().getSimpleName() == "LeafNode":
        return leaf(node)
    split = node.split()
    value = values[split.featureIndex()]
    if split.getClass().getSimpleName() == "CategoricalSplit":  # one-hot slots count as categories 0 and 1
        test = f"{value} IN ({', '.join(str(int(c)) for c in split.leftCategories())})"
    else:
        test = f"{value} <= {_number(split.threshold())}"
    left, right = (_branches(n, values, leaf) for n in (node.leftChild(), node.rightChild()))
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def _counts(node) -> list[float]:
    return list(node.impurityStats().stats())


def to_expression(model: PipelineModel) -> ModelExpression:
    """The fitted pipeline's prediction and probabilities over the pipeline's input columns."""
    *before, last = model.stages
    values = slots(before)
    if isinstance(last, DecisionTreeClassificationModel):
        root = last._java_obj.rootNode()

        def share(k: int):
            def leaf(node) -> str:
                counts = _counts(node)
                return _number(counts[k] / sum(counts))
            return leaf

        prediction = _branches(root, values, lambda n: _number(max(range(last.numClasses), key=_counts(n).__getitem__)))
        return ModelExpression(prediction, tuple(_branches(root, values, share(k)) for k in range(last.numClasses)))
    if isinstance(last, GBTClassificationModel):
        margin = " + ".join(
            f"{_number(w)} * {_branches(t._java_obj.rootNode(), values, lambda n: _number(n.prediction()))}"
            for t, w in zip(last.trees, last.treeWeights))
        positive = f"1 / (1 + exp(-2 * ({margin})))"
        return ModelExpression(f"CASE WHEN {margin} > 0 THEN 1 ELSE 0 END", (f"1 - {positive}", positive))
    raise ValueError(f"{type(last).__name__} cannot be written as an expression")
