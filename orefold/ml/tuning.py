"""Random hyper-parameter search with k-fold cross-validation.

Every trial is fitted on the whole table with Spark ML, fold by fold; trials run a few at a time so the cluster stays
busy between the stages of one fit, and trials whose parameters make the same tree share it. Tree parameters without a Spark counterpart (smallest node to
split, cost-complexity pruning) are left out; depth is capped at 30, Spark's limit.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.ml.features import FeatureSpec, bucket, fit_features
from orefold.ml.models import decision_tree

MAX_DEPTH = 30
TRIAL_SCHEMA = "number int, state string, value double, params string, error string"


@dataclass(frozen=True)
class Space:
    """Search ranges; ``log`` ranges are drawn evenly on a logarithmic scale."""

    depth: tuple[int, int] = (3, MAX_DEPTH)
    leaf_share: tuple[float, float] = (1e-6, 1e-3)
    min_gain: tuple[float, float] | None = None
    feature_choices: tuple[str, ...] = ()

    def draw(self, rng: random.Random) -> dict[str, object]:
        def log_even(low: float, high: float) -> float:
            return math.exp(rng.uniform(math.log(low), math.log(high)))

        out: dict[str, object] = {
            "maxDepth": round(log_even(*self.depth)),
            "minWeightFractionPerNode": log_even(*self.leaf_share),
        }
        if self.min_gain:
            out["minInfoGain"] = rng.uniform(*self.min_gain)
        if self.feature_choices:
            out["featureSubsetStrategy"] = rng.choice(self.feature_choices)
        return out


# The wider search's ranges.
WIDE_SPACE = Space(min_gain=(0.0, 0.5), feature_choices=("sqrt", "log2", "all"))


@dataclass(frozen=True)
class Trial:
    number: int
    params: dict[str, object]
    value: float | None = None
    error: str | None = None

    @property
    def state(self) -> str:
        return "COMPLETE" if self.error is None else "FAIL"


@dataclass(frozen=True)
class Study:
    trials: list[Trial] = field(default_factory=list)

    @property
    def best(self) -> Trial:
        done = [t for t in self.trials if t.value is not None]
        if not done:
            raise ValueError("no trial completed")
        return max(done, key=lambda t: (t.value, -t.number))

    @property
    def failed(self) -> int:
        return sum(t.error is not None for t in self.trials)

    def table(self, spark) -> DataFrame:
        rows = [(t.number, t.state, t.value, json.dumps(t.params, sort_keys=True), t.error) for t in self.trials]
        return spark.createDataFrame(rows, TRIAL_SCHEMA)

    def top(self, spark, n: int = 10) -> DataFrame:
        """The best trials by accuracy, failed ones left out."""
        done = self.table(spark).filter("value is not null")
        return done.orderBy(F.desc("value"), "number").limit(n).select("number", "value", "params")


def classifier(params: dict[str, object]):
    """A decision tree; a feature subset needs a forest, so it becomes a forest of one full-sample tree."""
    if "featureSubsetStrategy" not in params:
        return decision_tree(minInstancesPerNode=1, **params)
    return RandomForestClassifier(labelCol="label", featuresCol="features", impurity="entropy", seed=42,
                                  numTrees=1, bootstrap=False, **params)


def search(
    df: DataFrame,
    spec: FeatureSpec,
    key: str,
    trials: int = 100,
    space: Space = Space(),
    folds: int = 5,
    parallel: int = 4,
    seed: int = 42,
) -> Study:
    """Draws ``trials`` parameter sets and scores each by mean accuracy over ``folds`` folds.

    Rows are put into folds by a hash of ``key``, so every fit sees the same folds even if a
    partition is computed again. A failing trial is recorded and does not stop the search.
    """
    rng = random.Random(seed)
    drawn = [(n, space.draw(rng)) for n in range(trials)]
    prepared = fit_features(df, spec).transform(df).select(
        "features", "label", bucket(key, seed, folds).cast("int").alias("fold")
    ).persist()
    values: dict[int, list[float]] = {n: [] for n, _ in drawn}
    errors: dict[int, str] = {}
    try:
        sizes = {r["fold"]: r["count"] for r in prepared.groupBy("fold").count().collect()}  # one row per fold
        _check_folds(sizes, folds)
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            for fold in range(folds):
                going = [(n, p) for n, p in drawn if n not in errors]
                rows = sum(sizes.values()) - sizes[fold]
                for number, value, error in _score_fold(prepared, fold, rows, going, pool, parallel):
                    values[number].append(value)
                    if error is not None:
                        errors[number] = error
    except Exception as error:  # rows that cannot be dealt into folds fail every trial
        errors = {n: errors.get(n, str(error)) for n, _ in drawn}
    finally:
        prepared.unpersist()
    return Study([Trial(n, p, None, errors[n]) if n in errors else Trial(n, p, float(np.mean(values[n]))) for n, p in drawn])


def _check_folds(sizes: Mapping[int, int], folds: int) -> None:
    for fold in range(folds):
        if sum(sizes.values()) == sizes.get(fold, 0):
            raise ValueError(f"The training data at fold {fold} is empty.")
        if fold not in sizes:
            raise ValueError(f"The validation data at fold {fold} is empty.")


def _same_tree(params: Mapping[str, object], rows: int) -> tuple:
    """What a tree fitted on ``rows`` rows depends on, but for its depth and least gain. Rows weigh one each, so the least
    weight of a child counts as a whole number of rows."""
    return max(1, math.ceil(params["minWeightFractionPerNode"] * float(rows))), params.get("featureSubsetStrategy", "all")


def _implied(params: Mapping[str, object], by: Mapping[str, object], depth: int) -> bool:
    """Whether ``params`` predicts as the tree of depth ``depth`` fitted with ``by``, both being the ``_same_tree``.

    A lower limit of depth, or a higher one of gain, cuts a tree that looks at all features without changing the rest: one
    that ends above the limit stays whole, and one that predicts the same class everywhere does so cut anywhere. A cut
    changes which features are drawn afterwards, so trees that draw them are shared by equal parameters only.
    """
    limits = [(p["maxDepth"], p.get("minInfoGain", 0.0)) for p in (params, by)]
    if limits[0] == limits[1]:
        return True
    (low, gain), (high, least) = limits
    whole = gain == least and depth <= low
    return params.get("featureSubsetStrategy", "all") == "all" and low <= high and gain >= least and (whole or depth == 0)


def _score_fold(prepared: DataFrame, fold: int, rows: int, drawn: Sequence[tuple[int, dict[str, object]]],
                pool: ThreadPoolExecutor, parallel: int) -> list[tuple[int, float | None, str | None]]:
    """Number, accuracy and error on one fold of every trial, fitted on the other folds (``rows`` rows).

    The two sides of the fold are kept for all trials. Trials that are sure to predict alike share a fit: those with the
    widest limits are fitted first, and only what they do not imply is fitted after them.
    """
    training = prepared.filter(F.col("fold") != fold).persist()
    validation = prepared.filter(F.col("fold") == fold).persist()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")

    def fit(item: tuple[int, dict[str, object]]) -> tuple[float | None, int, str | None]:
        try:
            model = classifier(item[1]).fit(training)
            tree = model.trees[0] if hasattr(model, "trees") else model
            return float(evaluator.evaluate(model.transform(validation))), tree.depth, None
        except Exception as error:  # a trial may fail for any reason; the study goes on
            return None, -1, str(error)

    out: list[tuple[int, float | None, str | None]] = []
    waiting: dict[tuple, list[tuple[int, dict[str, object]]]] = {}
    for item in sorted(drawn, key=lambda d: (-d[1]["maxDepth"], d[1].get("minInfoGain", 0.0), d[0])):
        waiting.setdefault(_same_tree(item[1], rows), []).append(item)
    try:
        at_once = 1  # of each kind of tree; the widest one first, alone
        while waiting:
            chosen = [(kind, item) for kind, items in waiting.items() for item in _different(items)[:at_once]]
            fitted = list(pool.map(fit, [item for _, item in chosen]))
            done = {item[0] for _, item in chosen}
            for (kind, (number, params)), (value, depth, error) in zip(chosen, fitted):
                out.append((number, value, error))
                if error is None:
                    alike = [n for n, p in waiting[kind] if n not in done and _implied(p, params, depth)]
                    out += [(n, value, None) for n in alike]
                    done.update(alike)
            left = {kind: [item for item in items if item[0] not in done] for kind, items in waiting.items()}
            waiting = {kind: items for kind, items in left.items() if items}
            at_once = max(1, parallel // max(1, len(waiting)))
        return out
    finally:
        training.unpersist()
        validation.unpersist()


def _different(items: Sequence[tuple[int, dict[str, object]]]) -> list[tuple[int, dict[str, object]]]:
    """The first of the items of each depth and gain, in their order."""
    return list({(p["maxDepth"], p.get("minInfoGain")): (n, p) for n, p in reversed(items)}.values())[::-1]
