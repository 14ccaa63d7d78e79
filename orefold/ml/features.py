"""Feature preparation for tabular classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.functions.columns import digit_id


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are numeric and which are categories; all others are left out.

    ``drop_last=False`` gives every category its own slot, NULL included (the last one).
    """

    numeric: Sequence[str]
    categorical: Sequence[str]
    impute: bool = True
    drop_last: bool = True

    @classmethod
    def from_types(cls, df: DataFrame, exclude: Sequence[str] = (), **options) -> "FeatureSpec":
        """Text columns are categories, everything else is numeric."""
        fields = [f for f in df.schema.fields if f.name not in set(exclude)]
        text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
        return cls([f.name for f in fields if f.name not in text], text, **options)


def cast_flags(df: DataFrame, flags: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """Boolean flags as 0/1 integers and identifiers as text; absent columns are skipped."""
    casts = {c: F.col(c).cast("int") for c in flags if c in df.columns}
    casts.update({c: F.col(c).cast("string") for c in text if c in df.columns})
    return df.withColumns(casts)


def imputer(columns: Sequence[str]) -> Imputer:
    return Imputer(strategy="mean", inputCols=list(columns), outputCols=[f"{c}_imputed" for c in columns])


def indexer(columns: Sequence[str]) -> StringIndexer:
    """Index by falling frequency, ties by value; NULL and unseen values share one extra index."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_indexed" for c in columns], handleInvalid="keep")


def encoder(columns: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_indexed" for c in columns], outputCols=[f"{c}_ohe" for c in columns],
                         dropLast=drop_last)


def feature_stages(spec: FeatureSpec) -> list:
    """Imputer, indexers, encoders and the assembler that builds ``features``.

    The indexers of all columns are fitted together, in one pass over the data.
    """
    stages: list = []
    numeric = list(spec.numeric)
    if spec.impute and numeric:
        stages.append(imputer(numeric))
        numeric = [f"{c}_imputed" for c in numeric]
    if spec.categorical:
        stages += [indexer(spec.categorical), encoder(spec.categorical, spec.drop_last)]
    inputs = numeric + [f"{c}_ohe" for c in spec.categorical]
    # Without imputation gaps reach the assembler; keep them as NaN instead of failing.
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def fit_features(df: DataFrame, spec: FeatureSpec) -> PipelineModel:
    return Pipeline(stages=feature_stages(spec)).fit(df)


def with_label(df: DataFrame, column: str) -> DataFrame:
    """The 0/1 label as double, the form classifiers take."""
    return df.withColumn("label", F.col(column).cast("double"))


def bucket(key: str, seed: int, buckets: int = 100):
    """A repeatable number below ``buckets`` from a row's key, whatever its partition."""
    return F.pmod(digit_id([F.col(key), F.lit(seed)], 8), F.lit(buckets))


def split(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key."""
    limit = round(train_share * 100)
    place = bucket(key, seed)
    return df.filter(place < limit), df.filter(place >= limit)
