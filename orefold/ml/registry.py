"""Stored models by name and version."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.session import child_names

SCHEMA = (
    "name string, version int, registered_at timestamp, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>, input_schema string"
)


class ModelRegistry:
    """Models below ``<root>/<name>/v<version>/``: the fitted pipeline and one metadata row."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self, name: str) -> list[int]:
        return sorted(int(v[1:]) for v in child_names(self.spark, f"{self.root}/{name}") if v.startswith("v"))

    def register(
        self,
        name: str,
        model: PipelineModel,
        training_rows: DataFrame,
        params: Mapping[str, object] | None = None,
        metrics: Mapping[str, float] | None = None,
        tags: Mapping[str, str] | None = None,
    ) -> int:
        """Saves a fitted pipeline as the next version of ``name``."""
        version = max(self.versions(name), default=0) + 1
        place = f"{self.root}/{name}/v{version}"
        model.write().save(f"{place}/model")
        row = (
            name, version, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            {k: str(v) for k, v in (params or {}).items()},
            {k: float(v) for k, v in (metrics or {}).items()},
            dict(tags or {}), training_rows.schema.json(),
        )
        # Written last: a version counts once its metadata is there.
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.json(f"{place}/metadata")
        return version

    def describe(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(f"{self.root}/{name}/*/metadata").orderBy("version")

    def load(self, name: str, version: int | None = None) -> PipelineModel:
        """The given or newest version."""
        known = self.versions(name)
        chosen = version or max(known, default=None)
        if chosen not in known:
            raise LookupError(f"no version {version or ''} of model {name}")
        return PipelineModel.load(f"{self.root}/{name}/v{chosen}/model")

    def input_columns(self, name: str, version: int) -> list[str]:
        row = self.describe(name).filter(F.col("version") == version).first()
        return [f["name"] for f in json.loads(row["input_schema"])["fields"]]
