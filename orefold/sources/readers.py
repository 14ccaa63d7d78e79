"""Batch readers: relational tables over JDBC, delimited files, parquet folders, catalog tables."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.sinks.files import stored
from orefold.sources.entities import Entity


@dataclass(frozen=True)
class JdbcSource:
    """Connection to a relational source. Credentials come from the caller or the environment."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_environment(cls, prefix: str = "JDBC") -> "JdbcSource":
        env = os.environ
        return cls(
            url=env[f"{prefix}_URL"],
            driver=env.get(f"{prefix}_DRIVER"),
            user=env.get(f"{prefix}_USER"),
            password=env.get(f"{prefix}_PASSWORD"),
        )

    def base_options(self) -> dict[str, str]:
        out = {"url": self.url, **self.options}
        for name in ("driver", "user", "password"):
            if getattr(self, name):
                out[name] = getattr(self, name)
        return out

    def read_options(
        self,
        table: str,
        partition_column: str | None = None,
        bounds: tuple[object, object] | None = None,
        partitions: int = 1,
        fetch_size: int = 10_000,
    ) -> dict[str, str]:
        """Options of one read. A partition column needs bounds, so the table is read in parallel ranges."""
        out = {**self.base_options(), "dbtable": table, "fetchsize": str(fetch_size)}
        if partition_column:
            if bounds is None:
                raise ValueError("a partition column needs its lower and upper bound")
            out.update(
                partitionColumn=partition_column,
                lowerBound=str(bounds[0]),
                upperBound=str(bounds[1]),
                numPartitions=str(partitions),
            )
        return out


def read_jdbc(spark: SparkSession, source: JdbcSource, table: str, **how) -> DataFrame:
    """A source table; filters and columns used later are pushed into the database by Spark."""
    return spark.read.format("jdbc").options(**source.read_options(table, **how)).load()


def extract_jdbc(spark: SparkSession, source: JdbcSource, entity: Entity, table: str, partitions: int | None = None) -> DataFrame:
    """A whole source table in parallel ranges of the entity's leading key, as many as the session has task slots.

    The bounds are computed inside the database; they only divide the work, so rows outside them, or with a
    NULL, are read too. An entity with a text key, and an empty table, are read in one piece. Land the result (a
    bronze refresh writes it) before comparing, so that the database is read once.
    """
    column = entity.partition_column
    bounds = jdbc_bounds(spark, source, table, column) if column else (None, None)
    if bounds[0] is None:
        return read_jdbc(spark, source, table)
    partitions = partitions or spark.sparkContext.defaultParallelism
    return read_jdbc(spark, source, table, partition_column=column, bounds=bounds, partitions=partitions)


def jdbc_bounds(spark: SparkSession, source: JdbcSource, table: str, column: str) -> tuple[object, object]:
    """Smallest and largest key, computed inside the database."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**source.base_options(), query=query).load().first()
    return row[0], row[1]


def register_jdbc_catalog(spark: SparkSession, name: str, source: JdbcSource) -> None:
    """Makes the source's tables available as ``name.schema.table`` in SQL and ``spark.table``."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for key, value in source.base_options().items():
        spark.conf.set(f"{prefix}.{key}", value)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """Delimited text with a header. Without a schema Spark reads the data twice to infer types."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Delimited text with a header as (rows, rejects): lines that do not fit the columns go to ``rejects``, a table of
    its own in the work folder, as they are.

    Types are inferred over all lines when no schema is given. Every column is read, since a line is only checked as
    far as its columns are.
    """
    found = schema or spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    checked = T.StructType([*found.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
             .option("columnPruning", False).schema(checked).csv(path))
    rejects = stored(lines.filter(F.col(CORRUPT).isNotNull()), "rejects")
    return lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), rejects.select(CORRUPT)


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
