"""Data quality checks; every check returns ``check_type`` and ``violation_count``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.operators.star import UNKNOWN_KEY


@dataclass(frozen=True)
class ForeignKey:
    label: str
    fact_column: str
    dimension: DataFrame
    dimension_column: str
    allow: int | None = UNKNOWN_KEY


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_checks(fact: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    """Fact rows whose key is in no dimension row.

    The key columns are turned into (check, key) pairs and counted in one pass over the fact, as one row
    per task and value, so a hot value costs no more than a rare one. The dimensions' keys form one table of
    pairs, and one join finds the values without a member. NULL keys and those allowed are no orphans.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("_check"), F.col(key.fact_column).cast("bigint").alias("_k"))
                      for i, key in enumerate(keys)])
    used = fact.select(F.inline(pairs)).filter("_k is not null").groupBy("_check", "_k").agg(F.count(F.lit(1)).alias("_n"))
    known = union_all([key.dimension.select(F.lit(i).alias("_check"), F.col(key.dimension_column).cast("bigint").alias("_k"))
                       for i, key in enumerate(keys)])
    missing = used.join(known, ["_check", "_k"], "left_anti")
    counts = missing.agg(*[
        F.coalesce(F.sum(F.when((F.col("_check") == i) & (F.lit(key.allow is None) | (F.col("_k") != F.lit(key.allow))),
                                F.col("_n"))), F.lit(0)).alias(f"c{i}")
        for i, key in enumerate(keys)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(key.label).alias("check_type"), F.col(f"c{i}").alias("violation_count")) for i, key in enumerate(keys)])))


def rule_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (condition true), all counted in one pass over the table."""
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[name]).alias(f"c{i}") for i, name in enumerate(names)])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("check_type"), F.col(f"c{i}").alias("violation_count"))
        for i, name in enumerate(names)
    ])
    return counts.select(F.inline(pairs))


def fact_rules() -> dict[str, Column]:
    """Business rules of the sales fact, as violating conditions."""
    discount = F.col("sales_unit_price_discount")
    return {
        "Negative Quantities": F.col("sales_order_qty") <= 0,
        "Negative Amounts": F.col("sales_line_total") < 0,
        "Invalid Discounts": (discount < 0) | (discount > 1),
    }


def null_key_check(fact: DataFrame, columns: dict[str, str]) -> DataFrame:
    """NULL foreign keys, which an orphan check by comparison would pass over."""
    return rule_checks(fact, {label: F.col(name).isNull() for label, name in columns.items()})


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(parts)
