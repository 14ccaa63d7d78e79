"""Star-schema pieces: unknown members, key lookups, generated columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_KEY = -9  # fixed value


def with_unknown_member(dimension: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """The dimension plus one literal row; columns not in ``values`` are NULL in it."""
    fields = [
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dimension.schema.fields
    ]
    row = dimension.sparkSession.range(1).select(*fields)
    return dimension.unionByName(row)


@dataclass(frozen=True)
class Lookup:
    """One dimension of a fact: fact column, dimension key column, surrogate key, filter."""

    dimension: DataFrame
    fact_column: str
    dimension_column: str
    surrogate: str
    current: Column | None = None


def star_lookup(fact: DataFrame, lookups: list[Lookup], unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Left outer joins from the fact to the current version in each dimension.

    A missing member yields ``unknown``. The unknown row itself never takes part, so its placeholder
    business key cannot match. Only key and surrogate of a dimension travel to the join.
    No broadcast is forced: Spark broadcasts a dimension whose size is below its limit and otherwise
    joins by shuffle, splitting partitions that a hot foreign key makes too large.
    """
    out = fact
    for position, item in enumerate(lookups):
        dimension = item.dimension if item.current is None else item.dimension.filter(item.current)
        dimension = dimension.filter(F.col(item.surrogate) != unknown)
        key = f"_key_{position}"
        side = dimension.select(
            F.col(item.dimension_column).alias(key),
            F.col(item.surrogate).alias(f"_sk_{position}"),
        )
        out = out.join(side, out[item.fact_column] == side[key], "left").drop(key)
        out = out.withColumn(
            item.surrogate, F.coalesce(F.col(f"_sk_{position}"), F.lit(unknown)).cast("bigint")
        ).drop(f"_sk_{position}")
    return out


def amounts() -> dict[str, Column]:
    """Generated fact columns: discount amount and net amount."""
    exact = "decimal(38,6)"
    gross = F.col("sales_order_qty").cast("decimal(5,0)") * F.col("sales_unit_price")
    return {
        "sales_discount_amount": (gross * F.col("sales_unit_price_discount")).cast(exact),
        "sales_net_amount": F.col("sales_line_total").cast(exact),
    }


def fact_amounts(fact: DataFrame) -> DataFrame:
    """The fact with its generated columns."""
    return fact.withColumns(amounts())
