"""Physical layout: few, clustered files for faster range scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def along_curve(df: DataFrame, columns: Sequence[str], name: str, bits: int = 4) -> DataFrame:
    """Adds a row's position on a Z-shaped curve through numeric ``columns``.

    Each column is cut into ``2**bits`` ranges of about equal row count (one pass for all columns,
    a few limits per column come back); the range numbers' bits are then interleaved, so rows that
    are close in any of the columns tend to be close on the curve. NULL counts as the lowest range.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    limits = df.approxQuantile(list(columns), shares, 0.5 / 2**bits)

    def place(column: str, bounds: list[float]) -> Column:
        above = [F.coalesce((F.col(column) > bound).cast("int"), F.lit(0)) for bound in sorted(set(bounds))]
        return reduce(lambda a, b: a + b, above, F.lit(0))

    places = [f"_place_{i}" for i in range(len(columns))]
    ranged = df.withColumns({p: place(c, bounds) for p, c, bounds in zip(places, columns, limits)})
    parts = [
        F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1)), bit * len(places) + offset)
        for bit in range(bits)
        for offset, p in enumerate(reversed(places))
    ]
    return ranged.withColumn(name, reduce(lambda a, b: a + b, parts)).drop(*places)


def compact(df: DataFrame, cluster_by: Sequence[str] = (), files: int | None = None, curve: bool = False) -> DataFrame:
    """The same rows in ``files`` partitions, range-partitioned and sorted by ``cluster_by``.

    Row-group statistics of the written files then let scans skip: on the leading column when sorted
    plainly, on each of the (numeric) columns when laid along the ``curve``. Without ``cluster_by``
    rows are only rebalanced, and Spark picks file sizes from its advisory size.
    """
    if not cluster_by:
        return df.repartition(files) if files else df.hint("rebalance")
    if curve:
        laid = along_curve(df, cluster_by, "_curve")
        return compact(laid, ["_curve", *cluster_by], files).drop("_curve")
    spread = df.repartitionByRange(files, *cluster_by) if files else df.repartitionByRange(*cluster_by)
    return spread.sortWithinPartitions(*cluster_by)
