"""Row-level change feed between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.operators.merge import INSERT, SAME, TARGET_ONLY, UPDATE, classify


def change_feed(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two versions, typed ``insert``, ``delete``, ``update_pre``, ``update_post``.

    All non-key columns are compared, NULLs included. Output columns are those of ``current`` plus
    ``_change_type``.
    """
    columns = current.columns
    tracked = [c for c in columns if c not in set(keys)]
    merged = classify(previous, current, keys, tracked).filter(F.col("merge_class") != SAME)

    def row(side: str, kind: str):
        fields = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*fields, F.lit(kind).alias("_change_type"))

    kind = F.col("merge_class")
    events = (
        F.when(kind == INSERT, F.array(row("s", "insert")))
        .when(kind == TARGET_ONLY, F.array(row("t", "delete")))
        .when(kind == UPDATE, F.array(row("t", "update_pre"), row("s", "update_post")))
    )
    return merged.select(F.explode(events).alias("e")).select("e.*")
