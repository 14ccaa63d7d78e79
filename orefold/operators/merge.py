"""Merges of an incoming table into a stored one, as DataFrame results.

Parquet tables have no MERGE, UPDATE or DELETE, so each operator returns the table's new content.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions.change import changed
from orefold.operators.keys import guard_keys

INSERT, UPDATE, SAME, TARGET_ONLY = "INSERT", "UPDATE", "SAME", "TARGET_ONLY"


def classify(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    null_safe: bool = True,
    checked: bool = False,
    missing: bool = True,
) -> DataFrame:
    """One outer join on ``keys``: columns are the keys, structs ``t`` and ``s``, ``merge_class``.

    ``tracked=None`` calls every matched row an update. ``missing=False`` leaves out rows that only
    the target has. Keys are unique on both sides (the source is guarded unless ``checked``), so no
    join partition can be hot.
    """
    keys = list(keys)
    if not checked:
        source = guard_keys(source, keys)
    t = target.select(*keys, F.struct(*target.columns).alias("t"))
    s = source.select(*keys, F.struct(*source.columns).alias("s"))
    is_update = F.lit(True) if tracked is None else changed(tracked, null_safe=null_safe)
    return t.join(s, keys, "full_outer" if missing else "right").withColumn(
        "merge_class",
        F.when(F.col("t").isNull(), INSERT)
        .when(F.col("s").isNull(), TARGET_ONLY)
        .when(is_update, UPDATE)
        .otherwise(SAME),
    )


OLD, NEW = "_t", "_s"


def classify_flat(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """As ``classify`` of a checked source, with columns ``_t_<name>`` and ``_s_<name>`` in place of the structs.

    Keys travel once, and a reader that needs few columns of the merged rows shuffles no others.
    """
    keys = list(keys)
    t = target.select(*keys, *[F.col(c).alias(f"{OLD}_{c}") for c in target.columns if c not in keys], F.lit(True).alias(OLD))
    s = source.select(*keys, *[F.col(c).alias(f"{NEW}_{c}") for c in source.columns if c not in keys], F.lit(True).alias(NEW))
    compared = [c for c in tracked or () if c not in keys]
    is_update = F.lit(True) if tracked is None else changed(compared, OLD, NEW, null_safe, joint="_")
    return t.join(s, keys, "full_outer").withColumn(
        "merge_class",
        F.when(F.col(OLD).isNull(), INSERT)
        .when(F.col(NEW).isNull(), TARGET_ONLY)
        .when(is_update, UPDATE)
        .otherwise(SAME),
    )


def merge_counts(classified: DataFrame) -> DataFrame:
    """Rows per merge class."""
    return classified.groupBy("merge_class").agg(F.count(F.lit(1)).alias("row_count"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    null_safe: bool = True,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    class_column: str | None = None,
) -> DataFrame:
    """Update changed rows, add new ones, keep everything else; rows are never deleted.

    Target columns that the source lacks keep their value on update and take ``on_insert`` (or NULL)
    on insert. ``on_update`` / ``on_insert`` override single columns, e.g. the load time.
    """
    keys, on_update, on_insert = list(keys), dict(on_update or {}), dict(on_insert or {})
    incoming = set(source.columns)
    merged = classify_flat(target, guard_keys(source, keys), keys, tracked, null_safe)

    def pick(field) -> Column:
        name = field.name
        old = F.col(name if name in keys else f"{OLD}_{name}")
        new = F.col(name if name in keys else f"{NEW}_{name}") if name in incoming else None
        updated = on_update.get(name, new if new is not None else old)
        inserted = on_insert.get(name, new if new is not None else F.lit(None))
        return (
            F.when(F.col("merge_class") == INSERT, inserted.cast(field.dataType))
            .when(F.col("merge_class") == UPDATE, updated.cast(field.dataType))
            .otherwise(old)
            .alias(name)
        )

    out = [pick(field) for field in target.schema.fields]
    if class_column:
        out.append(F.col("merge_class").alias(class_column))
    return merged.select(*out)


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set ``values`` on rows where ``condition`` is true; NULL conditions leave the row alone."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        name: F.when(condition, value.cast(types[name])).otherwise(F.col(name))
        for name, value in values.items()
    })


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where ``condition`` is true; NULL conditions keep the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
