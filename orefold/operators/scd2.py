"""Row history (slowly changing dimension, type 2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.operators.keys import guard_keys
from orefold.operators.merge import INSERT, NEW, OLD, TARGET_ONLY, UPDATE, classify_flat

VALID_FROM, VALID_TO, CURRENT = "_tf_valid_from", "_tf_valid_to", "_tf_is_current"
CREATED, UPDATED, CHANGE, HASH = "_tf_create_date", "_tf_update_date", "_tf_change_type", "_tf_row_hash"


def load_time(value: dt.datetime | str) -> Column:
    """The load time as a literal: one value for all statements of a run."""
    return F.lit(str(value)).cast("timestamp")


def open_rows(df: DataFrame) -> DataFrame:
    """Current versions only."""
    return df.filter(F.col(VALID_TO).isNull())


def first_versions(source: DataFrame, load_date: dt.datetime | str, change_type: bool = True) -> DataFrame:
    """Version columns for the first load into an empty table."""
    now = load_time(load_date)
    out = source.withColumns({
        VALID_FROM: now,
        VALID_TO: F.lit(None).cast("timestamp"),
        CURRENT: F.lit(True),
        CREATED: now,
        UPDATED: now,
    })
    return out.withColumn(CHANGE, F.lit(INSERT)) if change_type else out


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    load_date: dt.datetime | str,
    tracked: Sequence[str] | None = None,
    null_safe: bool = True,
    close_missing: bool = True,
) -> DataFrame:
    """The history table after loading the full ``source`` at ``load_date``.

    * changed key: the open row is closed (``UPDATE``), a new open row is added (``UPDATE``);
    * missing key: the open row is closed (``DELETE``) unless ``close_missing`` is off;
    * new key: an open row is added, ``INSERT`` if the key was never stored, else ``UPDATE``;
    * same row: left alone.

    ``tracked`` lists the compared columns; the default is the stored row hash. Closed rows bypass
    the join: only their keys are read, to tell returning keys from new ones. Open rows and source
    meet in one full outer join that emits one or two rows per key. The ``_tf_change_type`` column
    is maintained when the target has it. A target column that neither the source nor this operator
    fills (a surrogate key) is NULL in added rows.
    """
    keys = list(keys)
    tracked = list(tracked or [HASH])
    typed = CHANGE in target.columns
    now = load_time(load_date)
    closed = target.filter(F.col(VALID_TO).isNotNull())

    incoming = guard_keys(source, keys)
    if typed:
        past = closed.select(*keys).distinct().withColumn("_seen", F.lit(True))
        incoming = incoming.join(past, keys, "left")
    given = set(incoming.columns)
    merged = classify_flat(open_rows(target), incoming, keys, tracked, null_safe)

    ended = {VALID_TO: now, UPDATED: now, CURRENT: F.lit(False)}
    begun = {VALID_FROM: now, VALID_TO: F.lit(None).cast("timestamp"), CURRENT: F.lit(True), CREATED: now, UPDATED: now}
    if typed:
        ended[CHANGE] = F.when(F.col("merge_class") == UPDATE, "UPDATE").otherwise("DELETE")
        first = (F.col("merge_class") == INSERT) & F.col(f"{NEW}__seen").isNull()
        begun[CHANGE] = F.when(first, "INSERT").otherwise("UPDATE")
    # One or two rows per key: the stored one as it was or ended, and a new one.
    versions = (
        F.when(F.col("merge_class") == UPDATE, F.array(F.lit("ended"), F.lit("new")))
        .when(F.col("merge_class") == INSERT, F.array(F.lit("new")))
        .when(F.col("merge_class") == TARGET_ONLY, F.array(F.lit("ended" if close_missing else "kept")))
        .otherwise(F.array(F.lit("kept")))
    )
    moved, state = merged.withColumn("_version", F.explode(versions)), F.col("_version")

    def value(field) -> Column:
        name = field.name
        if name in keys:
            return F.col(name).cast(field.dataType).alias(name)
        old = F.col(f"{OLD}_{name}")
        new = begun.get(name, F.col(f"{NEW}_{name}") if name in given else F.lit(None)).cast(field.dataType)
        closing = ended.get(name, old).cast(field.dataType)
        return F.when(state == "new", new).when(state == "ended", closing).otherwise(old).alias(name)

    return moved.select(*[value(f) for f in target.schema.fields]).unionByName(closed)


def version_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Total, current and historical rows per table."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.coalesce(F.sum(F.col(CURRENT).cast("bigint")), F.lit(0)).alias("current_records"),
            F.coalesce(F.sum((~F.col(CURRENT)).cast("bigint")), F.lit(0)).alias("historical_records"),
        ).select(F.lit(name).alias("table_name"), "total_records", "current_records", "historical_records")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("table_name")


def version_timeline(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Validity intervals per key in order."""
    return df.select(*keys, VALID_FROM, VALID_TO, CREATED, UPDATED).orderBy(*keys, VALID_FROM)
