"""Key guards and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.functions.columns import digit_id, row_hash


def guard_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """``df`` itself, failing at run time on a NULL or repeated key.

    NULL keys fail where they are read, before any exchange. Repeats are found by numbering the rows of a key in the
    hash partitioning and order that the merge join needs anyway: ``df`` is read and shuffled once, and no row of a
    key waits for another.
    """
    given, keys = given_keys(df, keys, what), list(keys)
    numbered = given.withColumn("_copies", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
    return _once(numbered, keys, what)


def given_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """``df`` itself, failing at run time on a NULL key."""
    keys, types = list(keys), {f.name: f.dataType for f in df.schema.fields}
    missing = F.raise_error(F.lit(f"NULL key ({', '.join(keys)}) in {what}"))
    # The key itself carries the test, so no filter on it can run without the test.
    return df.withColumns({k: F.coalesce(F.col(k), missing.cast(types[k])) for k in keys})


def unique_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """The keys of ``df`` alone, failing at run time on a repeated one."""
    return _once(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")), list(keys), what)


def _once(counted: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    text = F.lit(f"duplicate key ({', '.join(keys)}) in {what}")
    return counted.filter(F.when(F.col("_copies") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))).drop("_copies")


def guard_digests(df: DataFrame, keys: Sequence[str], digests: Sequence[str], what: str = "source") -> DataFrame:
    """Keys and 64-bit digests of ``df``, failing on a NULL or repeated key: one aggregate over one read.

    The digests are numbers, so rows of a repeated key are combined before the shuffle.
    """
    keys, types = list(keys), {f.name: f.dataType for f in df.schema.fields}
    missing = F.raise_error(F.lit(f"NULL key ({', '.join(keys)}) in {what}"))
    given = df.select(*[F.coalesce(F.col(k), missing.cast(types[k])).alias(k) for k in keys], *digests)
    counted = given.groupBy(*keys).agg(*[F.max(d).alias(d) for d in digests], F.count(F.lit(1)).alias("_copies"))
    return _once(counted, keys, what)


#: Keys that one task numbers.
BUCKET_KEYS = 1_000_000


def key_buckets(rows: int) -> int:
    """Buckets for numbering so many keys."""
    return max(1, -(-rows // BUCKET_KEYS))


def surrogate_keys(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    start: int = 1,
    buckets: int = 4096,
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in one column ``name``, without gaps, in the order of the keys' MD5.

    Only the keys are numbered; the rows meet their number by an equality join. The MD5's range is cut
    into ``buckets`` of equal width, which unique keys fill evenly. A first pass counts each bucket
    (combined before the shuffle), a running total over one row per bucket gives the offsets, and a second
    pass numbers the keys inside each bucket. Numbers depend on key values only: not on partition
    ids, arrival order or the number of buckets, so they can be sized by the table (``key_buckets``) and a task that is run
    again gives the same ones. ``keys`` must be unique. ``key_rows`` may give the same keys from a cheaper place.
    """
    keys = list(keys)
    width = -(-(1 << 60) // buckets)
    bucketed = (df if key_rows is None else key_rows).select(*keys, digit_id(keys).alias("_bucket"))
    bucketed = bucketed.withColumn("_bucket", F.expr(f"_bucket div {width}"))
    counts = bucketed.groupBy("_bucket").count()
    # Bounded input: one short row per bucket.
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *keys))
    # The digest is made again where the keys of a bucket meet: it is twice as wide as they are.
    dealt = bucketed.repartition("_bucket").withColumn("_digest", row_hash(keys))
    numbered = dealt.withColumn("_position", within).join(offsets, "_bucket").select(
        *keys, (F.lit(start - 1) + F.col("_offset") + F.col("_position")).cast("bigint").alias(name))
    if df.columns == keys:
        return numbered
    return df.join(numbered, keys).select(*df.columns, name)
