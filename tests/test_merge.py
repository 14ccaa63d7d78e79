import pytest
from pyspark.sql import functions as F

from orefold.operators.merge import classify, delete_where, merge_counts, update_where, upsert
from orefold.streaming import change_feed

SCHEMA = "id int, a string, b int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_classes(spark, rows):
    old = frame(spark, (1, "x", 1), (2, "x", 1), (3, "x", 1))
    new = frame(spark, (1, "x", 1), (2, "y", 1), (4, "x", 1))
    found = classify(old, new, ["id"], ["a", "b"])
    assert rows(found, "id", "merge_class") == [(1, "SAME"), (2, "UPDATE"), (3, "TARGET_ONLY"), (4, "INSERT")]
    assert rows(merge_counts(found)) == [("INSERT", 1), ("SAME", 1), ("TARGET_ONLY", 1), ("UPDATE", 1)]
    assert rows(classify(old, new, ["id"], ["a"], missing=False), "id", "merge_class") == [
        (1, "SAME"), (2, "UPDATE"), (4, "INSERT")]


def test_null_handling(spark, rows):
    old = frame(spark, (1, None, 1), (2, "x", 1), (3, None, 1), (4, None, 1))
    new = frame(spark, (1, "x", 1), (2, None, 1), (3, None, 1), (4, "x", 2))
    safe = rows(classify(old, new, ["id"], ["a", "b"]), "id", "merge_class")
    plain = rows(classify(old, new, ["id"], ["a", "b"], null_safe=False), "id", "merge_class")
    assert safe == [(1, "UPDATE"), (2, "UPDATE"), (3, "SAME"), (4, "UPDATE")]
    assert plain == [(1, "SAME"), (2, "SAME"), (3, "SAME"), (4, "UPDATE")]


def test_untracked_column_is_not_a_change_but_travels_with_one(spark, rows):
    old = frame(spark, (1, "x", 1), (2, "x", 1))
    new = frame(spark, (1, "x", 9), (2, "y", 9))
    assert rows(upsert(old, new, ["id"], ["a"])) == [(1, "x", 1), (2, "y", 9)]
    assert rows(upsert(old, new, ["id"], None)) == [(1, "x", 9), (2, "y", 9)]


def test_upsert_never_deletes_and_is_idempotent(spark, rows):
    old = frame(spark, (1, "x", 1), (2, "x", 1))
    new = frame(spark, (2, "z", 1), (3, "q", 1))
    once = upsert(old, new, ["id"], ["a"])
    assert rows(once) == [(1, "x", 1), (2, "z", 1), (3, "q", 1)]
    assert rows(upsert(once, new, ["id"], ["a"])) == rows(once)


def test_upsert_keeps_own_columns(spark, rows):
    old = spark.createDataFrame([(1, "x", "old")], "id int, a string, loaded string")
    new = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    out = upsert(old, new, ["id"], ["a"], on_insert={"loaded": F.lit("new")}, on_update={"loaded": F.lit("upd")})
    assert rows(out) == [(1, "x", "old"), (2, "y", "new")]


def test_composite_key(spark, rows):
    schema = "k1 int, k2 string, v int"
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], schema)
    new = spark.createDataFrame([(1, "a", 2), (2, "a", 1)], schema)
    assert rows(upsert(old, new, ["k1", "k2"], ["v"])) == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]


def test_empty_sides(spark, rows):
    full, empty = frame(spark, (1, "x", 1)), spark.createDataFrame([], SCHEMA)
    assert rows(upsert(empty, full, ["id"], ["a"])) == [(1, "x", 1)]
    assert rows(upsert(full, empty, ["id"], ["a"])) == [(1, "x", 1)]


@pytest.mark.parametrize("bad, text", [([(1, "x", 1), (1, "y", 1)], "duplicate key"), ([(None, "x", 1)], "NULL key")])
def test_bad_source_keys_fail(spark, bad, text):
    new = spark.createDataFrame(bad, SCHEMA)
    with pytest.raises(Exception, match=text):
        upsert(frame(spark, (5, "x", 1)), new, ["id"], ["a"]).collect()


def test_update_and_delete_where(spark, rows):
    df = frame(spark, (1, "x", 1), (2, None, 1), (3, "y", 1))
    assert rows(update_where(df, F.col("a") == "x", {"b": F.lit(7)})) == [(1, "x", 7), (2, None, 1), (3, "y", 1)]
    assert rows(delete_where(df, F.col("a") == "x")) == [(2, None, 1), (3, "y", 1)]


def test_change_feed(spark, rows):
    old = frame(spark, (1, "x", 1), (2, None, 1), (3, "x", 1))
    new = frame(spark, (1, "x", 1), (2, "n", 1), (4, "x", 1))
    assert rows(change_feed(old, new, ["id"])) == [
        (2, "n", 1, "update_post"), (2, None, 1, "update_pre"), (3, "x", 1, "delete"), (4, "x", 1, "insert")]


def test_the_fact_merge_shuffles_each_staged_row_once(spark, sample, rows):
    from orefold.queries import dimensions
    from orefold.queries.common import LOAD_TIMES
    from orefold.plans import facts
    from orefold.operators.scd2 import load_time

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        merged = dimensions.fact_upsert(spark, sample)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # the merge's two sides; no lookup is left in it
    finally:
        spark.conf.set(key, before)
    now = load_time(LOAD_TIMES[1])
    first = dimensions.staged(spark, sample, 1).withColumns({"_tf_create_date": now, "_tf_update_date": now})
    assert rows(merged) == rows(facts.upsert_sales(first, dimensions.staged(spark, sample, 2), LOAD_TIMES[2]))
