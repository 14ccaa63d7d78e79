import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orefold.functions import row_hash
from orefold.operators.scd2 import first_versions, scd2_apply, version_counts, version_timeline
from orefold.plans.loads import load_history, load_upsert

D1, D2, D3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
SHOWN = ["id", "a", "_tf_valid_from", "_tf_valid_to", "_tf_is_current", "_tf_change_type"]


def source(spark, *rows):
    df = spark.createDataFrame(list(rows), "id int, a string")
    return df.withColumn("_tf_row_hash", row_hash(["a"]))


def check_invariants(df, keys):
    """At most one open row per key, and intervals that do not overlap."""
    open_rows = df.filter("_tf_valid_to is null").groupBy(*keys).count().filter("count > 1")
    assert open_rows.count() == 0
    following = F.lead("_tf_valid_from").over(Window.partitionBy(*keys).orderBy("_tf_valid_from"))
    overlap = df.withColumn("n", following).filter("n is not null and (_tf_valid_to is null or _tf_valid_to > n)")
    assert overlap.count() == 0


def loads(spark):
    return [
        (source(spark, (1, "x"), (2, "x"), (3, "x")), D1),
        (source(spark, (1, "x"), (2, "y"), (4, "x")), D2),
        (source(spark, (1, "x"), (2, "y"), (3, "x"), (4, None)), D3),
    ]


EXPECTED = [
    (1, "x", D1, None, True, "INSERT"),
    (2, "x", D1, D2, False, "UPDATE"),
    (2, "y", D2, None, True, "UPDATE"),
    (3, "x", D1, D2, False, "DELETE"),
    (3, "x", D3, None, True, "UPDATE"),  # a returning key is not new
    (4, None, D3, None, True, "UPDATE"),
    (4, "x", D2, D3, False, "UPDATE"),
]


def test_versions(spark, rows):
    (first, at), *later = loads(spark)
    table = first_versions(first, at)
    for src, at in later:
        table = scd2_apply(table, src, ["id"], at)
    assert rows(table, *SHOWN) == sorted(EXPECTED, key=str)
    check_invariants(table, ["id"])
    assert rows(version_counts({"t": table})) == [("t", 7, 4, 3)]
    assert version_timeline(table, ["id"]).count() == 7


def test_stored_loads_agree_with_the_operator(spark, lake, rows):
    for src, at in loads(spark):
        load_history(lake, "silver", "t", src, ["id"], at, ["_tf_row_hash"], "_tf_id")
    table = lake.read("silver", "t")
    assert rows(table, *SHOWN) == sorted(EXPECTED, key=str)
    assert sorted(r[0] for r in table.select("_tf_id").collect()) == list(range(1, 8))
    assert lake.read_open("silver", "t").filter("not _tf_is_current").count() == 0
    assert lake.read_closed("silver", "t").filter("_tf_is_current").count() == 0


def test_second_load_of_the_same_rows_writes_nothing(spark, lake):
    src = source(spark, (1, "x"), (2, None))
    assert load_history(lake, "silver", "t", src, ["id"], D1, ["_tf_row_hash"]).inserted == 2
    assert not load_history(lake, "silver", "t", src, ["id"], D2, ["_tf_row_hash"]).changed
    assert lake.snapshot("silver", "t").version == 1


def test_new_rows_only_are_appended(spark, lake):
    load_history(lake, "silver", "t", source(spark, (1, "x")), ["id"], D1, ["_tf_row_hash"])
    before = lake.snapshot("silver", "t").open_folders
    load_history(lake, "silver", "t", source(spark, (1, "x"), (2, "x")), ["id"], D2, ["_tf_row_hash"])
    assert lake.snapshot("silver", "t").open_folders[: len(before)] == before


def test_only_touched_folders_are_rewritten(spark, lake):
    for n, at in ((1, D1), (2, D2)):
        load_history(lake, "silver", "t", source(spark, *[(i, "x") for i in range(n)]), ["id"], at, ["_tf_row_hash"])
    first, second = lake.snapshot("silver", "t").open_folders
    load_history(lake, "silver", "t", source(spark, (0, "x"), (1, "y")), ["id"], D3, ["_tf_row_hash"])
    after = lake.snapshot("silver", "t").open_folders
    assert first in after and second not in after


def test_empty_source_closes_everything_and_empty_target_opens_everything(spark, lake, rows):
    empty = source(spark, (1, "x")).limit(0)
    load_history(lake, "silver", "t", empty, ["id"], D1, ["_tf_row_hash"])
    load_history(lake, "silver", "t", source(spark, (1, "x")), ["id"], D2, ["_tf_row_hash"])
    load_history(lake, "silver", "t", empty, ["id"], D3, ["_tf_row_hash"])
    assert rows(lake.read("silver", "t"), *SHOWN) == [(1, "x", D2, D3, False, "DELETE")]


def test_column_compare_modes(spark, rows):
    old = spark.createDataFrame([(1, None), (2, "x")], "id int, a string")
    new = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    base = first_versions(old, D1, change_type=False)
    assert scd2_apply(base, new, ["id"], D2, ["a"]).count() == 4
    assert scd2_apply(base, new, ["id"], D2, ["a"], null_safe=False).count() == 3


def test_missing_members_may_stay_current(spark, rows):
    base = first_versions(source(spark, (1, "x"), (2, "x")), D1, change_type=False)
    out = scd2_apply(base, source(spark, (1, "y")), ["id"], D2, close_missing=False)
    assert rows(out, "id", "a", "_tf_valid_to") == [(1, "x", D2), (1, "y", None), (2, "x", None)]


def test_stored_key_errors_leave_the_table_as_it_was(spark, lake):
    load_history(lake, "silver", "t", source(spark, (1, "x")), ["id"], D1, ["_tf_row_hash"])
    with pytest.raises(Exception, match="duplicate key"):
        load_history(lake, "silver", "t", source(spark, (2, "x"), (2, "y")), ["id"], D2, ["_tf_row_hash"])
    assert lake.snapshot("silver", "t").version == 1
    assert lake.read("silver", "t").count() == 1


def test_stored_upsert(spark, lake, rows):
    now = {"loaded": F.lit("i")}
    first = spark.createDataFrame([(1, "x"), (2, "x")], "id int, a string")
    load_upsert(lake, "gold", "d", first, ["id"], D1, ["a"], "sk", on_insert=now, on_update={"loaded": F.lit("u")})
    second = spark.createDataFrame([(2, "y"), (3, "z")], "id int, a string")
    done = load_upsert(lake, "gold", "d", second, ["id"], D2, ["a"], "sk", on_insert=now, on_update={"loaded": F.lit("u")})
    assert (done.inserted, done.updated, done.deleted) == (1, 1, 0)
    assert rows(lake.read("gold", "d"), "id", "a", "loaded") == [(1, "x", "i"), (2, "y", "u"), (3, "z", "i")]
    assert sorted(r.sk for r in lake.read("gold", "d").collect()) == [1, 2, 3]


def test_history_against_a_plain_python_model(spark, lake):
    """Several random loads, compared with a dictionary that keeps versions the slow way."""
    import random

    rng = random.Random(7)
    versions, current = [], {}
    for day in range(1, 6):
        at = dt.datetime(2024, 2, day)
        state = {k: rng.choice(["a", "b", None]) for k in range(12) if rng.random() < 0.7}
        for k in list(current):
            if k not in state or (state[k] or "") != (current[k][0] or ""):
                versions.append((k, current[k][0], current[k][1], at))
                del current[k]
        for k, v in state.items():
            current.setdefault(k, (v, at))
        load_history(lake, "silver", "r", source(spark, *state.items()), ["id"], at, ["_tf_row_hash"])
    expected = versions + [(k, v, since, None) for k, (v, since) in current.items()]
    found = lake.read("silver", "r").select("id", "a", "_tf_valid_from", "_tf_valid_to").collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_digest_sees_values_that_change_columns(spark, lake, rows):
    schema = "id int, a string, b string, c decimal(19,4)"
    first = spark.createDataFrame([(1, None, "x", None), (2, "x", None, None), (3, "", None, None), (4, None, None, None)], schema)
    second = spark.createDataFrame([(1, "x", None, None), (2, "x", None, None), (3, None, "", None), (4, None, None, None)], schema)
    load_history(lake, "silver", "d", first, ["id"], D1, ["a", "b", "c"], change_type=False)
    done = load_history(lake, "silver", "d", second.withColumn("c", F.col("c").cast("decimal(20,4)")), ["id"], D2,
                        ["a", "b", "c"], change_type=False)
    assert (done.inserted, done.updated, done.deleted) == (0, 2, 0)
    operator = scd2_apply(first_versions(first, D1, change_type=False), second, ["id"], D2, ["a", "b", "c"])
    assert rows(lake.read("silver", "d")) == rows(operator)
    plain = load_history(lake, "silver", "d", first, ["id"], D3, ["a", "b", "c"], change_type=False, null_safe=False)
    assert not plain.changed


def test_a_narrow_reader_of_a_history_shuffles_no_other_column(spark):
    """Keys and dates of all versions need no attribute; source rows are read once, repeats still fail."""
    kind = "id int, text string, _tf_row_hash string"
    old = spark.createDataFrame([(1, "wide one", "a"), (2, "wide two", "b"), (3, "three", "c")], kind)
    new = spark.createDataFrame([(1, "wide one", "a"), (2, "changed", "x"), (4, "four", "d")], kind)
    merged = scd2_apply(first_versions(old, "2024-01-01 00:00:00"), new, ["id"], "2024-01-02 00:00:00")
    narrow = version_timeline(merged, ["id"])
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.replace("LogicalRDD [id#", "").split("Join", 1)[0] and "struct" not in plan
    assert plan.count("LogicalRDD") == 2
    assert [r.id for r in narrow.collect()] == [1, 2, 2, 3, 4]
    assert {(r.id, r.text, r["_tf_change_type"], r["_tf_is_current"]) for r in merged.collect()} == {
        (1, "wide one", "INSERT", True), (2, "wide two", "UPDATE", False), (2, "changed", "UPDATE", True),
        (3, "three", "DELETE", False), (4, "four", "INSERT", True)}
    with pytest.raises(Exception, match="duplicate key"):
        scd2_apply(first_versions(old, "2024-01-01 00:00:00"), new.union(new), ["id"], "2024-01-02 00:00:00").collect()
