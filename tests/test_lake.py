import datetime as dt

import pytest
from pyspark.sql import functions as F

from orefold.plans.runner import optimize_table
from orefold.session import path_exists

D1, D2, D3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def test_versions_can_be_read_back(spark, lake, rows):
    lake.replace("bronze", "t", spark.range(3), at=D1)
    lake.append("bronze", "t", spark.range(3, 5), at=D2)
    assert [lake.read("bronze", "t", v).count() for v in (1, 2)] == [3, 5]
    assert rows(lake.history("bronze", "t"), "version", "committed_at", "operation") == [
        (1, D1, "REPLACE"), (2, D2, "APPEND")]
    with pytest.raises(LookupError):
        lake.read("bronze", "t", 9)
    with pytest.raises(LookupError):
        lake.read("bronze", "other")


def test_failed_write_keeps_the_current_version(spark, lake):
    lake.replace("bronze", "t", spark.range(3))
    with pytest.raises(Exception):
        lake.replace("bronze", "t", spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")))
    assert lake.read("bronze", "t").count() == 3
    assert lake.snapshot("bronze", "t").version == 1


def test_two_writers_of_one_version_collide(spark, lake):
    lake.replace("bronze", "t", spark.range(1))
    base = lake.snapshot("bronze", "t")
    lake.commit("bronze", "t", base.schema, base.open_folders, before=base)
    with pytest.raises(Exception):
        lake.commit("bronze", "t", base.schema, base.open_folders, before=base)


def test_expire_drops_old_versions_and_unused_folders(spark, lake):
    lake.replace("bronze", "t", spark.range(1), at=D1)
    lake.append("bronze", "t", spark.range(1, 2), at=D2)
    lake.replace("bronze", "t", spark.range(5), at=D3)
    old = lake.snapshot("bronze", "t", 2).open_folders
    assert lake.expire("bronze", "t", 24, now=D3 + dt.timedelta(hours=12)) == 1
    assert lake.read("bronze", "t", 2).count() == 2
    assert lake.expire("bronze", "t", 1, now=D3 + dt.timedelta(days=9)) == 1
    assert lake.snapshot("bronze", "t", 2) is None
    assert lake.read("bronze", "t").count() == 5
    assert not any(path_exists(spark, f"{lake.table_path('bronze', 't')}/{f}") for f in old)


def test_optimize_keeps_content(spark, lake, rows):
    lake.replace("gold", "t", spark.range(50).repartition(5))
    lake.append("gold", "t", spark.range(50, 60))
    before = rows(lake.read("gold", "t"))
    optimize_table(lake, "gold", "t", ["id"], 2)
    assert rows(lake.read("gold", "t")) == before
    assert len(lake.snapshot("gold", "t").open_folders) == 1


def test_layers_tables_and_views(spark, lake):
    lake.replace("gold", "a", spark.range(2))
    lake.replace("gold", "b", spark.range(3))
    lake.register_view("gold", "a")
    assert spark.table("gold_a").count() == 2
    lake.drop_table("gold", "a")
    assert not lake.exists("gold", "a") and lake.exists("gold", "b")
    lake.drop_layer("gold")
    assert not lake.exists("gold", "b")
