import datetime as dt

import pytest

from orefold.session import create_file, work_dir

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def put(lake, n, at):
    df = lake.spark.range(n)
    folder, written = lake.write_counted("gold", "t", df)
    return lake.commit("gold", "t", df.schema, [folder], (), "WRITE", {"inserted": written}, at)


@pytest.mark.parametrize("content", ["", '{"version": 2, "opera'])
def test_incomplete_version_is_passed_over(lake, content):
    put(lake, 3, D1)
    create_file(lake.spark, f"{lake.table_path('gold', 't')}/history/00000002.json", content)
    assert lake.read("gold", "t").count() == 3
    assert put(lake, 5, D2) == 3
    assert lake.read("gold", "t").count() == 5
    assert lake.history("gold", "t").count() == 2


def test_second_of_two_writers_fails(lake):
    put(lake, 3, D1)
    before = lake.snapshot("gold", "t")
    put(lake, 4, D2)
    with pytest.raises(RuntimeError):
        lake.commit("gold", "t", lake.spark.range(1).schema, [], (), "WRITE", {}, D2, before)
    with pytest.raises(Exception):
        create_file(lake.spark, f"{lake.table_path('gold', 't')}/history/00000002.json", "{}")


def test_work_folder_needs_a_shared_setting_on_a_cluster():
    class Far:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        work_dir(Far, "x")
