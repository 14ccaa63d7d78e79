import importlib.util
import os

import pytest

from orefold.queries import all_oracles, all_queries
from orefold.sinks import write_csv
from orefold.sources.entities import ENTITIES, MODEL_CATALOG
from orefold.sources.readers import JdbcSource, read_csv, register_jdbc_catalog
from orefold.sources.sample import SampleSource


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("JDBC_URL", "jdbc:x:y")
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.delenv("JDBC_PASSWORD", raising=False)
    source = JdbcSource.from_environment()
    plain = source.read_options("s.t")
    assert plain == {"url": "jdbc:x:y", "user": "u", "dbtable": "s.t", "fetchsize": "10000"}
    split = source.read_options("s.t", "id", (1, 900), 9)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "1", "900", "9")
    with pytest.raises(ValueError):
        source.read_options("s.t", "id")


def test_jdbc_catalog_settings(spark):
    register_jdbc_catalog(spark, "shop", JdbcSource("jdbc:x:y", options={"driver": "a.B"}))
    assert spark.conf.get("spark.sql.catalog.shop.url") == "jdbc:x:y"
    assert spark.conf.get("spark.sql.catalog.shop.driver") == "a.B"


def test_csv(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, t string")
    write_csv(df, path)
    assert rows(read_csv(spark, path, "id int, t string")) == rows(df)
    assert dict(read_csv(spark, path).dtypes) == {"id": "int", "t": "string"}


def test_entities():
    assert len(ENTITIES) == 13
    assert MODEL_CATALOG.silver_keys == ["product_model_id"] and "producturl" in MODEL_CATALOG.attributes
    assert "thumbnail_photo" in ENTITIES["product"].attributes
    assert ENTITIES["vgetallcategories"].attributes == ["name"]
    for entity in ENTITIES.values():
        names = [c for c, _ in entity.source_columns]
        assert set(entity.keys) | set(entity.hashed) | set(entity.tracked or []) <= set(names)


def test_sample_entities_match_their_schema(spark, sample):
    for name, df in SampleSource(spark, sample, 2).entities().items():
        assert df.columns == [c for c, _ in ENTITIES[name].source_columns], name
        keys = list(ENTITIES[name].keys)
        assert df.groupBy(*keys).count().filter("count > 1").count() == 0, name


def test_registry_of_queries():
    queries, oracles = all_queries(), all_oracles()
    assert set(oracles) <= set(queries) and len(queries) > 80
    assert all(callable(q) for q in queries.values())


@pytest.mark.parametrize("name", [
    "q02_orders_per_customer", "q09_revenue_by_category", "sales_by_category", "scd2_reappear", "dim_product_scd2",
    "dq_orphans", "scalar_dates",
])
def test_queries_agree_with_sql(spark, sample, name):
    duckdb = pytest.importorskip("duckdb")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("check_oracle", f"{here}/tools/check_oracle.py")
    check = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(check)
    db = duckdb.connect()
    for file in os.listdir(sample):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sample}/{file}'")
    df = all_queries()[name](spark, sample)
    cursor = db.execute(all_oracles()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(map(check.normal, r)) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(map(check.normal, r)) for r in df.select(*columns).collect()), key=str) == expected


def test_entities_are_read_in_ranges_of_their_leading_key(spark, monkeypatch):
    from orefold.sources import readers
    asked = []
    monkeypatch.setattr(readers, "jdbc_bounds", lambda *a: (1, 900))
    monkeypatch.setattr(readers, "read_jdbc", lambda spark, source, table, **how: asked.append(source.read_options(table, **how)))
    source = readers.JdbcSource("jdbc:x:y")
    readers.extract_jdbc(spark, source, ENTITIES["sales_order_detail"], "s.t", 9)
    assert {k: asked[-1][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "SalesOrderID", "lowerBound": "1", "upperBound": "900", "numPartitions": "9"}
    readers.extract_jdbc(spark, source, ENTITIES["customer"], "s.t")
    assert asked[-1]["numPartitions"] == str(spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(readers, "jdbc_bounds", lambda *a: (None, None))  # an empty table
    readers.extract_jdbc(spark, source, ENTITIES["customer"], "s.t")
    assert "partitionColumn" not in asked[-1]
    assert all(e.partition_column == e.keys[0] for e in ENTITIES.values())


def test_views_are_masked_when_they_are_read(spark, lake):
    from orefold.plans import views
    lake.replace("gold", "dim_customer", spark.createDataFrame([(1, "Ann")], "k int, cust_phone string"))
    user = spark.sql("SELECT current_user()").first()[0]
    views.set_members(lake, [("admins", user + "x"), ("others", user)])
    views.create_masked_view(lake, "seen_by_others", masked=["cust_phone"])
    views.create_masked_view(lake, "seen_by_group", masked=["cust_phone"], group="others")
    assert views.read_view(lake, "seen_by_others").collect() == [(1, "***MASKED***")]
    assert views.read_view(lake, "seen_by_group").collect() == [(1, "Ann")]
