"""Runs over all layers, with the change scenarios of the source."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orefold.operators.merge import delete_where, update_where
from orefold.plans import dims, gold, marts, runner
from orefold.plans.bronze import load_bronze, upsert_bronze
from orefold.plans.silver import load_silver
from orefold.sources.entities import COURSE_ENTITIES, ENTITIES
from orefold.sources.sample import SampleSource

D1, D2, D3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
ADDRESS = ENTITIES["address"]


def addresses(spark):
    rows = [(i, f"{i} Main", None, city, "WA", "US", "98 011", "g", dt.datetime(2020, 1, 1))
            for i, city in ((1, "Bothell"), (2, "Bothell"), (3, "Surrey"), (1105, "Irving"))]
    return spark.createDataFrame(rows, ADDRESS.source_schema)


@pytest.mark.parametrize("edition", ["wide", "course"])
def test_update_delete_and_new_key(spark, lake, rows, edition):
    before = addresses(spark)
    load_bronze(lake, ADDRESS, before, D1)
    load_silver(lake, ADDRESS, D1, edition)
    after = update_where(before, F.col("City") == "Bothell",
                         {"PostalCode": F.lit("12345"), "ModifiedDate": F.lit("2024-01-02").cast("timestamp")})
    after = delete_where(after, F.col("City") == "Surrey")
    after = update_where(after, F.col("AddressID") == 1105, {"AddressID": F.lit(11383)})
    load_bronze(lake, ADDRESS, after, D2)
    load_silver(lake, ADDRESS, D2, edition)
    table = lake.read("silver", "address")
    assert rows(table, "address_id", "postal_code", "_tf_valid_from", "_tf_valid_to") == sorted([
        (1, "98 011", D1, D2), (1, "12345", D2, None),
        (2, "98 011", D1, D2), (2, "12345", D2, None),
        (3, "98 011", D1, D2),
        (1105, "98 011", D1, D2), (11383, "98 011", D2, None)], key=str)
    assert ("_tf_row_hash" in table.columns) == (edition == "wide")
    load_silver(lake, ADDRESS, D3, edition)
    assert lake.read("silver", "address").count() == 7


def test_bronze_upsert_keeps_rows_gone_from_the_source(spark, lake, rows):
    load_bronze(lake, ADDRESS, addresses(spark), D1)
    moved = update_where(addresses(spark), F.col("AddressID") == 1, {"City": F.lit("Kent")}).filter("AddressID < 3")
    done = load_bronze(lake, ADDRESS, moved, D2, mode="upsert")
    assert (done.inserted, done.updated) == (0, 1)
    stored = lake.read("bronze", "address")
    assert rows(stored, "AddressID", "City") == sorted(
        [(1, "Kent"), (2, "Bothell"), (3, "Surrey"), (1105, "Irving")], key=str)
    assert rows(upsert_bronze(ADDRESS, addresses(spark), moved)) == rows(stored)


def test_direct_edit_without_hash_goes_unseen(spark, lake):
    load_bronze(lake, ADDRESS, addresses(spark), D1)
    load_silver(lake, ADDRESS, D1)
    edited = update_where(lake.read("silver", "address"), F.col("address_id") == 1, {"city": F.lit("New Town")})
    snapshot = lake.snapshot("silver", "address")
    folder = lake.write_folder("silver", "address", edited)
    lake.commit("silver", "address", snapshot.schema, [folder], (), "UPDATE", snapshot.metrics)
    assert not load_silver(lake, ADDRESS, D2).changed
    assert lake.read("silver", "address").filter("city = 'New Town'").count() == 1


def test_whole_run_twice(spark, lake, sample):
    ids = [runner.run(lake, SampleSource(spark, sample, 2).entities(), at, dt.date(2024, 1, 1), f"run-{at.day}")
           for at in (D1, D2)]
    assert ids == ["run-1", "run-2"]
    log = runner.audit_log(lake)
    assert log.filter("status <> 'SUCCESS'").count() == 0
    assert log.groupBy("execution_id").count().filter("count = 32").count() == 2
    # The second run meets unchanged data: no layer above bronze may change.
    assert log.filter("execution_id = 'run-2' and layer <> 'bronze' and records_processed > 0").count() == 0
    star = gold.read_star(lake)
    fact = star.fact
    assert fact.count() == SampleSource(spark, sample, 2).sales_order_detail().count()
    assert fact.select("sales_order_id", "sales_order_detail_id").distinct().count() == fact.count()
    keys = [r[0] for r in fact.select("_tf_fact_sales_sk").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    for name in gold.DIMENSIONS:
        dimension = lake.read("gold", f"dim_{name}")
        assert dimension.filter(F.col(gold.key_name(name)) == -9).count() == 1
        assert dimension.select(gold.key_name(name)).distinct().count() == dimension.count()
    # Orders of customers that the second snapshot lacks have no customer.
    unknown = fact.filter("_tf_dim_customer_sk = -9").count()
    assert 0 < unknown < fact.count()
    marts.register_views(star)
    assert spark.table("v_customer_performance").count() > 0
    revenue = fact.agg(F.sum("sales_line_total")).first()[0]
    assert marts.fact_stats(fact).first().total_revenue == revenue


def test_changed_dimensions_move_fact_keys(spark, lake, sample):
    source = {s: SampleSource(spark, sample, s).entities() for s in (1, 2)}
    runner.run(lake, source[1], D1)
    runner.run(lake, source[2], D2)
    product = lake.read("gold", "dim_product")
    promo = product.groupBy("prod_product_id").count().filter("count > 1")
    assert promo.count() > 0
    fact = lake.read("gold", "fact_sales")
    staged = gold.staged_sales(lake)
    # Every staged line is stored with the same keys and measures.
    assert staged.exceptAll(fact.select(*staged.columns)).count() == 0


def test_course_edition(spark, lake, sample):
    entities = SampleSource(spark, sample, 3).entities()
    runner.run(lake, {n: entities[n] for n in COURSE_ENTITIES}, D1, edition="course", bronze_mode="upsert")
    fact = lake.read("gold", "fact_sales")
    assert "_tf_dim_product_id" not in fact.columns and "_tf_fact_sales_id" in fact.columns
    assert fact.filter("_tf_dim_customer_id = -9").count() == 0
    assert "_tf_valid_from" not in lake.read("gold", "dim_customer").columns


def test_failed_step_is_audited(spark, lake):
    broken = addresses(spark).unionByName(addresses(spark))
    sources = {name: spark.createDataFrame([], e.source_schema) for name, e in COURSE_ENTITIES.items()}
    with pytest.raises(Exception, match="duplicate key"):
        runner.run(lake, {**sources, "address": broken}, D1, edition="course", execution_id="bad")
    failed = runner.audit_log(lake).filter("status = 'FAILED'").collect()
    assert [(r.layer, r.table_name) for r in failed] == [("silver", "address")]
    assert "duplicate key" in failed[0].error_message
    with pytest.raises(ValueError, match="no source"):
        runner.run(lake, {}, D1)


def test_customer_attributes(spark):
    row = (1, False, " Ms. ", None, "  ", " Doe ", None, " ", None, " A@B.COM ", None, None, None, "g", D1)
    customer = ENTITIES["customer"].renamed(spark.createDataFrame([row], ENTITIES["customer"].source_schema))
    wide = dims.customer_attributes(customer).first()
    assert (wide.cust_first_name, wide.cust_last_name, wide.cust_title) == ("N/A", "Doe", "Ms.")
    assert (wide.cust_email_address, wide.cust_phone, wide.cust_type) == ("a@b.com", "000-000-0000", "Individual")
    assert wide.cust_full_name == "Ms.  Doe"  # a missing first name counts as empty text
    course = dims.customer_attributes(customer, "course").first()
    assert (course.cust_first_name, course.cust_phone, course.cust_title) == ("N/A", "N/A", " Ms. ")
    hidden = dims.masked_customers(dims.customer_attributes(customer), is_admin=False).first()
    assert hidden.cust_phone == hidden.cust_full_name == "***MASKED***" and hidden.cust_title == "Ms."
    assert dims.masked_customers(dims.customer_attributes(customer), is_admin=True).first() == wide
