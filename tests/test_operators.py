import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from orefold.functions import blank_to_null, discount_band, price_band, safe_measure, snake_case, weight_band
from orefold.operators.calendar import COURSE_RANGE, WIDE_RANGE, calendar_attributes, calendar_dimension, date_range
from orefold.operators.hierarchy import flatten_hierarchy
from orefold.operators.keys import surrogate_keys
from orefold.operators.layout import compact
from orefold.operators.quality import ForeignKey, fact_rules, null_key_check, orphan_checks, rule_checks
from orefold.operators.star import Lookup, fact_amounts, star_lookup, with_unknown_member


def test_names():
    assert [snake_case(n) for n in ("SalesOrderDetailID", "AddressLine1", "rowguid", "TaxAmt", "ProductURL")] == [
        "sales_order_detail_id", "address_line1", "rowguid", "tax_amt", "product_url"]


def test_bands(spark):
    df = spark.createDataFrame([(Decimal("99.99"),), (Decimal(100),), (Decimal("2999.99"),), (Decimal(3000),), (None,)],
                               "v decimal(19,4)")
    assert [r[0] for r in df.select(price_band("v")).collect()] == [
        "Budget (< 100)", "Mid-Range (100-500)", "Luxury (1000-3000)", "Ultra-Luxury (3000+)", "Ultra-Luxury (3000+)"]
    assert [r[0] for r in df.select(weight_band("v")).collect()][-1] == "N/A"
    rates = spark.createDataFrame([(Decimal(x),) for x in ("0", "0.05", "0.0501", "0.2", "0.21", "-1")], "v decimal(19,4)")
    assert [r[0] for r in rates.select(discount_band("v")).collect()] == [
        "No Discount", "1-5% Discount", "6-10% Discount", "11-20% Discount", "20%+ Discount", "1-5% Discount"]


def test_measures_and_blanks(spark):
    df = spark.createDataFrame([("12",), ("99999",), ("x",), (None,), ("  ",)], "v string")
    assert [r[0] for r in df.select(safe_measure("v", "smallint")).collect()] == [12, 0, 0, 0, 0]
    assert [r[0] for r in df.select(blank_to_null("v")).collect()] == ["12", "99999", "x", None, None]


def test_calendar(spark):
    days = calendar_attributes(date_range(spark, *WIDE_RANGE))
    assert days.count() == 11323
    assert calendar_dimension(spark, "2024-01-01", "course").count() == 10959
    row = days.filter("_tf_dim_calendar_sk = 20240229").first()
    assert row.cal_date_full == "Thursday February 29 2024"
    assert (row.cal_week_start, row.cal_week_end) == (dt.date(2024, 2, 26), dt.date(2024, 3, 3))
    assert (row.cal_week_day, row.cal_week_of_year, row.cal_quarter) == (4, 9, 1)
    assert row.cal_is_month_end and not row.cal_is_weekend and not row.cal_is_month_start
    assert days.filter("cal_date = '2023-10-03'").first().cal_fiscal_year == 2023
    assert days.filter("cal_date = '2023-10-04'").first().cal_fiscal_year == 2024
    course = calendar_attributes(date_range(spark, *COURSE_RANGE), edition="course").columns
    assert "calendar_day_of_month" in course and "cal_quarter" not in course and "cal_is_weekend" not in course


def test_surrogate_keys_are_gap_free_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7).alias("v"))
    once = {r.id: r.sk for r in surrogate_keys(df, ["id"], "sk", start=11).collect()}
    again = {r.id: r.sk for r in surrogate_keys(df.repartition(3), ["id"], "sk", start=11).collect()}
    assert sorted(once.values()) == list(range(11, 5011))
    assert once == again
    for buckets in (1, 7, 100_000):  # the numbers do not depend on how the work is divided
        assert once == {r.id: r.sk for r in surrogate_keys(df, ["id"], "sk", start=11, buckets=buckets).collect()}
    digests = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k in range(5000))
    assert [once[k] for _, k in digests] == list(range(11, 5011))


def test_hierarchy(spark):
    nodes = spark.createDataFrame(
        [(1, None, "Bikes"), (2, 1, "Road"), (3, 2, "R-100"), (4, 99, "Lost"), (5, None, "Alone")],
        "id int, up int, label string")
    found = {r.node_id: r for r in flatten_hierarchy(nodes, "id", "up", "label").collect()}
    assert [found[i].node_level for i in range(1, 6)] == [1, 2, 3, 2, 1]
    assert [found[i].node_path for i in range(1, 6)] == ["Bikes", "Bikes > Road", "Bikes > Road > R-100", None, "Alone"]
    assert [found[i].is_leaf for i in range(1, 6)] == [False, False, True, True, True]
    assert found[3].grandparent_name == "Bikes"


def test_lookup_uses_the_current_version_and_never_the_unknown_row(spark, rows):
    dim = spark.createDataFrame([(0, -9, True), (0, 1, True), (5, 2, False), (5, 3, True)], "k int, sk long, cur boolean")
    fact = spark.createDataFrame([(1, 0), (2, 5), (3, 8), (4, None)], "id int, fk int")
    out = star_lookup(fact, [Lookup(dim, "fk", "k", "sk", F.col("cur"))])
    assert rows(out, "id", "sk") == [(1, 1), (2, 3), (3, -9), (4, -9)]


def test_unknown_member(spark, rows):
    dim = spark.createDataFrame([(1, "x", None)], "sk long, name string, day date")
    assert rows(with_unknown_member(dim, {"sk": -9, "name": "N/A"})) == [(-9, "N/A", None), (1, "x", None)]


def test_amounts(spark):
    df = spark.createDataFrame([(3, Decimal("10.5000"), Decimal("0.1000"), Decimal("28.350000"))],
                               "sales_order_qty smallint, sales_unit_price decimal(19,4), "
                               "sales_unit_price_discount decimal(19,4), sales_line_total decimal(38,6)")
    row = fact_amounts(df).first()
    assert (row.sales_discount_amount, row.sales_net_amount) == (Decimal("3.150000"), Decimal("28.350000"))


def test_checks(spark, rows):
    fact = spark.createDataFrame([(1, 1, 0.0, 5.0), (2, 0, 1.5, -1.0), (-9, 2, 0.5, 0.0), (None, 1, 0.0, 1.0)],
                                 "k int, sales_order_qty int, sales_unit_price_discount double, sales_line_total double")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(orphan_checks(fact, [ForeignKey("a", "k", dim, "k"), ForeignKey("b", "k", dim, "k", None)])) == [
        ("a", 1), ("b", 2)]
    assert rows(null_key_check(fact, {"n": "k"})) == [("n", 1)]
    assert rows(rule_checks(fact, fact_rules())) == [
        ("Invalid Discounts", 1), ("Negative Amounts", 1), ("Negative Quantities", 1)]


def test_compact_keeps_rows(spark, rows):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    for out in (compact(df, ["k"], 3), compact(df, ["k", "v"]), compact(df), compact(df, files=2)):
        assert rows(out) == rows(df)


def test_curve_clusters_every_column(spark, rows):
    df = spark.range(64 * 64).select((F.col("id") % 64).alias("a"), (F.col("id") / 64).cast("int").alias("b"))
    out = compact(df, ["a", "b"], 8, curve=True)
    assert rows(out) == rows(df)
    spans = out.groupBy(F.spark_partition_id()).agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    assert sum(r.a for r in spans) / len(spans) < 48 and sum(r.b for r in spans) / len(spans) < 48
