"""Shared inputs of the registered queries: snapshots, history tables, the sales star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.operators.calendar import calendar_attributes, explode_days
from orefold.operators.scd2 import first_versions, open_rows, scd2_apply
from orefold.operators.star import fact_amounts
from orefold.plans import dims
from orefold.plans.facts import MEASURES
from orefold.functions import date_key, safe_measure
from orefold.plans.marts import Star
from orefold.sinks.files import stored
from orefold.sources.entities import ENTITIES
from orefold.sources.sample import SampleSource

LOAD_TIMES = {1: "2024-01-01 00:00:00", 2: "2024-01-02 00:00:00", 3: "2024-01-03 00:00:00"}
AS_OF = dt.date(2024, 1, 1)


def utc(spark: SparkSession) -> SparkSession:
    """Timestamps in results are UTC, whatever the session was started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bronze(spark: SparkSession, folder: str, entity: str, snapshot: int = 3) -> DataFrame:
    """Source rows of one entity in one snapshot."""
    return getattr(SampleSource(utc(spark), folder, snapshot), entity)()


def renamed(spark: SparkSession, folder: str, entity: str, snapshot: int = 3) -> DataFrame:
    return ENTITIES[entity].renamed(bronze(spark, folder, entity, snapshot))


def hashed(spark: SparkSession, folder: str, entity: str, snapshot: int = 3) -> DataFrame:
    return ENTITIES[entity].hashed_source(bronze(spark, folder, entity, snapshot))


def hash_history(spark: SparkSession, folder: str, entity: str, snapshots: int) -> DataFrame:
    """Silver history after loading the first ``snapshots`` snapshots one after the other."""
    out = first_versions(hashed(spark, folder, entity, 1), LOAD_TIMES[1])
    for number in range(2, snapshots + 1):
        out = scd2_apply(out, hashed(spark, folder, entity, number), ENTITIES[entity].silver_keys, LOAD_TIMES[number])
    return out


def current_silver(spark: SparkSession, folder: str, entity: str, snapshots: int = 2) -> DataFrame:
    return open_rows(hash_history(spark, folder, entity, snapshots))


# -- the star of the last snapshot; a surrogate key is the business key plus one ------------------


def _dimension(rows: DataFrame, key: str, surrogate: str) -> DataFrame:
    return rows.withColumn(surrogate, (F.col(key) + 1).cast("bigint")).withColumn("_tf_is_current", F.lit(True))


def customers(spark, folder) -> DataFrame:
    rows = dims.customer_attributes(renamed(spark, folder, "customer"))
    return _dimension(rows, "cust_customer_id", "_tf_dim_customer_sk")


def places(spark, folder) -> DataFrame:
    rows = dims.geography_attributes(renamed(spark, folder, "address"))
    return _dimension(rows, "geo_address_id", "_tf_dim_geography_sk")


def categories(spark, folder) -> DataFrame:
    rows = dims.category_attributes(renamed(spark, folder, "productcategory"))
    return _dimension(rows, "prod_cat_id", "_tf_dim_product_category_sk")


def products(spark, folder) -> DataFrame:
    tree, models = categories(spark, folder), renamed(spark, folder, "productmodel")
    rows = dims.product_attributes(renamed(spark, folder, "product"), tree, models, AS_OF)
    return _dimension(rows, "prod_product_id", "_tf_dim_product_sk")


def calendar(spark, folder) -> DataFrame:
    """All days of the years in which orders were placed."""
    dates = utc(spark).read.parquet(f"{folder}/orders.parquet").agg(
        F.trunc(F.min("o_orderdate"), "year").alias("first"),
        F.date_sub(F.add_months(F.trunc(F.max("o_orderdate"), "year"), 12), 1).alias("last"))
    return calendar_attributes(explode_days(dates, "first", "last"))


def fact(spark, folder) -> DataFrame:
    """The sales fact; a row counts as created on its order date."""
    lines = renamed(spark, folder, "sales_order_detail")
    columns = ["sales_order_id", "sales_order_detail_id"]
    keys = [(F.col("product_id") + 1).alias("_tf_dim_product_sk")]
    header = renamed(spark, folder, "sales_order_header").select(
        "sales_order_id", "order_date", "customer_id", "bill_to_address_id"
    )
    lines = lines.join(header, "sales_order_id", "left")
    keys += [
        date_key("order_date").alias("_tf_dim_calendar_sk"),
        (F.col("customer_id") + 1).alias("_tf_dim_customer_sk"),
        (F.col("bill_to_address_id") + 1).alias("_tf_dim_geography_sk"),
        F.col("order_date").alias("_tf_create_date"),
    ]
    measures = [safe_measure(c, kind).alias(name) for name, (c, kind) in MEASURES.items()]
    return fact_amounts(lines.select(*columns, *keys, *measures))


class StoredStar:
    """The star of the last snapshot as stored tables. A table is built and written when a query first asks for it, once
    per application and input folder; from then on it is read, as the marts of a warehouse read the gold layer."""

    _TABLES: dict[tuple[str, str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def _table(self, name: str, build) -> DataFrame:
        key = (self._spark.sparkContext.applicationId, self._folder, name)
        if key not in self._TABLES:
            self._TABLES[key] = stored(build(self._spark, self._folder), f"star-{name}")
        return self._TABLES[key]

    fact = property(lambda self: self._table("fact", fact))
    customer = property(lambda self: self._table("customer", customers))
    geography = property(lambda self: self._table("geography", places))
    product = property(lambda self: self._table("product", products))
    category = property(lambda self: self._table("category", categories))
    calendar = property(lambda self: self._table("calendar", calendar))

    known = Star.known


def star(spark: SparkSession, folder: str) -> StoredStar:
    return StoredStar(utc(spark), folder)


def rebuilt_star(spark: SparkSession, folder: str) -> StoredStar:
    """As ``star``, but all tables are built and written again."""
    for key in [k for k in StoredStar._TABLES if k[:2] == (spark.sparkContext.applicationId, folder)]:
        del StoredStar._TABLES[key]
    return star(spark, folder)
