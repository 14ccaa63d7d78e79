"""Data quality checks and load statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.operators.quality import ForeignKey, fact_rules, null_key_check, orphan_checks, row_counts, rule_checks, union_all
from orefold.operators.scd2 import version_counts
from orefold.plans import marts
from orefold.queries import sql_sources as q
from orefold.queries.common import calendar, customers, fact, hash_history, places, products
from orefold.queries.dimensions import _staged, staged
from orefold.sources.entities import ENTITIES
from orefold.sources.sample import SampleSource


def orphans(spark, folder):
    """Fact keys without a dimension row; some members are taken out of the dimensions first."""
    rows = fact(spark, folder)
    checks = orphan_checks(rows, [
        ForeignKey("Missing Calendar Keys", "_tf_dim_calendar_sk",
                   calendar(spark, folder).filter("cal_year >= 2000"), "_tf_dim_calendar_sk", None),
        ForeignKey("Missing Customer Keys", "_tf_dim_customer_sk",
                   customers(spark, folder).filter("cust_company_name <> 'FURNITURE'"), "_tf_dim_customer_sk"),
        ForeignKey("Missing Geography Keys", "_tf_dim_geography_sk",
                   places(spark, folder).filter("geo_country_region <> 'ASIA'"), "_tf_dim_geography_sk"),
        ForeignKey("Missing Product Keys", "_tf_dim_product_sk",
                   products(spark, folder).filter("prod_weight_range <> 'N/A'"), "_tf_dim_product_sk"),
    ])
    return union_all([checks, null_key_check(rows, {"NULL Calendar Keys": "_tf_dim_calendar_sk"})])


def business_rules(spark, folder):
    """The three rules on a fact whose measures are shifted so that each is broken somewhere."""
    rows = fact(spark, folder).withColumns({
        "sales_order_qty": F.col("sales_order_qty") - 10,
        "sales_line_total": F.col("sales_line_total") - 20000,
        "sales_unit_price_discount": F.col("sales_unit_price_discount") * 15,
    })
    return rule_checks(rows, fact_rules())


def silver_versions(spark, folder):
    names = ["address", "customer", "sales_order_detail", "sales_order_header"]
    return version_counts({name: hash_history(spark, folder, name, 2) for name in names})


def bronze_counts(spark, folder):
    return row_counts({ENTITIES[n].source: df for n, df in SampleSource(spark, folder, 3).entities().items()})


def staging(spark, folder):
    return marts.staging_stats(staged(spark, folder, 2))


QUERIES = {
    "dq_orphans": orphans,
    "dq_business_rules": business_rules,
    "silver_version_counts": silver_versions,
    "bronze_row_counts": bronze_counts,
    "fact_staging_stats": staging,
}


def _missing(label: str, key: str, dimension: str, column: str) -> str:
    return f"""SELECT '{label}' AS check_type, count(*) AS violation_count FROM fact f
      WHERE NOT EXISTS (SELECT 1 FROM {dimension} d WHERE d.{column} = f.{key}) AND f.{key} IS NOT NULL AND f.{key} <> -9"""


def _versions(name: str, history: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS total_records,
      CAST(sum(CASE WHEN _tf_is_current THEN 1 ELSE 0 END) AS BIGINT) AS current_records,
      CAST(sum(CASE WHEN NOT _tf_is_current THEN 1 ELSE 0 END) AS BIGINT) AS historical_records FROM ({history})"""


def _two(build, hashed) -> list[str]:
    return [q.with_hash(build(s), hashed) for s in (1, 2)]


_ADDRESS_HASHED = [c for c in q.ADDRESS_COLUMNS if c != "address_id"]
_COUNTS = {
    "address": "customer", "customer": "customer", "customeraddress": "customer", "salesorderheader": "orders",
    "salesorderdetail": "lineitem", "product": "part", "productcategory": f"({q.category(3)})",
    "productdescription": "(SELECT DISTINCT p_brand FROM part), (VALUES (1), (2))",
    "productmodel": "(SELECT DISTINCT p_brand FROM part)",
    "productmodelproductdescription": "(SELECT DISTINCT p_brand FROM part), (VALUES (1), (2))",
    "vgetallcategories": f"({q.category(3)})", "vproductanddescription": "part, (VALUES (1), (2))",
    "vproductmodelcatalogdescription": "(SELECT DISTINCT p_brand FROM part)",
}

ORACLE = {
    "dq_orphans": f"""WITH {q.STAR},
        some_days AS (SELECT * FROM dim_calendar WHERE cal_year >= 2000),
        some_customers AS (SELECT * FROM dim_customer WHERE cust_company_name <> 'FURNITURE'),
        some_places AS (SELECT * FROM dim_geography WHERE geo_country_region <> 'ASIA'),
        some_products AS (SELECT * FROM dim_product WHERE prod_weight_range <> 'N/A')
        {_missing('Missing Calendar Keys', 'calendar_sk', 'some_days', 'calendar_sk')} UNION ALL
        {_missing('Missing Customer Keys', 'customer_sk', 'some_customers', 'customer_sk')} UNION ALL
        {_missing('Missing Geography Keys', 'geography_sk', 'some_places', 'geography_sk')} UNION ALL
        {_missing('Missing Product Keys', 'product_sk', 'some_products', 'product_sk')} UNION ALL
        SELECT 'NULL Calendar Keys', count(*) FROM fact WHERE calendar_sk IS NULL""",
    "dq_business_rules": f"""WITH f AS (SELECT order_qty - 10 AS qty, line_total - 20000 AS total,
          unit_price_discount * 15 AS discount FROM ({q.detail(3)}))
        SELECT 'Negative Quantities' AS check_type, count(*) AS violation_count FROM f WHERE qty <= 0
        UNION ALL SELECT 'Negative Amounts', count(*) FROM f WHERE total < 0
        UNION ALL SELECT 'Invalid Discounts', count(*) FROM f WHERE discount < 0 OR discount > 1""",
    "silver_version_counts": " UNION ALL ".join([
        _versions("address", q.history(_two(q.address, _ADDRESS_HASHED), ["address_id"], q.ADDRESS_COLUMNS)),
        _versions("customer", q.history(_two(q.customer, q.CUSTOMER_HASHED), ["customer_id"], q.CUSTOMER_COLUMNS)),
        _versions("sales_order_detail", q.history(
            _two(q.detail, q.DETAIL_HASHED), ["sales_order_id", "sales_order_detail_id"], q.DETAIL_COLUMNS)),
        _versions("sales_order_header", q.history(_two(q.header, q.HEADER_HASHED), ["sales_order_id"], q.HEADER_COLUMNS)),
    ]),
    "bronze_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in _COUNTS.items()),
    "fact_staging_stats": f"""SELECT count(*) AS total_rows, count(DISTINCT sales_order_id) AS distinct_orders,
        count(DISTINCT sales_order_detail_id) AS distinct_details,
        CAST(sum(CASE WHEN _tf_dim_customer_sk = -9 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_customers,
        CAST(sum(CASE WHEN _tf_dim_geography_sk = -9 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_geographies,
        CAST(sum(CASE WHEN _tf_dim_product_sk = -9 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_products,
        CAST(sum(sales_line_total) AS DECIMAL(38,6)) AS total_sales FROM ({_staged(2)})""",
}
