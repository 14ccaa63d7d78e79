"""The sales fact at order-line grain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.functions import date_key, safe_measure
from orefold.operators.merge import upsert
from orefold.operators.scd2 import load_time
from orefold.operators.star import UNKNOWN_KEY, Lookup, fact_amounts, star_lookup

FACT_KEYS = ["sales_order_id", "sales_order_detail_id"]
MEASURES = {
    "sales_order_qty": ("order_qty", "smallint"),
    "sales_unit_price": ("unit_price", "decimal(19,4)"),
    "sales_unit_price_discount": ("unit_price_discount", "decimal(19,4)"),
    "sales_line_total": ("line_total", "decimal(38,6)"),
}


def _ids(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.select(F.col(column).alias(alias))


def stage_sales(
    detail: DataFrame,
    header: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    dim_customer: DataFrame,
    dim_geography: DataFrame,
    product: DataFrame | None = None,
    dim_product: DataFrame | None = None,
    suffix: str = "sk",
) -> DataFrame:
    """Fact rows with dimension keys and typed measures; all inputs hold current rows only.

    A key is known only if the member is current in silver and in gold, so each dimension is first
    cut down to members that silver still has (semi join, one row per member) and then looked up
    once. Customer and place belong to the order, so they are looked up per order header; a line
    meets its header with the keys already resolved, and only that join and the product lookup see
    the lines. The order id comes from the line, so lines without a header keep their identity;
    their date key is NULL and their customer unknown. Without products (course edition) the fact
    has no product key.
    """
    customer_sk, geography_sk = f"_tf_dim_customer_{suffix}", f"_tf_dim_geography_{suffix}"
    calendar_sk = f"_tf_dim_calendar_{suffix}"
    customers = dim_customer.join(_ids(customer, "customer_id", "cust_customer_id"), "cust_customer_id", "left_semi")
    places = dim_geography.join(_ids(address, "address_id", "geo_address_id"), "geo_address_id", "left_semi")
    orders = star_lookup(
        header.select("sales_order_id", date_key("order_date").alias(calendar_sk), "customer_id", "bill_to_address_id"),
        [Lookup(customers, "customer_id", "cust_customer_id", customer_sk),
         Lookup(places, "bill_to_address_id", "geo_address_id", geography_sk)],
    ).select("sales_order_id", calendar_sk, customer_sk, geography_sk)
    measured = [safe_measure(c, kind).alias(name) for name, (c, kind) in MEASURES.items()]
    lines = detail.select(*FACT_KEYS, "product_id", *measured).join(orders, "sales_order_id", "left")
    lines = lines.fillna(UNKNOWN_KEY, [customer_sk, geography_sk])
    keys = [calendar_sk, customer_sk, geography_sk]
    if dim_product is not None:
        product_sk = f"_tf_dim_product_{suffix}"
        goods = dim_product.join(_ids(product, "product_id", "prod_product_id"), "prod_product_id", "left_semi")
        lines = star_lookup(lines, [Lookup(goods, "product_id", "prod_product_id", product_sk)])
        keys.append(product_sk)
    return lines.select(*FACT_KEYS, *keys, *MEASURES)


def tracked_columns(staged: DataFrame) -> list[str]:
    """Everything but the business keys is compared."""
    return [c for c in staged.columns if c not in FACT_KEYS]


def upsert_sales(fact: DataFrame, staged: DataFrame, load_date: dt.datetime | str) -> DataFrame:
    """Fact content after loading ``staged``: changed lines updated, new lines added."""
    now = load_time(load_date)
    return upsert(
        fact, staged, FACT_KEYS, tracked_columns(staged),
        on_update={"_tf_update_date": now},
        on_insert={"_tf_create_date": now, "_tf_update_date": now},
    )


def with_amounts(fact: DataFrame) -> DataFrame:
    return fact_amounts(fact)
