"""Gold dimensions: attribute projections and unknown members."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import blank_to_null, fill_text, mask_text, price_band, weight_band
from orefold.operators.hierarchy import flatten_hierarchy
from orefold.operators.star import UNKNOWN_KEY

# Attribute lists, compared columns, defaults and the literal unknown rows.
GEOGRAPHY_TEXT = {
    "geo_address_line_1": "address_line1",
    "geo_address_line_2": "address_line2",
    "geo_city": "city",
    "geo_state_province": "state_province",
    "geo_country_region": "country_region",
}
CUSTOMER_TEXT = {
    "cust_title": "title",
    "cust_first_name": "first_name",
    "cust_middle_name": "middle_name",
    "cust_last_name": "last_name",
    "cust_suffix": "suffix",
    "cust_company_name": "company_name",
    "cust_sales_person": "sales_person",
}
CUSTOMER_DEFAULTS = {"cust_first_name": "N/A", "cust_last_name": "N/A"}
GEOGRAPHY_TRACKED = [*GEOGRAPHY_TEXT, "geo_postal_code"]
CUSTOMER_TRACKED = [*CUSTOMER_TEXT, "cust_email_address", "cust_phone"]
CATEGORY_TRACKED = [
    "prod_cat_name", "prod_cat_parent_id", "prod_cat_parent_name", "prod_cat_level",
    "prod_cat_hierarchy_path", "prod_cat_is_leaf",
]
PRODUCT_TRACKED = [
    "prod_name", "prod_product_number", "prod_color", "prod_standard_cost", "prod_list_price",
    "prod_size", "prod_weight", "prod_category_id", "prod_model_id", "prod_is_active",
]
MASKED_COLUMNS = [
    "cust_first_name", "cust_middle_name", "cust_last_name", "cust_company_name",
    "cust_email_address", "cust_phone", "cust_full_name",
]
UNKNOWN_SINCE = "2000-01-01 00:00:00"


def geography_attributes(address: DataFrame, edition: str = "wide") -> DataFrame:
    """Geography columns of current addresses.

    ``wide``: trimmed upper-case text, postal code without blanks. ``course``: text as stored, every
    NULL becomes ``N/A``.
    """
    key = F.col("address_id").alias("geo_address_id")
    if edition == "course":
        texts = {**GEOGRAPHY_TEXT, "geo_postal_code": "postal_code"}
        return address.select(key, *[fill_text(c).alias(name) for name, c in texts.items()])
    texts = [
        fill_text(c, "" if c == "address_line2" else "N/A", trim=True, case="upper").alias(name)
        for name, c in GEOGRAPHY_TEXT.items()
    ]
    postal = F.replace(fill_text("postal_code", "00000"), F.lit(" "), F.lit(""))
    return address.select(key, *texts, postal.alias("geo_postal_code"))


def customer_attributes(customer: DataFrame, edition: str = "wide") -> DataFrame:
    """Customer columns; the wide edition adds full name and customer type."""
    key = F.col("customer_id").alias("cust_customer_id")
    if edition == "course":
        texts = {**CUSTOMER_TEXT, "cust_email_address": "email_address", "cust_phone": "phone"}
        return customer.select(key, *[fill_text(c).alias(name) for name, c in texts.items()])
    full_name = F.concat_ws(
        " ",
        blank_to_null("title"),
        fill_text("first_name", "", trim=True),
        blank_to_null("middle_name"),
        fill_text("last_name", "", trim=True),
        blank_to_null("suffix"),
    )
    texts = [
        fill_text(c, CUSTOMER_DEFAULTS.get(name, ""), trim=True).alias(name)
        for name, c in CUSTOMER_TEXT.items()
    ]
    return customer.select(
        key,
        *texts,
        fill_text("email_address", "N/A@N/A.com", trim=True, case="lower").alias("cust_email_address"),
        fill_text("phone", "000-000-0000", trim=True).alias("cust_phone"),
        full_name.alias("cust_full_name"),
    ).withColumn("cust_type", customer_type("cust_company_name"))


def customer_type(company: str) -> Column:
    """Business when a company name is present; blank text means none."""
    return F.when(F.trim(F.coalesce(F.col(company), F.lit(""))) != "", "Business").otherwise("Individual")


def masked_customers(customers: DataFrame, is_admin: bool, columns: Sequence[str] = MASKED_COLUMNS) -> DataFrame:
    """Customer rows as a reader may see them: personal columns only for administrators."""
    return customers.withColumns({c: mask_text(c, is_admin) for c in columns if c in customers.columns})


def category_attributes(category: DataFrame) -> DataFrame:
    """Category columns with parent chain, level, path and leaf flag."""
    flat = flatten_hierarchy(category, "product_category_id", "parent_product_category_id", "name")
    return flat.select(
        F.col("node_id").alias("prod_cat_id"),
        fill_text("node_name", trim=True).alias("prod_cat_name"),
        F.col("parent_id").alias("prod_cat_parent_id"),
        fill_text("parent_name", "", trim=True).alias("prod_cat_parent_name"),
        F.col("grandparent_id").alias("prod_cat_grandparent_id"),
        fill_text("grandparent_name", "", trim=True).alias("prod_cat_grandparent_name"),
        F.col("node_level").alias("prod_cat_level"),
        F.col("node_path").alias("prod_cat_hierarchy_path"),
        F.col("is_leaf").alias("prod_cat_is_leaf"),
    )


def product_attributes(
    product: DataFrame, dim_category: DataFrame, model: DataFrame, as_of_date: dt.date
) -> DataFrame:
    """Product columns with category and model attributes and the derived ranges.

    ``product``, ``dim_category`` and ``model`` hold current rows only. A NULL list price is filled
    with 0 but lands in the top price range, because the range is taken from the price as stored.
    """
    category = dim_category.select(
        F.col("prod_cat_id").alias("product_category_id"),
        "_tf_dim_product_category_sk", "prod_cat_name", "prod_cat_hierarchy_path",
    )
    models = model.select("product_model_id", F.col("name").alias("_model_name"))
    joined = product.join(category, "product_category_id", "left").join(models, "product_model_id", "left")
    today = F.lit(as_of_date)
    cost, price = F.col("standard_cost"), F.col("list_price")
    ended = F.col("sell_end_date").isNotNull() & (F.to_date("sell_end_date") < today)
    # decimal(38,6) keeps the quotient's digits until the final rounding
    margin = F.round((price - cost) / cost * 100, 2)
    money = "decimal(19,4)"
    return joined.select(
        F.col("product_id").alias("prod_product_id"),
        fill_text("name", trim=True).alias("prod_name"),
        fill_text("product_number", trim=True).alias("prod_product_number"),
        fill_text("color", trim=True).alias("prod_color"),
        F.coalesce(cost, F.lit(0)).cast(money).alias("prod_standard_cost"),
        F.coalesce(price, F.lit(0)).cast(money).alias("prod_list_price"),
        fill_text("size", trim=True).alias("prod_size"),
        F.coalesce(F.col("weight"), F.lit(0)).cast("decimal(8,2)").alias("prod_weight"),
        *[F.to_date(c).alias(f"prod_{c}") for c in ("sell_start_date", "sell_end_date", "discontinued_date")],
        F.coalesce("_tf_dim_product_category_sk", F.lit(UNKNOWN_KEY)).cast("bigint").alias("_tf_dim_product_category_sk"),
        F.coalesce("product_category_id", F.lit(0)).alias("prod_category_id"),
        fill_text("prod_cat_name").alias("prod_category_name"),
        fill_text("prod_cat_hierarchy_path").alias("prod_category_hierarchy"),
        F.coalesce("product_model_id", F.lit(0)).alias("prod_model_id"),
        fill_text("_model_name").alias("prod_model_name"),
        price_band("list_price").alias("prod_price_range"),
        weight_band("weight").alias("prod_weight_range"),
        F.when(F.col("discontinued_date").isNotNull(), False).when(ended, False).otherwise(True)
        .alias("prod_is_active"),
        F.datediff(F.coalesce(F.to_date("sell_end_date"), today), F.to_date("sell_start_date"))
        .alias("prod_days_to_sell"),
        F.when(cost > 0, margin).otherwise(0).cast("decimal(10,2)").alias("prod_profit_margin"),
    )


def _all_text(names: Sequence[str], value: str) -> dict[str, object]:
    return {name: value for name in names}


def unknown_values(dimension: str, key: str) -> dict[str, object]:
    """Literal values of a dimension's unknown row; version columns come from the caller."""
    base: dict[str, object] = {key: UNKNOWN_KEY}
    if dimension == "geography":
        return {**base, "geo_address_id": 0, **_all_text(GEOGRAPHY_TRACKED, "N/A")}
    if dimension == "customer":
        names = [*CUSTOMER_TRACKED, "cust_full_name"]
        return {**base, "cust_customer_id": 0, **_all_text(names, "N/A"), "cust_type": "Business"}
    if dimension == "product_category":
        return {**base, "prod_cat_id": 0, "prod_cat_name": "Unknown", "prod_cat_level": 0,
                "prod_cat_hierarchy_path": "Unknown", "prod_cat_is_leaf": True}
    if dimension == "product":
        texts = ["prod_name", "prod_product_number", "prod_color", "prod_size", "prod_category_name",
                 "prod_category_hierarchy", "prod_model_name", "prod_price_range", "prod_weight_range"]
        return {**base, "prod_product_id": 0, **_all_text(texts, "Unknown"),
                "prod_standard_cost": 0, "prod_list_price": 0, "prod_weight": 0,
                "prod_sell_start_date": dt.date(2000, 1, 1), "_tf_dim_product_category_sk": UNKNOWN_KEY,
                "prod_category_id": 0, "prod_model_id": 0, "prod_is_active": False,
                "prod_days_to_sell": 0, "prod_profit_margin": 0}
    raise ValueError(f"no unknown member defined for {dimension}")


def version_values(load_date: dt.datetime | str, versioned: bool = True) -> dict[str, object]:
    """Version and load time columns of an unknown row."""
    now = dt.datetime.fromisoformat(str(load_date))
    out: dict[str, object] = {"_tf_create_date": now, "_tf_update_date": now}
    if versioned:
        out.update(_tf_valid_from=dt.datetime.fromisoformat(UNKNOWN_SINCE), _tf_valid_to=None, _tf_is_current=True)
    return out
