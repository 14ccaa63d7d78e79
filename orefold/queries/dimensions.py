"""Gold dimensions and the sales fact, loaded from two source snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.operators.calendar import calendar_attributes, explode_days
from orefold.operators.hierarchy import flatten_hierarchy
from orefold.operators.merge import upsert
from orefold.operators.scd2 import first_versions, load_time, scd2_apply
from orefold.operators.star import with_unknown_member
from orefold.plans import dims, facts
from orefold.queries import sql_sources as q
from orefold.queries.common import (
    AS_OF, LOAD_TIMES, categories, customers, fact, places, products, renamed, utc,
)
from orefold.session import free_shuffles
from orefold.sinks.files import stored
from orefold.sources.readers import read_parquet


def _order_days(spark, folder):
    """First and last order date."""
    day = F.to_date("o_orderdate")
    return read_parquet(utc(spark), folder, "orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def date_series(spark, folder):
    return explode_days(_order_days(spark, folder), "first_day", "last_day")


def calendar_dimension(spark, folder):
    """Calendar columns for every day between the first and the last order."""
    return calendar_attributes(date_series(spark, folder))


def unknown_member(spark, folder):
    """The geography dimension of all addresses with its unknown row."""
    rows = places(spark, folder).drop("_tf_is_current")
    return with_unknown_member(rows, dims.unknown_values("geography", "_tf_dim_geography_sk"))


def _in_place(old, new, key: str):
    tracked = [c for c in new.columns if c != key]
    stored = old.withColumns({"_tf_create_date": load_time(LOAD_TIMES[1]), "_tf_update_date": load_time(LOAD_TIMES[1])})
    now = load_time(LOAD_TIMES[2])
    return upsert(stored, new, [key], tracked, on_update={"_tf_update_date": now},
                  on_insert={"_tf_create_date": now, "_tf_update_date": now})


def geography_in_place(spark, folder):
    old, new = (dims.geography_attributes(renamed(spark, folder, "address", s)) for s in (1, 2))
    return _in_place(old, new, "geo_address_id")


def customer_in_place(spark, folder):
    old, new = (dims.customer_attributes(renamed(spark, folder, "customer", s), "course") for s in (1, 2))
    return _in_place(old, new, "cust_customer_id")


def _history(old, new, key: str, tracked):
    first = first_versions(old, LOAD_TIMES[1], change_type=False)
    return scd2_apply(first, new, [key], LOAD_TIMES[2], tracked, close_missing=False)


def customer_history(spark, folder):
    old, new = (dims.customer_attributes(renamed(spark, folder, "customer", s)) for s in (1, 2))
    return _history(old, new, "cust_customer_id", dims.CUSTOMER_TRACKED)


def category_history(spark, folder):
    old, new = (dims.category_attributes(renamed(spark, folder, "productcategory", s)) for s in (1, 2))
    return _history(old, new, "prod_cat_id", dims.CATEGORY_TRACKED)


def _product(spark, folder, snapshot: int):
    return dims.product_attributes(renamed(spark, folder, "product", snapshot), categories(spark, folder),
                                   renamed(spark, folder, "productmodel"), AS_OF)


def product_history(spark, folder):
    return _history(_product(spark, folder, 1), _product(spark, folder, 2), "prod_product_id", dims.PRODUCT_TRACKED)


def product_dimension(spark, folder):
    return _product(spark, folder, 3)


def hierarchy(spark, folder):
    """Region, nation and supplier as one tree of three levels."""
    spark = utc(spark)
    none = F.lit(None).cast("bigint")
    region = read_parquet(spark, folder, "region").select(
        (-F.col("r_regionkey") - 1).cast("bigint").alias("id"), none.alias("parent"), F.col("r_name").alias("label"))
    nation = read_parquet(spark, folder, "nation").select(
        (-F.col("n_nationkey") - 1000).cast("bigint").alias("id"),
        (-F.col("n_regionkey") - 1).cast("bigint").alias("parent"), F.col("n_name").alias("label"))
    supplier = read_parquet(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("id"),
        (-F.col("s_nationkey") - 1000).cast("bigint").alias("parent"), F.col("s_name").alias("label"))
    return flatten_hierarchy(region.unionByName(nation).unionByName(supplier), "id", "parent", "label")


def masked(spark, folder):
    """Customers as a reader without the administrator role sees them."""
    return dims.masked_customers(customers(spark, folder).drop("_tf_is_current"), is_admin=False)


def staged(spark, folder, snapshot: int):
    """Fact staging of a snapshot against gold dimensions that lack members (see the SQL)."""
    known_customers = customers(spark, folder).filter("cust_company_name <> 'MACHINERY'")
    known_products = products(spark, folder).filter("prod_price_range <> 'Ultra-Luxury (3000+)'")
    return facts.stage_sales(
        renamed(spark, folder, "sales_order_detail", snapshot), renamed(spark, folder, "sales_order_header", snapshot),
        renamed(spark, folder, "customer", snapshot), renamed(spark, folder, "address", snapshot),
        known_customers, places(spark, folder), renamed(spark, folder, "product", snapshot), known_products,
    )


def fact_lookup(spark, folder):
    return staged(spark, folder, 2)


def fact_upsert(spark, folder):
    """Two loads of the fact; lines gone from the second snapshot stay.

    The staged rows of each load are stored, as a load of the gold layer does: the shuffles that found their keys are gone
    when the next ones begin, and the merge shuffles each row once.
    """
    now = load_time(LOAD_TIMES[1])
    loads = []
    for snapshot in (1, 2):
        loads.append(stored(staged(spark, folder, snapshot), f"staged-{snapshot}"))
        free_shuffles(spark)
    first, second = loads
    return facts.upsert_sales(first.withColumns({"_tf_create_date": now, "_tf_update_date": now}), second, LOAD_TIMES[2])


def fact_amounts(spark, folder):
    return fact(spark, folder).select(
        "sales_order_id", "sales_order_detail_id", "sales_discount_amount", "sales_net_amount")


QUERIES = {
    "date_series": date_series,
    "dim_calendar": calendar_dimension,
    "unknown_member": unknown_member,
    "dim_geography_t1": geography_in_place,
    "dim_customer_t1": customer_in_place,
    "dim_customer_scd2": customer_history,
    "dim_category_scd2": category_history,
    "dim_product_scd2": product_history,
    "dim_product": product_dimension,
    "hierarchy_flatten": hierarchy,
    "masked_customers": masked,
    "fact_star_lookup": fact_lookup,
    "fact_upsert": fact_upsert,
    "fact_derived": fact_amounts,
}

# -- SQL ------------------------------------------------------------------------------------------

_DAYS = """SELECT CAST(g AS DATE) AS day FROM (SELECT unnest(generate_series(
    (SELECT CAST(min(o_orderdate) AS DATE) FROM orders)::TIMESTAMP,
    (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)::TIMESTAMP, INTERVAL 1 DAY)) AS g)"""
_GEO = ["geo_address_id", *dims.GEOGRAPHY_TRACKED]
_CUST = ["cust_customer_id", *dims.CUSTOMER_TRACKED, "cust_full_name", "cust_type"]
_COURSE = ", ".join([
    "customer_id AS cust_customer_id",
    *[f"coalesce({c}, 'N/A') AS {n}" for n, c in
      {**dims.CUSTOMER_TEXT, "cust_email_address": "email_address", "cust_phone": "phone"}.items()],
])
_CAT = ["prod_cat_id", "prod_cat_name", "prod_cat_parent_id", "prod_cat_parent_name", "prod_cat_grandparent_id",
        "prod_cat_grandparent_name", "prod_cat_level", "prod_cat_hierarchy_path", "prod_cat_is_leaf"]
_PROD = ["prod_product_id", "prod_name", "prod_product_number", "prod_color", "prod_standard_cost", "prod_list_price",
         "prod_size", "prod_weight", "prod_sell_start_date", "prod_sell_end_date", "prod_discontinued_date",
         "_tf_dim_product_category_sk", "prod_category_id", "prod_category_name", "prod_category_hierarchy",
         "prod_model_id", "prod_model_name", "prod_price_range", "prod_weight_range", "prod_is_active",
         "prod_days_to_sell", "prod_profit_margin"]
_TREE = f"SELECT *, CAST(prod_cat_id AS BIGINT) + 1 AS category_sk FROM ({q.category_tree(q.category(3))})"


def _attrs(attributes: str, rows: str) -> str:
    return f"SELECT {attributes} FROM ({rows})"


def _prod(s: int) -> str:
    return q.product_dimension(q.product(s), _TREE, q.model(3))


def _staged(s: int) -> str:
    return f"""
    SELECT d.sales_order_id, d.sales_order_detail_id,
      CAST(10000 * year(h.order_date) + 100 * month(h.order_date) + day(h.order_date) AS INTEGER) AS _tf_dim_calendar_sk,
      CASE WHEN c.customer_id IS NULL OR dc.cust_customer_id IS NULL THEN -9 ELSE h.customer_id + 1 END AS _tf_dim_customer_sk,
      CASE WHEN a.address_id IS NULL THEN -9 ELSE h.bill_to_address_id + 1 END AS _tf_dim_geography_sk,
      CASE WHEN p.product_id IS NULL OR dp.prod_product_id IS NULL THEN -9 ELSE d.product_id + 1 END AS _tf_dim_product_sk,
      d.order_qty AS sales_order_qty, d.unit_price AS sales_unit_price,
      d.unit_price_discount AS sales_unit_price_discount, d.line_total AS sales_line_total
    FROM ({q.detail(s)}) d LEFT JOIN ({q.header(s)}) h ON d.sales_order_id = h.sales_order_id
    LEFT JOIN ({q.customer(s)}) c ON h.customer_id = c.customer_id
    LEFT JOIN (SELECT * FROM ({_attrs(q.CUSTOMER_ATTRIBUTES, q.customer(3))}) WHERE cust_company_name <> 'MACHINERY') dc
      ON c.customer_id = dc.cust_customer_id
    LEFT JOIN ({q.address(s)}) a ON h.bill_to_address_id = a.address_id
    LEFT JOIN ({q.product(s)}) p ON d.product_id = p.product_id
    LEFT JOIN (SELECT * FROM ({_prod(3)}) WHERE prod_price_range <> 'Ultra-Luxury (3000+)') dp
      ON p.product_id = dp.prod_product_id"""


_FACT = ["_tf_dim_calendar_sk", "_tf_dim_customer_sk", "_tf_dim_geography_sk", "_tf_dim_product_sk",
         "sales_order_qty", "sales_unit_price", "sales_unit_price_discount", "sales_line_total"]
_NODES = """SELECT CAST(-r_regionkey - 1 AS BIGINT) AS product_category_id, CAST(NULL AS BIGINT) AS parent_product_category_id,
    r_name AS name FROM region
  UNION ALL SELECT CAST(-n_nationkey - 1000 AS BIGINT), CAST(-n_regionkey - 1 AS BIGINT), n_name FROM nation
  UNION ALL SELECT CAST(s_suppkey AS BIGINT), CAST(-s_nationkey - 1000 AS BIGINT), s_name FROM supplier"""
_MASKS = {c: "'***MASKED***'" for c in dims.MASKED_COLUMNS}

ORACLE = {
    "date_series": _DAYS,
    "dim_calendar": f"""
        SELECT CAST(10000 * year(d) + 100 * month(d) + day(d) AS INTEGER) AS _tf_dim_calendar_sk, d AS cal_date,
          CAST(year(d) AS INTEGER) AS cal_year, CAST(month(d) AS INTEGER) AS cal_month,
          CAST(day(d) AS INTEGER) AS cal_day_of_month, strftime(d, '%A %B %d %Y') AS cal_date_full,
          strftime(d, '%A') AS cal_day_name, CAST(date_trunc('week', d) AS DATE) AS cal_week_start,
          CAST(date_trunc('week', d) AS DATE) + 6 AS cal_week_end, CAST(isodow(d) AS INTEGER) AS cal_week_day,
          CAST(weekofyear(d) AS INTEGER) AS cal_week_of_year, strftime(d, '%B %Y') AS cal_month_year,
          strftime(d, '%B') AS cal_month_name, CAST(date_trunc('month', d) AS DATE) AS cal_first_day_of_month,
          last_day(d) AS cal_last_day_of_month, CAST(quarter(d) AS INTEGER) AS cal_quarter,
          CAST(quarter(d) AS INTEGER) AS cal_fiscal_quarter, CAST(year(d + 89) AS INTEGER) AS cal_fiscal_year,
          isodow(d) >= 6 AS cal_is_weekend, day(d) = 1 AS cal_is_month_start, d = last_day(d) AS cal_is_month_end
        FROM (SELECT day AS d FROM ({_DAYS}))""",
    "unknown_member": f"""
        SELECT {', '.join(_GEO)}, geo_address_id + 1 AS _tf_dim_geography_sk
        FROM ({_attrs(q.GEOGRAPHY_ATTRIBUTES, q.address(3))})
        UNION ALL SELECT 0, 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', -9""",
    "dim_geography_t1": q.dimension_update(
        _attrs(q.GEOGRAPHY_ATTRIBUTES, q.address(1)), _attrs(q.GEOGRAPHY_ATTRIBUTES, q.address(2)), "geo_address_id", _GEO),
    "dim_customer_t1": q.dimension_update(
        _attrs(_COURSE, q.customer(1)), _attrs(_COURSE, q.customer(2)), "cust_customer_id",
        ["cust_customer_id", *dims.CUSTOMER_TRACKED]),
    "dim_customer_scd2": q.dimension_history(
        _attrs(q.CUSTOMER_ATTRIBUTES, q.customer(1)), _attrs(q.CUSTOMER_ATTRIBUTES, q.customer(2)),
        "cust_customer_id", _CUST, dims.CUSTOMER_TRACKED),
    "dim_category_scd2": q.dimension_history(
        q.category_tree(q.category(1)), q.category_tree(q.category(2)), "prod_cat_id", _CAT, dims.CATEGORY_TRACKED),
    "dim_product_scd2": q.dimension_history(_prod(1), _prod(2), "prod_product_id", _PROD, dims.PRODUCT_TRACKED),
    "dim_product": _prod(3),
    "hierarchy_flatten": f"""
        WITH nodes AS ({_NODES})
        SELECT c.product_category_id AS node_id, c.name AS node_name, c.parent_product_category_id AS parent_id,
          p.name AS parent_name, p.parent_product_category_id AS grandparent_id, g.name AS grandparent_name,
          CASE WHEN c.parent_product_category_id IS NULL THEN 1 WHEN p.parent_product_category_id IS NULL THEN 2 ELSE 3 END
            AS node_level,
          CASE WHEN c.parent_product_category_id IS NULL THEN c.name
               WHEN p.parent_product_category_id IS NULL THEN p.name || ' > ' || c.name
               ELSE g.name || ' > ' || p.name || ' > ' || c.name END AS node_path,
          NOT EXISTS (SELECT 1 FROM nodes x WHERE x.parent_product_category_id = c.product_category_id) AS is_leaf
        FROM nodes c LEFT JOIN nodes p ON c.parent_product_category_id = p.product_category_id
        LEFT JOIN nodes g ON p.parent_product_category_id = g.product_category_id""",
    "masked_customers": f"""
        SELECT {', '.join(f"{_MASKS[c]} AS {c}" if c in _MASKS else c for c in _CUST)},
          cust_customer_id + 1 AS _tf_dim_customer_sk FROM ({_attrs(q.CUSTOMER_ATTRIBUTES, q.customer(3))})""",
    "fact_star_lookup": _staged(2),
    "fact_upsert": f"""
        SELECT coalesce(o.sales_order_id, n.sales_order_id) AS sales_order_id,
          coalesce(o.sales_order_detail_id, n.sales_order_detail_id) AS sales_order_detail_id,
          {', '.join(f'CASE WHEN n.sales_order_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}' for c in _FACT)},
          CASE WHEN o.sales_order_id IS NULL THEN {q.T[2]} ELSE {q.T[1]} END AS _tf_create_date,
          CASE WHEN o.sales_order_id IS NULL OR (n.sales_order_id IS NOT NULL AND {q.differs(_FACT)})
               THEN {q.T[2]} ELSE {q.T[1]} END AS _tf_update_date
        FROM ({_staged(1)}) o FULL OUTER JOIN ({_staged(2)}) n
        ON o.sales_order_id = n.sales_order_id AND o.sales_order_detail_id = n.sales_order_detail_id""",
    "fact_derived": f"""SELECT sales_order_id, sales_order_detail_id,
        CAST(order_qty * unit_price * unit_price_discount AS DECIMAL(38,6)) AS sales_discount_amount,
        line_total AS sales_net_amount FROM ({q.detail(3)})""",
}
