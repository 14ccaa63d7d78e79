"""Merges, row history and change feeds between source snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.operators import scd2
from orefold.operators.keys import surrogate_keys
from orefold.operators.merge import classify, delete_where, merge_counts, update_where
from orefold.plans.bronze import upsert_bronze
from orefold.queries import sql_sources as q
from orefold.queries.common import LOAD_TIMES, bronze, hash_history, hashed, renamed
from orefold.sources.entities import ENTITIES, with_parent_category
from orefold.streaming import change_feed


def bronze_upsert_single(spark, folder):
    return upsert_bronze(ENTITIES["customer"], bronze(spark, folder, "customer", 1), bronze(spark, folder, "customer", 2))


def bronze_upsert_composite(spark, folder):
    name = "sales_order_detail"
    return upsert_bronze(ENTITIES[name], bronze(spark, folder, name, 1), bronze(spark, folder, name, 2))


def bronze_upsert_unconditional(spark, folder):
    name = "vgetallcategories"
    return upsert_bronze(ENTITIES[name], bronze(spark, folder, name, 1), bronze(spark, folder, name, 2))


def update_rows(spark, folder):
    """Sets a postal code and a time on some rows; rows whose test is NULL stay as they are."""
    rows = renamed(spark, folder, "address", 1)
    return update_where(rows, F.col("address_line2") == "Suite 3", {
        "postal_code": F.lit("12345"), "modified_date": F.lit(LOAD_TIMES[2]).cast("timestamp")})


def delete_rows(spark, folder):
    return delete_where(renamed(spark, folder, "address", 1), F.col("address_line2") != "Suite 3")


def merge_classes(spark, folder):
    merged = classify(hashed(spark, folder, "customer", 1), hashed(spark, folder, "customer", 2),
                      ["customer_id"], ["_tf_row_hash"])
    return merged.select("customer_id", "merge_class")


def merge_composite(spark, folder):
    name = "sales_order_detail"
    merged = classify(hashed(spark, folder, name, 1), hashed(spark, folder, name, 2),
                      ENTITIES[name].silver_keys, ["_tf_row_hash"])
    return merge_counts(merged)


def change_null_safe(spark, folder):
    """Customers whose phone or company differs, NULLs included."""
    merged = classify(renamed(spark, folder, "customer", 1), renamed(spark, folder, "customer", 2),
                      ["customer_id"], ["phone", "company_name"])
    return merged.filter(F.col("merge_class") == "UPDATE").select(
        "customer_id", F.col("t.phone").alias("old_phone"), F.col("s.phone").alias("new_phone"),
        F.col("t.company_name").alias("old_company"), F.col("s.company_name").alias("new_company"))


def _by_columns(spark, folder, entity: str, null_safe: bool):
    """Column-compare history after two snapshots, without hash, flag and change type."""
    spec = ENTITIES[entity]
    first = scd2.first_versions(renamed(spark, folder, entity, 1), LOAD_TIMES[1], change_type=False)
    return scd2.scd2_apply(first, renamed(spark, folder, entity, 2), spec.silver_keys, LOAD_TIMES[2],
                           spec.attributes, null_safe).drop("_tf_is_current")


def scd2_reload(spark, folder):
    """A second load of the same snapshot adds nothing; the result is the first load's table."""
    once = hash_history(spark, folder, "customer", 1)
    return scd2.scd2_apply(once, hashed(spark, folder, "customer", 1), ["customer_id"], LOAD_TIMES[2])


def timeline(spark, folder):
    return scd2.version_timeline(hash_history(spark, folder, "sales_order_detail", 2),
                                 ["sales_order_id", "sales_order_detail_id"])


def current_rows(spark, folder):
    return hash_history(spark, folder, "sales_order_header", 2).filter("_tf_is_current")


def anti_join(spark, folder):
    """Source rows without an identical current row: what a history load inserts."""
    stored = hash_history(spark, folder, "customer", 1).filter("_tf_is_current").select("customer_id", "_tf_row_hash")
    return hashed(spark, folder, "customer", 2).join(stored, ["customer_id", "_tf_row_hash"], "left_anti").select(
        "customer_id", "_tf_row_hash")


def existence_flag(spark, folder):
    """Every source customer with a flag: was the key ever stored?"""
    stored = hash_history(spark, folder, "customer", 1).select("customer_id").distinct().withColumn("_known", F.lit(True))
    return hashed(spark, folder, "customer", 2).join(stored, "customer_id", "left").select(
        "customer_id", F.when(F.col("_known").isNull(), "INSERT").otherwise("UPDATE").alias("_tf_change_type"))


def scalar_lookup(spark, folder):
    rows = hashed(spark, folder, "vgetallcategories")
    return with_parent_category(rows, bronze(spark, folder, "productcategory"))


def category_view_history(spark, folder):
    """History of the category view: hashed on names, parent id looked up when a version is added."""
    def load(snapshot: int):
        rows = hashed(spark, folder, "vgetallcategories", snapshot)
        return with_parent_category(rows, bronze(spark, folder, "productcategory", snapshot))

    first = scd2.first_versions(load(1), LOAD_TIMES[1])
    return scd2.scd2_apply(first, load(2), ["product_category_id"], LOAD_TIMES[2])


def keys(spark, folder):
    """Gap-free surrogate keys for all order lines."""
    rows = renamed(spark, folder, "sales_order_detail").select("sales_order_id", "sales_order_detail_id")
    return surrogate_keys(rows, ["sales_order_id", "sales_order_detail_id"], "_tf_id")


def feed(spark, folder):
    return change_feed(renamed(spark, folder, "customer", 1), renamed(spark, folder, "customer", 2), ["customer_id"])


QUERIES = {
    "bronze_upsert_single": bronze_upsert_single,
    "bronze_upsert_composite": bronze_upsert_composite,
    "bronze_upsert_unconditional": bronze_upsert_unconditional,
    "update_where": update_rows,
    "delete_where": delete_rows,
    "merge_classify": merge_classes,
    "merge_composite_key": merge_composite,
    "change_null_safe": change_null_safe,
    "scd2_columns": lambda spark, folder: _by_columns(spark, folder, "customer", True),
    "scd2_null_unsafe": lambda spark, folder: _by_columns(spark, folder, "customer", False),
    "scd2_hash": lambda spark, folder: hash_history(spark, folder, "customer", 2),
    "scd2_hash_composite": lambda spark, folder: hash_history(spark, folder, "sales_order_detail", 2),
    "scd2_hash_header": lambda spark, folder: hash_history(spark, folder, "sales_order_header", 2),
    "scd2_hash_product": lambda spark, folder: hash_history(spark, folder, "product", 2),
    "scd2_hash_three_keys": lambda spark, folder: hash_history(spark, folder, "productmodelproductdescription", 2),
    "scd2_hash_view": category_view_history,
    "scd2_reappear": lambda spark, folder: hash_history(spark, folder, "customer", 3),
    "scd2_reload": scd2_reload,
    "version_timeline": timeline,
    "current_rows": current_rows,
    "anti_join": anti_join,
    "existence_flag": existence_flag,
    "scalar_lookup": scalar_lookup,
    "surrogate_keys": keys,
    "change_feed": feed,
}

# -- SQL ------------------------------------------------------------------------------------------

_C, _A, _D, _H = q.CUSTOMER_COLUMNS, q.ADDRESS_COLUMNS, q.DETAIL_COLUMNS, q.HEADER_COLUMNS
_CUSTOMER = [q.with_hash(q.customer(s), q.CUSTOMER_HASHED) for s in (1, 2, 3)]
_DETAIL = [q.with_hash(q.detail(s), q.DETAIL_HASHED) for s in (1, 2, 3)]
_HEADER = [q.with_hash(q.header(s), q.HEADER_HASHED) for s in (1, 2, 3)]
_SOURCE_NAMES = {
    "customer": ["CustomerID", "NameStyle", "Title", "FirstName", "MiddleName", "LastName", "Suffix", "CompanyName",
                 "SalesPerson", "EmailAddress", "Phone", "PasswordHash", "PasswordSalt", "rowguid", "ModifiedDate"],
    "detail": ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount",
               "LineTotal", "rowguid", "ModifiedDate"],
}


def _upsert_sql(old: str, new: str, keys: list[str], columns: list[str], names: list[str], update: str) -> str:
    """Full outer join; ``update`` is the condition over aliases o and n."""
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    k = keys[0]
    picks = ", ".join(
        f'CASE WHEN o.{k} IS NULL THEN n.{c} WHEN n.{k} IS NULL THEN o.{c} WHEN {update} THEN n.{c} ELSE o.{c} END AS "{name}"'
        for c, name in zip(columns, names))
    return f"SELECT {picks} FROM ({old}) o FULL OUTER JOIN ({new}) n ON {on}"


def _distinct(columns: list[str]) -> str:
    return " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns)


def _unsafe(columns: list[str]) -> str:
    return "(" + " OR ".join(f"coalesce(o.{c} <> n.{c}, FALSE)" for c in columns) + ")"


def _two_step(columns: list[str], update: str) -> str:
    """History after two snapshots of customers, by a change condition over aliases o and n."""
    old, new = q.customer(1), q.customer(2)
    listed_o, listed_n = (", ".join(f"{x}.{c}" for c in columns) for x in "on")
    t1, t2 = q.T[1], q.T[2]
    ended = f"n.customer_id IS NULL OR {update}"
    return f"""
    SELECT {listed_o}, {t1} AS _tf_valid_from, CASE WHEN {ended} THEN {t2} END AS _tf_valid_to,
      {t1} AS _tf_create_date, CASE WHEN {ended} THEN {t2} ELSE {t1} END AS _tf_update_date
    FROM ({old}) o LEFT JOIN ({new}) n ON o.customer_id = n.customer_id
    UNION ALL
    SELECT {listed_n}, {t2}, CAST(NULL AS TIMESTAMP), {t2}, {t2}
    FROM ({new}) n LEFT JOIN ({old}) o ON o.customer_id = n.customer_id
    WHERE o.customer_id IS NULL OR {update}"""


def _all_categories(s: int) -> str:
    nodes = q.category(s)
    return f"""SELECT p.name AS parent_name, c.name AS category_name, c.product_category_id AS category_id
      FROM ({nodes}) c LEFT JOIN ({nodes}) p ON c.parent_product_category_id = p.product_category_id"""


_PRODUCT_HASHED = [c for c in q.PRODUCT_COLUMNS if c not in ("product_id", "thumbnail_photo", "thumbnail_photo_file_name", "rowguid")]
_VIEW = [f"""SELECT v.category_id AS product_category_id, v.category_name AS name, c.parent_product_category_id,
    {q.hash_of(['v.parent_name', 'v.category_name'])} AS _tf_row_hash
    FROM ({_all_categories(s)}) v JOIN ({q.category(s)}) c ON c.product_category_id = v.category_id""" for s in (1, 2)]
_THREE = f"""SELECT {q.MODEL_ID} AS product_model_id, CAST({q.text_id(['p_brand', 'culture'], 7)} AS INTEGER)
    AS product_description_id, culture, md5(p_brand) AS rowguid, {q.OLD} AS modified_date
    FROM (SELECT DISTINCT p_brand FROM part), (VALUES ('en'), ('fr')) t(culture)"""
_THREE_COLUMNS = ["product_model_id", "product_description_id", "culture", "rowguid", "modified_date"]
_THREE_HASHED = q.with_hash(_THREE, ["product_model_id", "product_description_id", "culture", "modified_date"])
_KINDS = "CASE WHEN o.{k} IS NULL THEN 'INSERT' WHEN n.{k} IS NULL THEN 'TARGET_ONLY' WHEN o._tf_row_hash <> n._tf_row_hash THEN 'UPDATE' ELSE 'SAME' END"
_attributes = [c for c in _C if c != "customer_id"]

ORACLE = {
    "bronze_upsert_single": _upsert_sql(
        q.customer(1), q.customer(2), ["customer_id"], _C, _SOURCE_NAMES["customer"],
        "(" + _distinct(["first_name", "last_name", "email_address", "modified_date"]) + ")"),
    "bronze_upsert_composite": _upsert_sql(
        q.detail(1), q.detail(2), ["sales_order_id", "sales_order_detail_id"], _D, _SOURCE_NAMES["detail"],
        "(" + _distinct(["order_qty", "unit_price", "modified_date"]) + ")"),
    "bronze_upsert_unconditional": _upsert_sql(
        _all_categories(1), _all_categories(2), ["category_id"], ["parent_name", "category_name", "category_id"],
        ["ParentProductCategoryName", "ProductCategoryName", "ProductCategoryID"], "TRUE"),
    "update_where": f"""SELECT address_id, address_line1, address_line2, city, state_province, country_region,
        CASE WHEN address_line2 = 'Suite 3' THEN '12345' ELSE postal_code END AS postal_code, rowguid,
        CASE WHEN address_line2 = 'Suite 3' THEN {q.T[2]} ELSE modified_date END AS modified_date FROM ({q.address(1)})""",
    "delete_where": f"SELECT {', '.join(_A)} FROM ({q.address(1)}) WHERE (address_line2 <> 'Suite 3') IS NOT TRUE",
    "merge_classify": f"""SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
        {_KINDS.format(k='customer_id')} AS merge_class
        FROM ({_CUSTOMER[0]}) o FULL OUTER JOIN ({_CUSTOMER[1]}) n ON o.customer_id = n.customer_id""",
    "merge_composite_key": f"""SELECT {_KINDS.format(k='sales_order_id')} AS merge_class, count(*) AS row_count
        FROM ({_DETAIL[0]}) o FULL OUTER JOIN ({_DETAIL[1]}) n
        ON o.sales_order_id = n.sales_order_id AND o.sales_order_detail_id = n.sales_order_detail_id GROUP BY 1""",
    "change_null_safe": f"""SELECT o.customer_id, o.phone AS old_phone, n.phone AS new_phone,
        o.company_name AS old_company, n.company_name AS new_company
        FROM ({q.customer(1)}) o JOIN ({q.customer(2)}) n ON o.customer_id = n.customer_id
        WHERE {_distinct(['phone', 'company_name'])}""",
    "scd2_columns": _two_step(_C, "(" + _distinct(_attributes) + ")"),
    "scd2_null_unsafe": _two_step(_C, _unsafe(_attributes)),
    "scd2_hash": q.history(_CUSTOMER[:2], ["customer_id"], _C),
    "scd2_hash_composite": q.history(_DETAIL[:2], ["sales_order_id", "sales_order_detail_id"], _D),
    "scd2_hash_header": q.history(_HEADER[:2], ["sales_order_id"], _H),
    "scd2_hash_product": q.history(
        [q.with_hash(q.product(s), _PRODUCT_HASHED) for s in (1, 2)], ["product_id"], q.PRODUCT_COLUMNS),
    "scd2_hash_three_keys": q.history([_THREE_HASHED] * 2, _THREE_COLUMNS[:3], _THREE_COLUMNS),
    "scd2_hash_view": q.history(_VIEW, ["product_category_id"], ["product_category_id", "name", "parent_product_category_id"]),
    "scd2_reappear": q.history(_CUSTOMER, ["customer_id"], _C),
    "scd2_reload": q.history(_CUSTOMER[:1], ["customer_id"], _C),
    "version_timeline": f"""SELECT sales_order_id, sales_order_detail_id, _tf_valid_from, _tf_valid_to, _tf_create_date,
        _tf_update_date FROM ({q.history(_DETAIL[:2], ['sales_order_id', 'sales_order_detail_id'], _D)})""",
    "current_rows": f"SELECT * FROM ({q.history(_HEADER[:2], ['sales_order_id'], _H)}) WHERE _tf_is_current",
    "anti_join": f"""SELECT customer_id, _tf_row_hash FROM ({_CUSTOMER[1]}) n WHERE NOT EXISTS (
        SELECT 1 FROM ({_CUSTOMER[0]}) o WHERE o.customer_id = n.customer_id AND o._tf_row_hash = n._tf_row_hash)""",
    "existence_flag": f"""SELECT customer_id, CASE WHEN NOT EXISTS (SELECT 1 FROM ({_CUSTOMER[0]}) o
        WHERE o.customer_id = n.customer_id) THEN 'INSERT' ELSE 'UPDATE' END AS _tf_change_type FROM ({_CUSTOMER[1]}) n""",
    "scalar_lookup": f"""SELECT v.category_id AS product_category_id, v.category_name AS name,
        {q.hash_of(['v.parent_name', 'v.category_name'])} AS _tf_row_hash,
        (SELECT c.parent_product_category_id FROM ({q.category(3)}) c WHERE c.product_category_id = v.category_id LIMIT 1)
          AS parent_product_category_id FROM ({_all_categories(3)}) v""",
    "surrogate_keys": f"""SELECT sales_order_id, sales_order_detail_id, row_number() OVER (ORDER BY
        md5(CAST(sales_order_id AS VARCHAR) || '|' || CAST(sales_order_detail_id AS VARCHAR)),
        sales_order_id, sales_order_detail_id) AS _tf_id FROM ({q.detail(3)})""",
    "change_feed": f"""
        SELECT {', '.join('n.' + c for c in _C)}, 'insert' AS _change_type FROM ({q.customer(2)}) n
          WHERE NOT EXISTS (SELECT 1 FROM ({q.customer(1)}) o WHERE o.customer_id = n.customer_id)
        UNION ALL SELECT {', '.join('o.' + c for c in _C)}, 'delete' FROM ({q.customer(1)}) o
          WHERE NOT EXISTS (SELECT 1 FROM ({q.customer(2)}) n WHERE o.customer_id = n.customer_id)
        UNION ALL SELECT {', '.join('o.' + c for c in _C)}, 'update_pre' FROM ({q.customer(1)}) o
          JOIN ({q.customer(2)}) n ON o.customer_id = n.customer_id WHERE {_distinct(_attributes)}
        UNION ALL SELECT {', '.join('n.' + c for c in _C)}, 'update_post' FROM ({q.customer(1)}) o
          JOIN ({q.customer(2)}) n ON o.customer_id = n.customer_id WHERE {_distinct(_attributes)}""",
}
