"""The sample entities as DuckDB SELECT statements, written independently of the DataFrame code."""

from __future__ import annotations

T = {1: "TIMESTAMP '2024-01-01 00:00:00'", 2: "TIMESTAMP '2024-01-02 00:00:00'", 3: "TIMESTAMP '2024-01-03 00:00:00'"}
OLD, NEW = "TIMESTAMP '2023-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"
M = "DECIMAL(19,4)"


def text_id(parts: list[str], digits: int = 15) -> str:
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, {digits}) AS BIGINT)"


def hash_of(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('|', {parts}))"


def _members(snapshot: int, arrives: str, leaves: str) -> str:
    return {1: f"NOT ({arrives})", 2: f"(({arrives}) OR NOT ({leaves}))", 3: "TRUE"}[snapshot]


CUSTOMER_COLUMNS = [
    "customer_id", "name_style", "title", "first_name", "middle_name", "last_name", "suffix", "company_name",
    "sales_person", "email_address", "phone", "password_hash", "password_salt", "rowguid", "modified_date",
]
CUSTOMER_HASHED = [c for c in CUSTOMER_COLUMNS if c not in ("customer_id", "password_hash", "password_salt")]
ADDRESS_COLUMNS = [
    "address_id", "address_line1", "address_line2", "city", "state_province", "country_region", "postal_code",
    "rowguid", "modified_date",
]
DETAIL_COLUMNS = [
    "sales_order_id", "sales_order_detail_id", "order_qty", "product_id", "unit_price", "unit_price_discount",
    "line_total", "rowguid", "modified_date",
]
DETAIL_HASHED = DETAIL_COLUMNS[2:]
HEADER_COLUMNS = [
    "sales_order_id", "revision_number", "order_date", "due_date", "ship_date", "status", "online_order_flag",
    "sales_order_number", "purchase_order_number", "account_number", "customer_id", "ship_to_address_id",
    "bill_to_address_id", "ship_method", "credit_card_approval_code", "sub_total", "tax_amt", "freight",
    "total_due", "comment", "rowguid", "modified_date",
]
HEADER_HASHED = [
    "revision_number", "order_date", "status", "customer_id", "sub_total", "tax_amt", "freight", "total_due",
    "rowguid", "modified_date",
]
CATEGORY_COLUMNS = ["product_category_id", "parent_product_category_id", "name", "rowguid", "modified_date"]
CATEGORY_HASHED = ["parent_product_category_id", "name", "modified_date"]
PRODUCT_COLUMNS = [
    "product_id", "name", "product_number", "color", "standard_cost", "list_price", "size", "weight",
    "product_category_id", "product_model_id", "sell_start_date", "sell_end_date", "discontinued_date",
    "thumbnail_photo", "thumbnail_photo_file_name", "rowguid", "modified_date",
]


def _customer_members(s: int) -> str:
    return _members(s, "c_mktsegment = 'MACHINERY'", "c_acctbal < 0")


def customer(s: int) -> str:
    renamed = "c_mktsegment = 'BUILDING'" if s >= 2 else "FALSE"
    no_phone = "FURNITURE" if s >= 2 else "HOUSEHOLD"
    return f"""
    SELECT CAST(c_custkey AS BIGINT) AS customer_id, FALSE AS name_style,
      CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Ms.' END AS title, ' Customer ' AS first_name,
      CASE WHEN c_acctbal >= 0 THEN 'M' END AS middle_name, split_part(c_name, '#', 2) AS last_name,
      CAST(NULL AS VARCHAR) AS suffix,
      CASE WHEN {renamed} THEN 'CONSTRUCTION' WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS company_name,
      'agent' || c_nationkey AS sales_person,
      CASE WHEN c_acctbal >= 0 THEN 'C' || c_custkey || '@Example.COM' END AS email_address,
      CASE WHEN c_mktsegment <> '{no_phone}' THEN '555-' || c_nationkey END AS phone,
      md5(c_name) AS password_hash, CAST(NULL AS VARCHAR) AS password_salt,
      md5(CAST(c_custkey AS VARCHAR)) AS rowguid,
      CASE WHEN {renamed} THEN {NEW} ELSE {OLD} END AS modified_date
    FROM customer WHERE {_customer_members(s)}"""


def address(s: int) -> str:
    moved = "c_mktsegment = 'BUILDING'" if s >= 2 else "FALSE"
    return f"""
    SELECT CAST(c_custkey AS BIGINT) AS address_id, c_custkey || ' Main St' AS address_line1,
      CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Suite ' || c_nationkey END AS address_line2,
      CASE WHEN {moved} THEN 'New ' || n_name ELSE n_name END AS city, n_name AS state_province,
      r_name AS country_region,
      CASE WHEN c_acctbal >= 0 THEN (c_nationkey + 10000) || ' ' || n_regionkey END AS postal_code,
      md5(CAST(c_custkey AS VARCHAR)) AS rowguid,
      CASE WHEN {moved} THEN {NEW} ELSE {OLD} END AS modified_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE {_customer_members(s)}"""


def customeraddress(s: int) -> str:
    moved = "c_mktsegment = 'BUILDING'" if s >= 2 else "FALSE"
    return f"""
    SELECT CAST(c_custkey AS BIGINT) AS customer_id, CAST(c_custkey AS BIGINT) AS address_id,
      CASE WHEN {moved} THEN 'Shipping' ELSE 'Main Office' END AS address_type,
      md5(CAST(c_custkey AS VARCHAR)) AS rowguid, CASE WHEN {moved} THEN {NEW} ELSE {OLD} END AS modified_date
    FROM customer WHERE {_customer_members(s)}"""


def header(s: int) -> str:
    done = "o_orderstatus = 'P'" if s >= 2 else "FALSE"
    members = _members(s, "o_orderpriority = '2-HIGH'", "o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
    return f"""
    SELECT CAST(o_orderkey AS BIGINT) AS sales_order_id,
      CAST(CASE WHEN {done} THEN 2 ELSE 1 END AS SMALLINT) AS revision_number, o_orderdate AS order_date,
      o_orderdate + INTERVAL 12 DAY AS due_date,
      CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 7 DAY END AS ship_date,
      CAST(CASE WHEN {done} THEN 5 WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'P' THEN 2
           WHEN o_orderstatus = 'F' THEN 5 END AS SMALLINT) AS status,
      o_orderpriority = '1-URGENT' AS online_order_flag, 'SO' || o_orderkey AS sales_order_number,
      CAST(NULL AS VARCHAR) AS purchase_order_number, 'AC' || o_custkey AS account_number,
      CAST(o_custkey AS BIGINT) AS customer_id, CAST(o_custkey AS BIGINT) AS ship_to_address_id,
      CAST(o_custkey AS BIGINT) AS bill_to_address_id, o_orderpriority AS ship_method,
      CAST(NULL AS VARCHAR) AS credit_card_approval_code, CAST(o_totalprice AS {M}) AS sub_total,
      CAST(0 AS {M}) AS tax_amt, CAST(0 AS {M}) AS freight, CAST(o_totalprice AS {M}) AS total_due,
      CAST(NULL AS VARCHAR) AS comment, md5(CAST(o_orderkey AS VARCHAR)) AS rowguid,
      CASE WHEN {done} THEN {NEW} ELSE {OLD} END AS modified_date
    FROM orders WHERE {members}"""


def detail(s: int) -> str:
    cheaper = "l_returnflag = 'A' AND l_linestatus = 'O'" if s >= 2 else "FALSE"
    members = _members(s, "l_returnflag = 'N' AND l_linestatus = 'F'", "l_returnflag = 'R' AND l_linestatus = 'F'")
    identity = text_id([
        "l_linenumber", "l_partkey", "l_suppkey", f"CAST(l_quantity AS {M})", f"CAST(l_extendedprice AS {M})",
        f"CAST(l_discount AS {M})", f"CAST(l_tax AS {M})", "l_returnflag", "l_linestatus", "CAST(l_shipdate AS DATE)",
    ])
    return f"""
    SELECT CAST(l_orderkey AS BIGINT) AS sales_order_id, {identity} AS sales_order_detail_id,
      CAST(l_quantity AS SMALLINT) AS order_qty, CAST(l_partkey AS BIGINT) AS product_id,
      CAST(floor(l_extendedprice / l_quantity) AS {M}) AS unit_price,
      CASE WHEN {cheaper} THEN CAST(CAST(l_discount AS {M}) + CAST(0.05 AS {M}) AS {M})
           ELSE CAST(l_discount AS {M}) END AS unit_price_discount,
      CAST(CAST(l_extendedprice AS {M}) * (1 - CAST(l_discount AS {M})) AS DECIMAL(38,6)) AS line_total,
      md5(CAST(l_orderkey AS VARCHAR)) AS rowguid, CASE WHEN {cheaper} THEN {NEW} ELSE {OLD} END AS modified_date
    FROM lineitem WHERE {members}"""


SIZE_CLASS = "CASE WHEN p_size <= 25 THEN 'Compact' ELSE 'Large' END"
CATEGORY_ID = {
    1: f"CAST({text_id(['p_type'], 7)} AS INTEGER)",
    2: f"CAST({text_id(['p_type', 'p_brand'], 7)} AS INTEGER)",
    3: f"CAST({text_id(['p_type', 'p_brand', SIZE_CLASS], 7)} AS INTEGER)",
}
MODEL_ID = f"CAST({text_id(['p_brand'], 7)} AS INTEGER)"


def product(s: int) -> str:
    cheaper = "p_type = 'PROMO'" if s >= 2 else "FALSE"
    members = _members(s, "p_type = 'SMALL'", "p_type = 'ECONOMY' AND p_size > 40")
    price = f"CAST(CAST(p_retailprice AS {M}) * p_size * CAST(0.1 AS DECIMAL(2,1)) AS {M})"
    return f"""
    SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS name, 'P-' || p_partkey AS product_number,
      split_part(p_name, ' ', 1) AS color,
      CASE WHEN p_brand = 'Brand#1' THEN CAST(0 AS {M})
           ELSE CAST(CAST(p_retailprice AS {M}) * p_size * CAST(0.06 AS DECIMAL(3,2)) AS {M}) END AS standard_cost,
      CASE WHEN {cheaper} THEN CAST({price} * CAST(0.5 AS DECIMAL(2,1)) AS {M}) ELSE {price} END AS list_price,
      CAST(p_size AS VARCHAR) AS size,
      CASE WHEN p_type <> 'MEDIUM' THEN CAST(p_size * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(8,2)) END AS weight,
      {CATEGORY_ID[3]} AS product_category_id, {MODEL_ID} AS product_model_id,
      TIMESTAMP '2020-01-01 00:00:00' AS sell_start_date,
      CASE WHEN p_type = 'STANDARD' THEN TIMESTAMP '2023-06-30 00:00:00' END AS sell_end_date,
      CASE WHEN p_brand = 'Brand#7' THEN TIMESTAMP '2022-01-01 00:00:00' END AS discontinued_date,
      CAST(NULL AS BLOB) AS thumbnail_photo, CAST(NULL AS VARCHAR) AS thumbnail_photo_file_name,
      md5(CAST(p_partkey AS VARCHAR)) AS rowguid, CASE WHEN {cheaper} THEN {NEW} ELSE {OLD} END AS modified_date
    FROM part WHERE {members}"""


def category(s: int) -> str:
    root = "CASE WHEN p_type = 'PROMO' THEN 'PROMOTION' ELSE p_type END" if s >= 2 else "p_type"
    return f"""
    SELECT product_category_id, parent_product_category_id, name, md5(CAST(product_category_id AS VARCHAR)) AS rowguid,
      CASE WHEN name = 'PROMOTION' THEN {NEW} ELSE {OLD} END AS modified_date
    FROM (SELECT {CATEGORY_ID[1]} AS product_category_id, CAST(NULL AS INTEGER) AS parent_product_category_id,
                 {root} AS name FROM part
          UNION SELECT {CATEGORY_ID[2]}, {CATEGORY_ID[1]}, p_brand FROM part
          UNION SELECT {CATEGORY_ID[3]}, {CATEGORY_ID[2]}, {SIZE_CLASS} FROM part)"""


def model(s: int) -> str:
    return f"SELECT DISTINCT {MODEL_ID} AS product_model_id, 'Model ' || p_brand AS name FROM part"


# -- row history, stated with windows over all snapshots -------------------------------------------


def with_hash(sql: str, hashed: list[str]) -> str:
    return f"SELECT *, {hash_of(hashed)} AS _tf_row_hash FROM ({sql})"


def history(states: list[str], keys: list[str], columns: list[str]) -> str:
    """History table after loading ``states`` (each with ``_tf_row_hash``) at load times 1, 2, ...

    Consecutive states of a key with equal hash form one version.
    """
    names = [*columns, "_tf_row_hash"]
    tagged = " UNION ALL ".join(f"SELECT {n} AS s, {', '.join(names)} FROM ({sql})" for n, sql in enumerate(states, 1))
    k = ", ".join(keys)
    n = len(states)
    time_of = "CASE {x} " + " ".join(f"WHEN {i} THEN {T[i]}" for i in range(1, n + 1)) + " END"
    present = " AND ".join(f"p.{c} = v.{c}" for c in keys)
    listed = ", ".join(f"v.{c}" for c in names)
    start, end = time_of.format(x="v.first_s"), time_of.format(x="v.last_s + 1")
    return f"""
    WITH tagged AS ({tagged}),
    marked AS (SELECT *, CASE WHEN lag(s) OVER w = s - 1 AND lag(_tf_row_hash) OVER w = _tf_row_hash
                              THEN 0 ELSE 1 END AS starts, min(s) OVER (PARTITION BY {k}) AS ever
               FROM tagged WINDOW w AS (PARTITION BY {k} ORDER BY s)),
    grouped AS (SELECT *, sum(starts) OVER (PARTITION BY {k} ORDER BY s) AS version FROM marked),
    spans AS (SELECT *, min(s) OVER (PARTITION BY {k}, version) AS first_s,
                     max(s) OVER (PARTITION BY {k}, version) AS last_s FROM grouped),
    v AS (SELECT * FROM spans WHERE s = first_s)
    SELECT {listed}, {start} AS _tf_valid_from,
      CASE WHEN v.last_s < {n} THEN {end} END AS _tf_valid_to, v.last_s = {n} AS _tf_is_current,
      {start} AS _tf_create_date, CASE WHEN v.last_s < {n} THEN {end} ELSE {start} END AS _tf_update_date,
      CASE WHEN v.last_s < {n} THEN
             CASE WHEN EXISTS (SELECT 1 FROM tagged p WHERE {present} AND p.s = v.last_s + 1)
                  THEN 'UPDATE' ELSE 'DELETE' END
           WHEN v.first_s = v.ever THEN 'INSERT' ELSE 'UPDATE' END AS _tf_change_type
    FROM v"""


# -- star ------------------------------------------------------------------------------------------

CUSTOMER_ATTRIBUTES = """
  customer_id AS cust_customer_id, trim(coalesce(title, '')) AS cust_title,
  trim(coalesce(first_name, 'N/A')) AS cust_first_name, trim(coalesce(middle_name, '')) AS cust_middle_name,
  trim(coalesce(last_name, 'N/A')) AS cust_last_name, trim(coalesce(suffix, '')) AS cust_suffix,
  trim(coalesce(company_name, '')) AS cust_company_name, trim(coalesce(sales_person, '')) AS cust_sales_person,
  lower(trim(coalesce(email_address, 'N/A@N/A.com'))) AS cust_email_address,
  trim(coalesce(phone, '000-000-0000')) AS cust_phone,
  concat_ws(' ', nullif(trim(coalesce(title, '')), ''), trim(coalesce(first_name, '')),
    nullif(trim(coalesce(middle_name, '')), ''), trim(coalesce(last_name, '')),
    nullif(trim(coalesce(suffix, '')), '')) AS cust_full_name,
  CASE WHEN trim(coalesce(company_name, '')) <> '' THEN 'Business' ELSE 'Individual' END AS cust_type"""
GEOGRAPHY_ATTRIBUTES = """
  address_id AS geo_address_id, upper(trim(coalesce(address_line1, 'N/A'))) AS geo_address_line_1,
  upper(trim(coalesce(address_line2, ''))) AS geo_address_line_2, upper(trim(coalesce(city, 'N/A'))) AS geo_city,
  upper(trim(coalesce(state_province, 'N/A'))) AS geo_state_province,
  upper(trim(coalesce(country_region, 'N/A'))) AS geo_country_region,
  replace(coalesce(postal_code, '00000'), ' ', '') AS geo_postal_code"""


def category_tree(nodes: str) -> str:
    """Flattened category columns for a SELECT with product_category_id, parent id and name."""
    return f"""
    SELECT c.product_category_id AS prod_cat_id, trim(coalesce(c.name, 'N/A')) AS prod_cat_name,
      c.parent_product_category_id AS prod_cat_parent_id, trim(coalesce(p.name, '')) AS prod_cat_parent_name,
      p.parent_product_category_id AS prod_cat_grandparent_id, trim(coalesce(g.name, '')) AS prod_cat_grandparent_name,
      CASE WHEN c.parent_product_category_id IS NULL THEN 1 WHEN p.parent_product_category_id IS NULL THEN 2
           ELSE 3 END AS prod_cat_level,
      CASE WHEN c.parent_product_category_id IS NULL THEN c.name
           WHEN p.parent_product_category_id IS NULL THEN p.name || ' > ' || c.name
           ELSE g.name || ' > ' || p.name || ' > ' || c.name END AS prod_cat_hierarchy_path,
      NOT EXISTS (SELECT 1 FROM ({nodes}) x WHERE x.parent_product_category_id = c.product_category_id)
        AS prod_cat_is_leaf
    FROM ({nodes}) c LEFT JOIN ({nodes}) p ON c.parent_product_category_id = p.product_category_id
    LEFT JOIN ({nodes}) g ON p.parent_product_category_id = g.product_category_id"""


PRICE_RANGE = """CASE WHEN {c} < 100 THEN 'Budget (< 100)' WHEN {c} < 500 THEN 'Mid-Range (100-500)'
  WHEN {c} < 1000 THEN 'Premium (500-1000)' WHEN {c} < 3000 THEN 'Luxury (1000-3000)'
  ELSE 'Ultra-Luxury (3000+)' END"""


def product_dimension(products: str, tree: str, models: str, as_of: str = "DATE '2024-01-01'") -> str:
    """Product dimension columns; ``tree`` must carry the category surrogate as ``category_sk``."""
    return f"""
    SELECT p.product_id AS prod_product_id, trim(coalesce(p.name, 'N/A')) AS prod_name,
      trim(coalesce(p.product_number, 'N/A')) AS prod_product_number, trim(coalesce(p.color, 'N/A')) AS prod_color,
      coalesce(p.standard_cost, 0) AS prod_standard_cost, coalesce(p.list_price, 0) AS prod_list_price,
      trim(coalesce(p.size, 'N/A')) AS prod_size, CAST(coalesce(p.weight, 0) AS DECIMAL(8,2)) AS prod_weight,
      CAST(p.sell_start_date AS DATE) AS prod_sell_start_date, CAST(p.sell_end_date AS DATE) AS prod_sell_end_date,
      CAST(p.discontinued_date AS DATE) AS prod_discontinued_date,
      CAST(coalesce(c.category_sk, -9) AS BIGINT) AS _tf_dim_product_category_sk,
      coalesce(p.product_category_id, 0) AS prod_category_id, coalesce(c.prod_cat_name, 'N/A') AS prod_category_name,
      coalesce(c.prod_cat_hierarchy_path, 'N/A') AS prod_category_hierarchy,
      coalesce(p.product_model_id, 0) AS prod_model_id, coalesce(m.name, 'N/A') AS prod_model_name,
      {PRICE_RANGE.format(c='p.list_price')} AS prod_price_range,
      CASE WHEN p.weight IS NULL THEN 'N/A' WHEN p.weight < 5 THEN 'Very Light (< 5 kg)'
        WHEN p.weight < 10 THEN 'Light (5-10 kg)' WHEN p.weight < 20 THEN 'Medium (10-20 kg)'
        ELSE 'Heavy (20+ kg)' END AS prod_weight_range,
      CASE WHEN p.discontinued_date IS NOT NULL THEN FALSE
        WHEN p.sell_end_date IS NOT NULL AND CAST(p.sell_end_date AS DATE) < {as_of} THEN FALSE ELSE TRUE END AS prod_is_active,
      CAST(date_diff('day', CAST(p.sell_start_date AS DATE), coalesce(CAST(p.sell_end_date AS DATE), {as_of})) AS INTEGER)
        AS prod_days_to_sell,
      CASE WHEN p.standard_cost > 0
        THEN CAST(round((CAST(p.list_price AS DOUBLE) - CAST(p.standard_cost AS DOUBLE))
                        / CAST(p.standard_cost AS DOUBLE) * 100, 2) AS DECIMAL(10,2))
        ELSE CAST(0 AS DECIMAL(10,2)) END AS prod_profit_margin
    FROM ({products}) p LEFT JOIN ({tree}) c ON p.product_category_id = c.prod_cat_id
    LEFT JOIN ({models}) m ON p.product_model_id = m.product_model_id"""


STAR = f"""
dim_customer AS (SELECT {CUSTOMER_ATTRIBUTES}, customer_id + 1 AS customer_sk FROM ({customer(3)})),
dim_geography AS (SELECT {GEOGRAPHY_ATTRIBUTES}, address_id + 1 AS geography_sk FROM ({address(3)})),
dim_category AS (SELECT *, CAST(prod_cat_id AS BIGINT) + 1 AS category_sk FROM ({category_tree(category(3))})),
dim_product AS (SELECT *, prod_product_id + 1 AS product_sk
  FROM ({product_dimension(product(3), 'SELECT * FROM dim_category', model(3))})),
dim_calendar AS (SELECT CAST(10000 * year(d) + 100 * month(d) + day(d) AS INTEGER) AS calendar_sk, d AS cal_date,
    CAST(year(d) AS INTEGER) AS cal_year, CAST(month(d) AS INTEGER) AS cal_month,
    strftime(d, '%B') AS cal_month_name, CAST(quarter(d) AS INTEGER) AS cal_quarter
  FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(
    (SELECT date_trunc('year', CAST(min(o_orderdate) AS TIMESTAMP)) FROM orders),
    (SELECT date_trunc('year', CAST(max(o_orderdate) AS TIMESTAMP)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM orders),
    INTERVAL 1 DAY) t(g))),
fact AS (SELECT d.sales_order_id, d.sales_order_detail_id, d.product_id + 1 AS product_sk,
    CAST(10000 * year(h.order_date) + 100 * month(h.order_date) + day(h.order_date) AS INTEGER) AS calendar_sk,
    h.customer_id + 1 AS customer_sk, h.bill_to_address_id + 1 AS geography_sk,
    d.order_qty, d.unit_price, d.unit_price_discount, d.line_total,
    h.order_date AS create_date
  FROM ({detail(3)}) d LEFT JOIN ({header(3)}) h USING (sales_order_id))"""

QTY = "CAST(sum(order_qty) AS BIGINT)"
REVENUE = "CAST(sum(line_total) AS DECIMAL(38,6))"


def mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def differs(columns: list[str]) -> str:
    return "(" + " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns) + ")"


def dimension_history(old: str, new: str, key: str, columns: list[str], tracked: list[str]) -> str:
    """Dimension history after two loads; members missing in the second load stay current."""
    listed_o, listed_n = (", ".join(f"{x}.{c}" for c in columns) for x in "on")
    changed = f"n.{key} IS NOT NULL AND {differs(tracked)}"
    return f"""
    SELECT {listed_o}, {T[1]} AS _tf_valid_from, CASE WHEN {changed} THEN {T[2]} END AS _tf_valid_to,
      NOT ({changed}) AS _tf_is_current, {T[1]} AS _tf_create_date,
      CASE WHEN {changed} THEN {T[2]} ELSE {T[1]} END AS _tf_update_date
    FROM ({old}) o LEFT JOIN ({new}) n ON o.{key} = n.{key}
    UNION ALL
    SELECT {listed_n}, {T[2]}, CAST(NULL AS TIMESTAMP), TRUE, {T[2]}, {T[2]}
    FROM ({new}) n LEFT JOIN ({old}) o ON o.{key} = n.{key} WHERE o.{key} IS NULL OR {differs(tracked)}"""


def dimension_update(old: str, new: str, key: str, columns: list[str]) -> str:
    """Dimension content after two in-place loads."""
    picks = ", ".join(f"CASE WHEN n.{key} IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in columns)
    tracked = [c for c in columns if c != key]
    return f"""
    SELECT {picks}, CASE WHEN o.{key} IS NULL THEN {T[2]} ELSE {T[1]} END AS _tf_create_date,
      CASE WHEN o.{key} IS NULL OR (n.{key} IS NOT NULL AND {differs(tracked)}) THEN {T[2]} ELSE {T[1]} END AS _tf_update_date
    FROM ({old}) o FULL OUTER JOIN ({new}) n ON o.{key} = n.{key}"""
