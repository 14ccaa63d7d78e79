"""Scalar functions, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orefold.functions import blank_to_null, date_key, fill_text, row_hash, safe_measure
from orefold.queries.common import bronze, renamed, utc
from orefold.queries.sql_sources import DETAIL_HASHED, HEADER_COLUMNS, M, customer, detail, hash_of, header
from orefold.sources.entities import SALES_ORDER_DETAIL
from orefold.sources.readers import read_parquet


def scalar_casts(spark, folder):
    """Plain casts, and casts that give NULL or 0 where a value does not fit."""
    orders = read_parquet(utc(spark), folder, "orders")
    return orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_orderdate").cast("date").alias("as_date"),
        F.col("o_totalprice").cast("decimal(19,4)").alias("as_money"),
        F.col("o_totalprice").cast("decimal(19,4)").try_cast("decimal(9,4)").alias("fits_or_null"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        safe_measure("o_orderkey", "smallint").alias("small_or_zero"),
    )


def scalar_nulls(spark, folder):
    c = renamed(spark, folder, "customer")
    phone, title = F.col("phone"), F.col("title")
    return c.select(
        "customer_id",
        F.coalesce("phone", "email_address", F.lit("none")).alias("contact"),
        F.nullif("company_name", F.lit("BUILDING")).alias("other_company"),
        title.isNull().alias("no_title"),
        phone.isNotNull().alias("has_phone"),
        (~(title == "Ms.")).alias("not_ms"),
        ((title == "Ms.") | phone.isNull()).alias("either"),
        ((title != "Ms.") & phone.isNotNull()).alias("both"),
    )


def scalar_strings(spark, folder):
    c = renamed(spark, folder, "customer")
    return c.select(
        "customer_id",
        F.trim("first_name").alias("trimmed"),
        F.upper(F.trim("first_name")).alias("upper_name"),
        fill_text("email_address", "N/A@N/A.com", trim=True, case="lower").alias("mail"),
        F.replace(F.col("first_name"), F.lit(" "), F.lit("")).alias("no_blanks"),
        F.concat("title", F.lit(" "), "last_name").alias("joined_or_null"),
        F.concat_ws(" ", blank_to_null("title"), blank_to_null("middle_name"), "last_name").alias("joined"),
    )


def scalar_dates(spark, folder):
    orders = read_parquet(utc(spark), folder, "orders")
    day = F.to_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        date_key("o_orderdate").alias("date_key"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("month_start"),
        F.date_add(day, 6).alias("plus_week"),
        F.date_add(day, -6).alias("minus_week"),
        F.add_months(day, -1).alias("month_before"),
        F.last_day(day).alias("month_end"),
        F.datediff(F.lit("2024-01-01").cast("date"), day).alias("age_days"),
    )


def scalar_math(spark, folder):
    lines = renamed(spark, folder, "sales_order_detail")
    qty = F.col("order_qty").cast("decimal(5,0)")
    return lines.select(
        "sales_order_id", "sales_order_detail_id",
        (qty * F.col("unit_price")).cast("decimal(25,4)").alias("gross"),
        (F.col("unit_price") + F.col("unit_price_discount")).cast("decimal(20,4)").alias("total"),
        (F.col("unit_price") - F.col("unit_price_discount")).cast("decimal(20,4)").alias("rest"),
        F.floor(F.col("unit_price").cast("double") / 7).cast("bigint").alias("sevenths"),
        F.round("line_total", 2).cast("decimal(38,2)").alias("rounded"),
    )


def scalar_case(spark, folder):
    orders = read_parquet(utc(spark), folder, "orders")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return orders.select(
        "o_orderkey",
        F.when(price < 50000, "small").when(price < 200000, "medium").otherwise("large").alias("size_band"),
        F.when(status == "F", 1).when(status == "P", 2).otherwise(3).alias("status_rank"),
        F.when(status == "O", "open").alias("open_or_null"),
    )


def predicate_in_list(spark, folder):
    orders = read_parquet(utc(spark), folder, "orders")
    return orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "O"))


def hashes(spark, folder):
    lines = SALES_ORDER_DETAIL.renamed(bronze(spark, folder, "sales_order_detail"))
    return lines.select("sales_order_id", "sales_order_detail_id", row_hash(DETAIL_HASHED).alias("_tf_row_hash"))


def renamed_headers(spark, folder):
    return renamed(spark, folder, "sales_order_header")


QUERIES = {
    "scalar_casts": scalar_casts,
    "scalar_nulls": scalar_nulls,
    "scalar_strings": scalar_strings,
    "scalar_dates": scalar_dates,
    "scalar_math": scalar_math,
    "scalar_case": scalar_case,
    "pred_in_list": predicate_in_list,
    "row_hash": hashes,
    "silver_rename": renamed_headers,
}

ORACLE = {
    "scalar_casts": f"""SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, CAST(o_orderdate AS DATE) AS as_date,
        CAST(o_totalprice AS {M}) AS as_money, TRY_CAST(CAST(o_totalprice AS {M}) AS DECIMAL(9,4)) AS fits_or_null,
        TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number,
        CAST(coalesce(TRY_CAST(o_orderkey AS SMALLINT), 0) AS SMALLINT) AS small_or_zero FROM orders""",
    "scalar_nulls": f"""SELECT customer_id, coalesce(phone, email_address, 'none') AS contact,
        nullif(company_name, 'BUILDING') AS other_company, title IS NULL AS no_title, phone IS NOT NULL AS has_phone,
        NOT (title = 'Ms.') AS not_ms, (title = 'Ms.' OR phone IS NULL) AS either,
        (title <> 'Ms.' AND phone IS NOT NULL) AS "both" FROM ({customer(3)})""",
    "scalar_strings": f"""SELECT customer_id, trim(first_name) AS trimmed, upper(trim(first_name)) AS upper_name,
        lower(trim(coalesce(email_address, 'N/A@N/A.com'))) AS mail, replace(first_name, ' ', '') AS no_blanks,
        title || ' ' || last_name AS joined_or_null,
        concat_ws(' ', nullif(trim(coalesce(title, '')), ''), nullif(trim(coalesce(middle_name, '')), ''), last_name)
          AS joined FROM ({customer(3)})""",
    "scalar_dates": """SELECT o_orderkey, CAST(10000 * year(d) + 100 * month(d) + day(d) AS INTEGER) AS date_key,
        CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS d,
        make_date(year(d), month(d), 1) AS month_start, d + 6 AS plus_week, d - 6 AS minus_week,
        CAST(d - INTERVAL 1 MONTH AS DATE) AS month_before, last_day(d) AS month_end,
        CAST(DATE '2024-01-01' - d AS INTEGER) AS age_days
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "scalar_math": f"""SELECT sales_order_id, sales_order_detail_id,
        CAST(order_qty * unit_price AS DECIMAL(25,4)) AS gross,
        CAST(unit_price + unit_price_discount AS DECIMAL(20,4)) AS total,
        CAST(unit_price - unit_price_discount AS DECIMAL(20,4)) AS rest,
        CAST(floor(CAST(unit_price AS DOUBLE) / 7) AS BIGINT) AS sevenths,
        CAST(round(line_total, 2) AS DECIMAL(38,2)) AS rounded FROM ({detail(3)})""",
    "scalar_case": """SELECT o_orderkey,
        CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'medium' ELSE 'large' END AS size_band,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS status_rank,
        CASE WHEN o_orderstatus = 'O' THEN 'open' END AS open_or_null FROM orders""",
    "pred_in_list": "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O'",
    "row_hash": f"""SELECT sales_order_id, sales_order_detail_id, {hash_of(DETAIL_HASHED)} AS _tf_row_hash
        FROM ({detail(3)})""",
    "silver_rename": f"SELECT {', '.join(HEADER_COLUMNS)} FROM ({header(3)})",
}
