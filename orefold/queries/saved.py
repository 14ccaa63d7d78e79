"""The ten saved queries over source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.queries.common import bronze, utc
from orefold.queries.sql_sources import M, product
from orefold.sources.readers import read_parquet
from orefold.sources.sample import category_id

MONEY = "decimal(19,4)"
TOTAL = "decimal(38,4)"


def _table(spark, folder, name) -> DataFrame:
    return read_parquet(utc(spark), folder, name)


def _categories(spark, folder) -> DataFrame:
    """Top-level categories: one row per part type."""
    return _table(spark, folder, "part").select(category_id(1).alias("category_id"), "p_type").distinct()


def _parts(spark, folder) -> DataFrame:
    return _table(spark, folder, "part").withColumn("category_id", category_id(1)).drop("p_type")


def _customers(spark, folder) -> DataFrame:
    return _table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")


def product_with_category(spark, folder):
    joined = _parts(spark, folder).join(_categories(spark, folder), "category_id")
    return joined.select(F.col("p_name").alias("nom"), F.col("p_retailprice").alias("prix"),
                         F.col("p_type").alias("categorie"))


def orders_per_customer(spark, folder):
    """Customers without orders count zero. Orders are counted per customer key before the join."""
    counted = _table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    joined = _customers(spark, folder).join(counted, F.col("c_custkey") == F.col("o_custkey"), "left")
    return (joined.groupBy(F.col("c_name").alias("nom"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("nb_orders"))
            .orderBy(F.desc("nb_orders"), "nom"))


def top5_price(spark, folder):
    return (bronze(spark, folder, "product").select("ProductID", "Name", "ListPrice")
            .orderBy(F.desc("ListPrice"), "ProductID").limit(5))


def active_products(spark, folder):
    rows = bronze(spark, folder, "product").filter(F.col("SellEndDate").isNull())
    return rows.orderBy(F.desc("ListPrice"), "ProductID")


def total_revenue(spark, folder):
    return _table(spark, folder, "orders").agg(F.sum(F.col("o_totalprice").cast(MONEY)).cast(TOTAL).alias("total_revenue"))


def orders_by_region(spark, folder):
    """Orders are counted per customer key first, so a hot customer or region is one row per task."""
    counted = _table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    joined = (counted.join(_customers(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
              .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.groupBy(F.col("n_name").alias("region")).agg(F.sum("n").alias("nombre_commandes")).orderBy("region")


def products_by_category(spark, folder):
    joined = _parts(spark, folder).join(_categories(spark, folder), "category_id")
    return joined.groupBy(F.col("p_type").alias("categorie")).agg(F.count("p_partkey").alias("nb_products"))


def top3_customers(spark, folder):
    """Totals per customer key are built before names are joined, so names never travel with orders."""
    totals = (_table(spark, folder, "orders").groupBy("o_custkey")
              .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("t")))
    joined = totals.join(_customers(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    return (joined.groupBy(F.col("c_custkey").alias("client"), F.col("c_name").alias("nom"))
            .agg(F.sum("t").cast(TOTAL).alias("total")).orderBy(F.desc("total"), "client").limit(3))


def revenue_by_category(spark, folder):
    """Lines with an order, by category. Line amounts are summed per part before parts are joined."""
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = _table(spark, folder, "orders").select("o_orderkey")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast(MONEY)
    amount = price * F.col("l_quantity").cast("smallint").cast("decimal(5,0)")
    per_part = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy("l_partkey").agg(F.sum(amount).alias("amount")))
    joined = (per_part.join(_parts(spark, folder), F.col("l_partkey") == F.col("p_partkey"))
              .join(_categories(spark, folder), "category_id"))
    return (joined.groupBy(F.col("p_type").alias("categorie"))
            .agg(F.sum("amount").cast(TOTAL).alias("total_revenue")).orderBy(F.desc("total_revenue"), "categorie"))


def top_discount(spark, folder):
    return (_table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("id_produit"))
            .agg(F.sum(F.col("l_discount").cast(MONEY)).cast(TOTAL).alias("total_discount"))
            .orderBy(F.desc("total_discount"), "id_produit").limit(1))


QUERIES = {
    "q01_product_category": product_with_category,
    "q02_orders_per_customer": orders_per_customer,
    "q03_top5_price": top5_price,
    "q04_active_products": active_products,
    "q05_total_revenue": total_revenue,
    "q06_orders_by_region": orders_by_region,
    "q07_products_by_category": products_by_category,
    "q08_top3_customers": top3_customers,
    "q09_revenue_by_category": revenue_by_category,
    "q10_top_discount": top_discount,
}

_CAT = "(SELECT p_type, row_number() OVER (ORDER BY p_type) AS cat_id FROM (SELECT DISTINCT p_type FROM part))"
_PART_CAT = f"(SELECT part.*, c.cat_id FROM part JOIN {_CAT} c ON c.p_type = part.p_type)"
_PRICE = f"CAST(floor(l_extendedprice / l_quantity) AS {M})"

ORACLE = {
    "q01_product_category": f"""
        SELECT p.p_name AS nom, p.p_retailprice AS prix, c.p_type AS categorie
        FROM {_PART_CAT} p JOIN {_CAT} c ON p.cat_id = c.cat_id""",
    "q02_orders_per_customer": """
        SELECT c_name AS nom, count(o_orderkey) AS nb_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey
        GROUP BY c_name ORDER BY nb_orders DESC, nom""",
    "q03_top5_price": f"""
        SELECT product_id AS "ProductID", name AS "Name", list_price AS "ListPrice" FROM ({product(3)})
        ORDER BY list_price DESC, product_id LIMIT 5""",
    "q04_active_products": f"""
        SELECT product_id AS "ProductID", name AS "Name", product_number AS "ProductNumber", color AS "Color",
          standard_cost AS "StandardCost", list_price AS "ListPrice", size AS "Size", weight AS "Weight",
          CAST(NULL AS BLOB) AS "ThumbNailPhoto", CAST(NULL AS VARCHAR) AS "ThumbnailPhotoFileName",
          product_category_id AS "ProductCategoryID", product_model_id AS "ProductModelID",
          sell_start_date AS "SellStartDate", sell_end_date AS "SellEndDate",
          discontinued_date AS "DiscontinuedDate", rowguid, modified_date AS "ModifiedDate"
        FROM ({product(3)}) WHERE sell_end_date IS NULL ORDER BY list_price DESC, product_id""",
    "q05_total_revenue": f"SELECT CAST(sum(CAST(o_totalprice AS {M})) AS DECIMAL(38,4)) AS total_revenue FROM orders",
    "q06_orders_by_region": """
        SELECT n_name AS region, count(o_orderkey) AS nombre_commandes
        FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name ORDER BY n_name""",
    "q07_products_by_category": f"""
        SELECT c.p_type AS categorie, count(p.p_partkey) AS nb_products
        FROM {_PART_CAT} p JOIN {_CAT} c ON p.cat_id = c.cat_id GROUP BY c.p_type""",
    "q08_top3_customers": f"""
        SELECT c_custkey AS client, c_name AS nom, CAST(sum(CAST(o_totalprice AS {M})) AS DECIMAL(38,4)) AS total
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
        ORDER BY total DESC, client LIMIT 3""",
    "q09_revenue_by_category": f"""
        SELECT c.p_type AS categorie,
          CAST(sum({_PRICE} * CAST(l_quantity AS SMALLINT)) AS DECIMAL(38,4)) AS total_revenue
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN {_PART_CAT} p ON l_partkey = p.p_partkey
        JOIN {_CAT} c ON p.cat_id = c.cat_id GROUP BY c.p_type ORDER BY total_revenue DESC, categorie""",
    "q10_top_discount": f"""
        SELECT l_partkey AS id_produit, CAST(sum(CAST(l_discount AS {M})) AS DECIMAL(38,4)) AS total_discount
        FROM lineitem GROUP BY l_partkey ORDER BY total_discount DESC, id_produit LIMIT 1""",
}
