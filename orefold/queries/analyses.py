"""Sales analyses, statistics and reporting views over the star."""

from __future__ import annotations

from orefold.plans import marts
from orefold.queries.common import fact, star
from orefold.queries.sql_sources import PRICE_RANGE, QTY, REVENUE, STAR, mean

QUERIES = {
    "fact_stats": lambda spark, folder: marts.fact_stats(fact(spark, folder)),
    "fact_final_stats": lambda spark, folder: marts.fact_final_stats(fact(spark, folder)),
    "top10_customers": lambda spark, folder: marts.top_customers(star(spark, folder)),
    "top10_products": lambda spark, folder: marts.top_products(star(spark, folder)),
    "sales_by_category": lambda spark, folder: marts.sales_by_category(star(spark, folder)),
    "sales_by_month": lambda spark, folder: marts.sales_by_month(star(spark, folder)),
    "sales_by_geography": lambda spark, folder: marts.sales_by_geography(star(spark, folder)),
    "discount_bands": lambda spark, folder: marts.discount_analysis(fact(spark, folder)),
    "sales_by_price_range": lambda spark, folder: marts.sales_by_price_range(
        star(spark, folder)),
    "v_sales_monthly": lambda spark, folder: marts.monthly_view(star(spark, folder)),
    "v_sales_by_category": lambda spark, folder: marts.category_view(star(spark, folder)),
    "v_customer_performance": lambda spark, folder: marts.customer_view(star(spark, folder)),
}

_CAL = "cal_year, cal_month, cal_month_name, cal_quarter"
_UNKNOWN = "CAST(sum(CASE WHEN {k} = -9 THEN 1 ELSE 0 END) AS BIGINT)"

ORACLE = {
    "fact_stats": f"""WITH {STAR} SELECT count(*) AS total_records, count(DISTINCT sales_order_id) AS unique_orders,
        min(calendar_sk) AS earliest_date_key, max(calendar_sk) AS latest_date_key, {QTY} AS total_quantity,
        {REVENUE} AS total_revenue, {mean('unit_price')} AS avg_unit_price,
        {_UNKNOWN.format(k='customer_sk')} AS unknown_customers_count,
        {_UNKNOWN.format(k='geography_sk')} AS unknown_geography_count,
        {_UNKNOWN.format(k='product_sk')} AS unknown_product_count FROM fact""",
    "fact_final_stats": f"""WITH {STAR} SELECT 'fact_sales' AS table_name, count(*) AS row_count,
        count(DISTINCT sales_order_id) AS distinct_orders, count(DISTINCT customer_sk) AS distinct_customers,
        count(DISTINCT product_sk) AS distinct_products,
        CAST(round(sum(line_total), 2) AS DECIMAL(38,2)) AS total_sales_amount,
        CAST(round({mean('line_total')}, 2) AS DECIMAL(38,2)) AS avg_line_amount,
        min(create_date) AS first_load_date, max(create_date) AS last_load_date FROM fact""",
    "top10_customers": f"""WITH {STAR} SELECT cust_customer_id, cust_full_name, cust_company_name,
        count(DISTINCT sales_order_id) AS order_count, {QTY} AS total_quantity, {REVENUE} AS total_revenue,
        {mean('line_total')} AS avg_order_value
        FROM fact JOIN dim_customer USING (customer_sk) WHERE customer_sk <> -9
        GROUP BY ALL ORDER BY total_revenue DESC, cust_customer_id LIMIT 10""",
    "top10_products": f"""WITH {STAR} SELECT prod_product_id, prod_name, prod_category_hierarchy, prod_list_price,
        prod_profit_margin, count(DISTINCT sales_order_id) AS order_count, {QTY} AS total_quantity_sold,
        {REVENUE} AS total_revenue, {mean('unit_price')} AS avg_selling_price
        FROM fact JOIN dim_product USING (product_sk) WHERE product_sk <> -9
        GROUP BY ALL ORDER BY total_revenue DESC, prod_product_id LIMIT 10""",
    "sales_by_category": f"""WITH {STAR} SELECT c.prod_cat_level, c.prod_cat_hierarchy_path,
        count(DISTINCT sales_order_id) AS order_count, count(DISTINCT prod_product_id) AS distinct_products_sold,
        {QTY} AS total_quantity, {REVENUE} AS total_revenue, {mean('unit_price')} AS avg_unit_price
        FROM fact JOIN dim_product p USING (product_sk)
        JOIN dim_category c ON p._tf_dim_product_category_sk = c.category_sk WHERE product_sk <> -9
        GROUP BY ALL ORDER BY total_revenue DESC, c.prod_cat_level, c.prod_cat_hierarchy_path LIMIT 20""",
    "sales_by_month": f"""WITH {STAR} SELECT {_CAL}, count(DISTINCT sales_order_id) AS order_count,
        count(*) AS line_count, {QTY} AS total_quantity, {REVENUE} AS total_revenue,
        {mean('line_total')} AS avg_line_value
        FROM fact JOIN dim_calendar USING (calendar_sk) GROUP BY {_CAL} ORDER BY cal_year, cal_month""",
    "sales_by_geography": f"""WITH {STAR} SELECT geo_country_region, geo_state_province,
        count(DISTINCT sales_order_id) AS order_count, count(DISTINCT customer_sk) AS distinct_customers,
        {QTY} AS total_quantity, {REVENUE} AS total_revenue, {mean('line_total')} AS avg_order_line_value
        FROM fact JOIN dim_geography USING (geography_sk) WHERE geography_sk <> -9
        GROUP BY ALL ORDER BY total_revenue DESC, geo_country_region, geo_state_province LIMIT 20""",
    "discount_bands": f"""WITH {STAR} SELECT CASE WHEN unit_price_discount = 0 THEN 'No Discount'
          WHEN unit_price_discount <= 0.05 THEN '1-5% Discount' WHEN unit_price_discount <= 0.10 THEN '6-10% Discount'
          WHEN unit_price_discount <= 0.20 THEN '11-20% Discount' ELSE '20%+ Discount' END AS discount_range,
        count(*) AS transaction_count, {QTY} AS total_quantity, {REVENUE} AS total_revenue,
        {mean('unit_price')} AS avg_unit_price, {mean('unit_price_discount')} AS avg_discount_rate
        FROM fact GROUP BY ALL""",
    "sales_by_price_range": f"""WITH {STAR} SELECT {PRICE_RANGE.format(c='p.prod_list_price')} AS prod_price_range,
        count(DISTINCT sales_order_id) AS order_count, count(DISTINCT prod_product_id) AS distinct_products,
        {QTY} AS total_quantity_sold, {REVENUE} AS total_revenue, {mean('line_total')} AS avg_line_value
        FROM fact JOIN dim_product p USING (product_sk) WHERE product_sk <> -9 GROUP BY ALL""",
    "v_sales_monthly": f"""WITH {STAR} SELECT {_CAL}, count(DISTINCT sales_order_id) AS order_count,
        {QTY} AS total_quantity, {REVENUE} AS total_revenue, count(DISTINCT customer_sk) AS distinct_customers,
        count(DISTINCT product_sk) AS distinct_products
        FROM fact JOIN dim_calendar USING (calendar_sk) GROUP BY {_CAL}""",
    "v_sales_by_category": f"""WITH {STAR} SELECT c.prod_cat_level, c.prod_cat_hierarchy_path, c.prod_cat_name,
        count(DISTINCT sales_order_id) AS order_count, {QTY} AS total_quantity, {REVENUE} AS total_revenue,
        count(DISTINCT customer_sk) AS distinct_customers
        FROM fact JOIN dim_product p USING (product_sk)
        JOIN dim_category c ON p._tf_dim_product_category_sk = c.category_sk WHERE product_sk <> -9 GROUP BY ALL""",
    "v_customer_performance": f"""WITH {STAR} SELECT cust_customer_id, cust_full_name, cust_company_name,
        cust_email_address, count(DISTINCT sales_order_id) AS total_orders, {QTY} AS total_items_purchased,
        {REVENUE} AS total_revenue, {mean('line_total')} AS avg_order_line_value,
        min(cal_date) AS first_purchase_date, max(cal_date) AS last_purchase_date,
        CAST(date_diff('day', min(cal_date), max(cal_date)) AS INTEGER) AS customer_lifetime_days
        FROM fact JOIN dim_customer USING (customer_sk) JOIN dim_calendar USING (calendar_sk)
        WHERE customer_sk <> -9 GROUP BY cust_customer_id, cust_full_name, cust_company_name, cust_email_address""",
}
