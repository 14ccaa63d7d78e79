"""Sales analyses and reporting views over the star schema.

Averages are the sum as double divided by the count; ``avg_order_value`` is a mean over lines.
Every ranked result has the group's key as its last sort column, so ties have one order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import DISCOUNT_BANDS, PRICE_BANDS, discount_band, rank_of
from orefold.operators.star import UNKNOWN_KEY
from orefold.sinks.files import stored

CUSTOMER_SK, GEOGRAPHY_SK = "_tf_dim_customer_sk", "_tf_dim_geography_sk"
PRODUCT_SK, CALENDAR_SK, CATEGORY_SK = "_tf_dim_product_sk", "_tf_dim_calendar_sk", "_tf_dim_product_category_sk"
CALENDAR_GROUP = ["cal_year", "cal_month", "cal_month_name", "cal_quarter"]


@dataclass(frozen=True)
class Star:
    """Fact and dimensions of the sales star; dimensions may hold ended versions too."""

    fact: DataFrame
    customer: DataFrame
    geography: DataFrame
    product: DataFrame
    category: DataFrame
    calendar: DataFrame

    def known(self, key: str) -> DataFrame:
        return self.fact.filter(F.col(key) != UNKNOWN_KEY)


def current(dimension: DataFrame) -> DataFrame:
    return dimension.filter("_tf_is_current")


def _orders(name: str = "order_count") -> Column:
    return F.count_distinct("sales_order_id").alias(name)


def _quantity(name: str = "total_quantity") -> Column:
    return F.sum("sales_order_qty").cast("bigint").alias(name)


def _revenue() -> Column:
    return F.sum("sales_line_total").cast("decimal(38,6)").alias("total_revenue")


def mean(column: str, name: str) -> Column:
    return (F.sum(column).cast("double") / F.count(column)).alias(name)


def _unknown(key: str, name: str) -> Column:
    return F.count_if(F.col(key) == UNKNOWN_KEY).alias(name)


def _with_counts(rows: DataFrame, measured: DataFrame, distinct: Mapping[str, str]) -> DataFrame:
    """``measured`` (one row) and the number of distinct values of columns, each from a branch of its own.

    A branch reads one column and sends each value once per task; counting next to the measures would
    copy every row, measures included, once per distinct count. NULL is no value.
    """
    out = measured.withColumn("_one", F.lit(1))
    for name, column in distinct.items():
        values = rows.select(column).filter(F.col(column).isNotNull()).distinct()
        out = out.join(values.agg(F.count(F.lit(1)).alias(name)).withColumn("_one", F.lit(1)), "_one")
    return out.drop("_one")


def staging_stats(staged: DataFrame) -> DataFrame:
    measured = staged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _unknown(CUSTOMER_SK, "unknown_customers"),
        _unknown(GEOGRAPHY_SK, "unknown_geographies"),
        _unknown(PRODUCT_SK, "unknown_products"),
        F.sum("sales_line_total").cast("decimal(38,6)").alias("total_sales"),
    )
    distinct = {"distinct_orders": "sales_order_id", "distinct_details": "sales_order_detail_id"}
    return _with_counts(staged, measured, distinct).select(
        "total_rows", *distinct, "unknown_customers", "unknown_geographies", "unknown_products", "total_sales")


def fact_stats(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_records"),
        _orders("unique_orders"),
        F.min(CALENDAR_SK).alias("earliest_date_key"),
        F.max(CALENDAR_SK).alias("latest_date_key"),
        _quantity(),
        _revenue(),
        mean("sales_unit_price", "avg_unit_price"),
        _unknown(CUSTOMER_SK, "unknown_customers_count"),
        _unknown(GEOGRAPHY_SK, "unknown_geography_count"),
        _unknown(PRODUCT_SK, "unknown_product_count"),
    )


def fact_final_stats(fact: DataFrame) -> DataFrame:
    measured = fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum("sales_line_total"), 2).cast("decimal(38,2)").alias("total_sales_amount"),
        F.round(F.avg("sales_line_total"), 2).cast("decimal(38,2)").alias("avg_line_amount"),
        F.min("_tf_create_date").alias("first_load_date"),
        F.max("_tf_create_date").alias("last_load_date"),
    )
    distinct = {"distinct_orders": "sales_order_id", "distinct_customers": CUSTOMER_SK, "distinct_products": PRODUCT_SK}
    return _with_counts(fact, measured, distinct).select(
        F.lit("fact_sales").alias("table_name"), "row_count", *distinct, "total_sales_amount", "avg_line_amount",
        "first_load_date", "last_load_date")


def _by_member(rows: DataFrame, key: str, dimension: DataFrame, attributes: Sequence[str],
               *measures: Column) -> DataFrame:
    """Measures per current dimension member.

    Attributes depend on the surrogate key alone, so the fact is grouped by that key and only the
    grouped rows meet the dimension: no fact row is joined, no attribute text is shuffled with it.
    """
    grouped = rows.groupBy(key).agg(*measures)
    return grouped.join(current(dimension).select(key, *attributes), key).drop(key)


def _top_members(rows: DataFrame, key: str, dimension: DataFrame, business_key: str, attributes: Sequence[str], n: int,
                 quantity: str, average: tuple[str, str]) -> DataFrame:
    """The ``n`` current members with the highest revenue, with order counts and attributes.

    Measures are summed per surrogate key; only the members' two keys are joined before the ranking. The ``n``
    winners come to the driver, and their keys become a filter of the fact scan that counts orders and of the
    dimension scan that fetches the attributes: no other line is moved, and none with its measures.
    """
    mean_of, mean_name = average
    totals = rows.groupBy(key).agg(_quantity(quantity), _revenue(), mean(mean_of, mean_name))
    ranked = totals.join(current(dimension).select(key, business_key), key)
    best = ranked.orderBy(F.desc("total_revenue"), business_key).limit(n)
    winners = best.sparkSession.createDataFrame(best.collect(), best.schema)  # at most n rows
    listed = [r[0] for r in winners.select(key).distinct().collect()]
    orders = rows.filter(F.col(key).isin(listed)).select(key, "sales_order_id").distinct().groupBy(key).agg(
        F.count("sales_order_id").alias("order_count"))
    texts = current(dimension).filter(F.col(key).isin(listed)).select(key, *attributes)
    return (winners.join(orders, key).join(texts, key)
            .select(business_key, *attributes, "order_count", quantity, "total_revenue", mean_name)
            .orderBy(F.desc("total_revenue"), business_key))


def top_customers(star: Star, n: int = 10) -> DataFrame:
    return _top_members(star.known(CUSTOMER_SK), CUSTOMER_SK, star.customer, "cust_customer_id",
                        ["cust_full_name", "cust_company_name"], n, "total_quantity", ("sales_line_total", "avg_order_value"))


def top_products(star: Star, n: int = 10) -> DataFrame:
    return _top_members(star.known(PRODUCT_SK), PRODUCT_SK, star.product, "prod_product_id",
                        ["prod_name", "prod_category_hierarchy", "prod_list_price", "prod_profit_margin"], n,
                        "total_quantity_sold", ("sales_unit_price", "avg_selling_price"))


def _member_groups(dimension: DataFrame, key: str, group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Two narrow stored tables: member -> group, and the groups with their columns.

    A group is named by the smallest key of its members, so the fact's rows carry one number and no text. The
    dimension is read once, whatever number of branches use the map.
    """
    members = stored(dimension.select(key, *group), "members")
    groups = stored(members.groupBy(*group).agg(F.min(key).alias("_group")), "groups")
    named = groups.select("_group", *[F.col(c).alias(f"_g_{c}") for c in group])
    same = reduce(and_, [members[c].eqNullSafe(named[f"_g_{c}"]) for c in group])
    return stored(members.join(named, same).select(key, "_group"), "member-groups"), groups


def _by_attribute(
    rows: DataFrame,
    key: str,
    dimension: DataFrame,
    group: Sequence[str],
    sums: Mapping[str, tuple[str, str]],
    distinct: Mapping[str, str],
    means: Mapping[str, str] = {},
    lines: str | None = None,
    members: str | None = None,
) -> DataFrame:
    """Measures and distinct counts per attribute group of a dimension.

    Each branch reads only its own columns of the fact. Measures are summed per surrogate key before they meet the
    dimension, so they shrink to one row per member at once. A distinct count is taken in two phases: the pairs
    (group, value) are made distinct, within each task before they are shuffled, then counted. Counting next to the
    measures, or several distinct counts at a time, would copy every fact row once per count.
    ``members`` names the count of dimension members with sales.
    """
    to_group, groups = _member_groups(dimension, key, group)
    used = list(dict.fromkeys([c for c, _ in sums.values()] + list(means.values())))
    partial = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_lines"),
        *[F.sum(c).alias(f"_sum_{c}") for c in used],
        *[F.count(c).alias(f"_n_{c}") for c in means.values()],
    )
    totals = [F.sum(f"_sum_{c}").cast(kind).alias(name) for name, (c, kind) in sums.items()]
    totals += [(F.sum(f"_sum_{c}").cast("double") / F.sum(f"_n_{c}")).alias(name) for name, c in means.items()]
    if lines:
        totals.append(F.sum("_lines").alias(lines))
    if members:
        totals.append(F.count(F.lit(1)).alias(members))
    out = partial.join(to_group, key).groupBy("_group").agg(*totals)
    for name, column in distinct.items():
        pairs = rows.select(F.col(key), F.col(column).alias("_value")).filter(F.col("_value").isNotNull())
        pairs = pairs.join(to_group, key).select("_group", "_value").distinct()
        out = out.join(pairs.groupBy("_group").agg(F.count(F.lit(1)).alias(name)), "_group", "left")
    return out.join(groups, "_group").drop("_group").fillna(0, list(distinct))


QUANTITY = ("sales_order_qty", "bigint")
REVENUE = ("sales_line_total", "decimal(38,6)")


def _category_members(star: Star, group: Sequence[str]) -> DataFrame:
    """Current products with columns of their current category."""
    categories = current(star.category).select(CATEGORY_SK, *group)
    return current(star.product).select(PRODUCT_SK, CATEGORY_SK).join(categories, CATEGORY_SK)


def sales_by_category(star: Star, n: int = 20) -> DataFrame:
    group = ["prod_cat_level", "prod_cat_hierarchy_path"]
    return _by_attribute(
        star.known(PRODUCT_SK), PRODUCT_SK, _category_members(star, group), group,
        {"total_quantity": QUANTITY, "total_revenue": REVENUE}, {"order_count": "sales_order_id"},
        {"avg_unit_price": "sales_unit_price"}, members="distinct_products_sold",
    ).orderBy(F.desc("total_revenue"), *group).limit(n)


def sales_by_month(star: Star) -> DataFrame:
    return _by_attribute(
        star.fact, CALENDAR_SK, star.calendar, CALENDAR_GROUP,
        {"total_quantity": QUANTITY, "total_revenue": REVENUE}, {"order_count": "sales_order_id"},
        {"avg_line_value": "sales_line_total"}, lines="line_count",
    ).orderBy("cal_year", "cal_month")


def sales_by_geography(star: Star, n: int = 20) -> DataFrame:
    group = ["geo_country_region", "geo_state_province"]
    return _by_attribute(
        star.known(GEOGRAPHY_SK), GEOGRAPHY_SK, current(star.geography), group,
        {"total_quantity": QUANTITY, "total_revenue": REVENUE},
        {"order_count": "sales_order_id", "distinct_customers": CUSTOMER_SK},
        {"avg_order_line_value": "sales_line_total"},
    ).orderBy(F.desc("total_revenue"), *group).limit(n)


def discount_analysis(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(discount_band("sales_unit_price_discount").alias("discount_range"))
        .agg(F.count(F.lit(1)).alias("transaction_count"), _quantity(), _revenue(),
             mean("sales_unit_price", "avg_unit_price"), mean("sales_unit_price_discount", "avg_discount_rate"))
        .orderBy(rank_of("discount_range", DISCOUNT_BANDS))
    )


def sales_by_price_range(star: Star) -> DataFrame:
    return _by_attribute(
        star.known(PRODUCT_SK), PRODUCT_SK, current(star.product), ["prod_price_range"],
        {"total_quantity_sold": QUANTITY, "total_revenue": REVENUE}, {"order_count": "sales_order_id"},
        {"avg_line_value": "sales_line_total"}, members="distinct_products",
    ).orderBy(rank_of("prod_price_range", PRICE_BANDS))


def monthly_view(star: Star) -> DataFrame:
    return _by_attribute(
        star.fact, CALENDAR_SK, star.calendar, CALENDAR_GROUP,
        {"total_quantity": QUANTITY, "total_revenue": REVENUE},
        {"order_count": "sales_order_id", "distinct_customers": CUSTOMER_SK, "distinct_products": PRODUCT_SK},
    )


def category_view(star: Star) -> DataFrame:
    group = ["prod_cat_level", "prod_cat_hierarchy_path", "prod_cat_name"]
    return _by_attribute(
        star.known(PRODUCT_SK), PRODUCT_SK, _category_members(star, group), group,
        {"total_quantity": QUANTITY, "total_revenue": REVENUE},
        {"order_count": "sales_order_id", "distinct_customers": CUSTOMER_SK},
    )


def customer_view(star: Star) -> DataFrame:
    group = ["cust_customer_id", "cust_full_name", "cust_company_name", "cust_email_address"]
    dated = star.known(CUSTOMER_SK).join(star.calendar.select(CALENDAR_SK, "cal_date"), CALENDAR_SK)
    return _by_member(
        dated, CUSTOMER_SK, star.customer, group,
        _orders("total_orders"),
        _quantity("total_items_purchased"),
        _revenue(),
        mean("sales_line_total", "avg_order_line_value"),
        F.min("cal_date").alias("first_purchase_date"),
        F.max("cal_date").alias("last_purchase_date"),
        F.datediff(F.max("cal_date"), F.min("cal_date")).alias("customer_lifetime_days"),
    )


VIEWS = {
    "v_sales_monthly": monthly_view,
    "v_sales_by_category": category_view,
    "v_customer_performance": customer_view,
}


def register_views(star: Star) -> None:
    """The three reporting views under their names in the session catalog."""
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
