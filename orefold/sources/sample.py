"""The order-management entities derived from a folder of sample sales tables.

``snapshot`` 1, 2 and 3 are three states of the source, for loading one after the other. Changes
follow attributes of the rows, so every snapshot grows with the tables:

========  ==========================  ============================  ==============================
entity    arrives with snapshot 2     gone in 2, back in 3          changed from 2 on
========  ==========================  ============================  ==============================
customer  segment MACHINERY           others with negative balance  BUILDING renamed; phones set or
                                                                    cleared (HOUSEHOLD, FURNITURE)
order     priority 2-HIGH             finished ones, priority 5-LOW status P becomes finished
line      flag N, status F            flag R, status F              flag A, status O: discount
product   type SMALL                  type ECONOMY above size 40    type PROMO: price halved
========  ==========================  ============================  ==============================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.functions.columns import digit_id
from orefold.sources.readers import read_parquet

STATE_TIMES = {1: "2023-01-01 00:00:00", 2: "2024-01-02 00:00:00"}
CULTURES = ("en", "fr")
STATUS_CODES = {"O": 1, "P": 2, "F": 5}
MONEY = "decimal(19,4)"


def _stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _modified(is_changed: Column) -> Column:
    return F.when(is_changed, _stamp(STATE_TIMES[2])).otherwise(_stamp(STATE_TIMES[1]))


def _text(*parts: str | Column) -> Column:
    """Concatenation; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


class SampleSource:
    """Callable access to every entity of one snapshot: ``SampleSource(spark, folder, 2).customer()``."""

    def __init__(self, spark: SparkSession, folder: str, snapshot: int = 3):
        self.spark, self.folder, self.snapshot = spark, folder, snapshot
        self.later = snapshot >= 2

    def table(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.folder, name)

    def _members(self, df: DataFrame, arrives: Column, leaves: Column) -> DataFrame:
        if self.snapshot == 1:
            return df.filter(~arrives)
        if self.snapshot == 2:
            return df.filter(arrives | ~leaves)
        return df

    def _changed(self, condition: Column) -> Column:
        return condition if self.later else F.lit(False)

    def _customers(self) -> DataFrame:
        return self._members(
            self.table("customer"), F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") < 0
        )

    def customer(self) -> DataFrame:
        segment, owing = F.col("c_mktsegment"), F.col("c_acctbal") < 0
        renamed = self._changed(segment == "BUILDING")
        household, furniture = segment == "HOUSEHOLD", segment == "FURNITURE"
        without_phone = furniture if self.later else household
        return self._customers().select(
            F.col("c_custkey").cast("bigint").alias("CustomerID"),
            F.lit(False).alias("NameStyle"),
            F.when(household, "Ms.").alias("Title"),
            F.lit(" Customer ").alias("FirstName"),
            F.when(~owing, "M").alias("MiddleName"),
            F.substring_index("c_name", "#", -1).alias("LastName"),
            F.lit(None).cast("string").alias("Suffix"),
            F.when(renamed, "CONSTRUCTION").when(~household, segment).alias("CompanyName"),
            _text("agent", F.col("c_nationkey")).alias("SalesPerson"),
            F.when(~owing, _text("C", F.col("c_custkey"), "@Example.COM")).alias("EmailAddress"),
            F.when(~without_phone, _text("555-", F.col("c_nationkey"))).alias("Phone"),
            F.md5("c_name").alias("PasswordHash"),
            F.lit(None).cast("string").alias("PasswordSalt"),
            F.md5(F.col("c_custkey").cast("string")).alias("rowguid"),
            _modified(renamed).alias("ModifiedDate"),
        )

    def address(self) -> DataFrame:
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", "n_name", "n_regionkey", "r_name")
        moved = self._changed(F.col("c_mktsegment") == "BUILDING")
        postal = _text(F.col("c_nationkey") + 10000, " ", F.col("n_regionkey"))
        return (
            self._customers()
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").cast("bigint").alias("AddressID"),
                _text(F.col("c_custkey"), " Main St").alias("AddressLine1"),
                F.when(F.col("c_mktsegment") != "HOUSEHOLD", _text("Suite ", F.col("c_nationkey"))).alias("AddressLine2"),
                F.when(moved, _text("New ", F.col("n_name"))).otherwise(F.col("n_name")).alias("City"),
                F.col("n_name").alias("StateProvince"),
                F.col("r_name").alias("CountryRegion"),
                F.when(F.col("c_acctbal") >= 0, postal).alias("PostalCode"),
                F.md5(F.col("c_custkey").cast("string")).alias("rowguid"),
                _modified(moved).alias("ModifiedDate"),
            )
        )

    def customeraddress(self) -> DataFrame:
        moved = self._changed(F.col("c_mktsegment") == "BUILDING")
        return self._customers().select(
            F.col("c_custkey").cast("bigint").alias("CustomerID"),
            F.col("c_custkey").cast("bigint").alias("AddressID"),
            F.when(moved, "Shipping").otherwise("Main Office").alias("AddressType"),
            F.md5(F.col("c_custkey").cast("string")).alias("rowguid"),
            _modified(moved).alias("ModifiedDate"),
        )

    def sales_order_header(self) -> DataFrame:
        priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        orders = self._members(
            self.table("orders"), priority == "2-HIGH", (status == "F") & (priority == "5-LOW")
        )
        finished = self._changed(status == "P")
        code = F.when(finished, F.lit(STATUS_CODES["F"]))
        for letter, number in STATUS_CODES.items():
            code = code.when(status == letter, F.lit(number))
        day = F.col("o_orderdate").cast("timestamp")
        total = F.col("o_totalprice").cast(MONEY)
        none = F.lit(None).cast("string")
        return orders.select(
            F.col("o_orderkey").cast("bigint").alias("SalesOrderID"),
            F.when(finished, 2).otherwise(1).cast("smallint").alias("RevisionNumber"),
            day.alias("OrderDate"),
            (day + F.expr("interval 12 days")).alias("DueDate"),
            F.when(status != "O", day + F.expr("interval 7 days")).alias("ShipDate"),
            code.cast("smallint").alias("Status"),
            (priority == "1-URGENT").alias("OnlineOrderFlag"),
            _text("SO", F.col("o_orderkey")).alias("SalesOrderNumber"),
            none.alias("PurchaseOrderNumber"),
            _text("AC", F.col("o_custkey")).alias("AccountNumber"),
            F.col("o_custkey").cast("bigint").alias("CustomerID"),
            F.col("o_custkey").cast("bigint").alias("ShipToAddressID"),
            F.col("o_custkey").cast("bigint").alias("BillToAddressID"),
            priority.alias("ShipMethod"),
            none.alias("CreditCardApprovalCode"),
            total.alias("SubTotal"),
            F.lit(0).cast(MONEY).alias("TaxAmt"),
            F.lit(0).cast(MONEY).alias("Freight"),
            total.alias("TotalDue"),
            none.alias("Comment"),
            F.md5(F.col("o_orderkey").cast("string")).alias("rowguid"),
            _modified(finished).alias("ModifiedDate"),
        )

    def sales_order_detail(self) -> DataFrame:
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        lines = self._members(
            self.table("lineitem"), (flag == "N") & (status == "F"), (flag == "R") & (status == "F")
        )
        cheaper = self._changed((flag == "A") & (status == "O"))
        price, rate = F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast(MONEY)
        # Line numbers repeat within an order, so the detail id is made from the line's own content.
        identity = [
            F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity").cast(MONEY),
            price, rate, F.col("l_tax").cast(MONEY), flag, status, F.to_date("l_shipdate"),
        ]
        return lines.select(
            F.col("l_orderkey").cast("bigint").alias("SalesOrderID"),
            digit_id(identity).alias("SalesOrderDetailID"),
            F.col("l_quantity").cast("smallint").alias("OrderQty"),
            F.col("l_partkey").cast("bigint").alias("ProductID"),
            F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast(MONEY).alias("UnitPrice"),
            F.when(cheaper, (rate + F.lit("0.05").cast("decimal(3,2)")).cast(MONEY)).otherwise(rate)
            .alias("UnitPriceDiscount"),
            (price * (F.lit(1).cast("decimal(1,0)") - rate)).cast("decimal(38,6)").alias("LineTotal"),
            F.md5(F.col("l_orderkey").cast("string")).alias("rowguid"),
            _modified(cheaper).alias("ModifiedDate"),
        )

    def product(self) -> DataFrame:
        kind, size, brand = F.col("p_type"), F.col("p_size"), F.col("p_brand")
        parts = self._members(self.table("part"), kind == "SMALL", (kind == "ECONOMY") & (size > 40))
        cheaper = self._changed(kind == "PROMO")
        tenth, half = F.lit("0.1").cast("decimal(2,1)"), F.lit("0.5").cast("decimal(2,1)")
        base = F.col("p_retailprice").cast(MONEY)
        price = (base * size * tenth).cast(MONEY)
        cost = (base * size * F.lit("0.06").cast("decimal(3,2)")).cast(MONEY)
        return parts.select(
            F.col("p_partkey").cast("bigint").alias("ProductID"),
            F.col("p_name").alias("Name"),
            _text("P-", F.col("p_partkey")).alias("ProductNumber"),
            F.substring_index("p_name", " ", 1).alias("Color"),
            F.when(brand == "Brand#1", F.lit(0)).otherwise(cost).cast(MONEY).alias("StandardCost"),
            F.when(cheaper, (price * half).cast(MONEY)).otherwise(price).alias("ListPrice"),
            size.cast("string").alias("Size"),
            F.when(kind != "MEDIUM", (size * half).cast("decimal(8,2)")).alias("Weight"),
            category_id(3).alias("ProductCategoryID"),
            model_id().alias("ProductModelID"),
            _stamp("2020-01-01 00:00:00").alias("SellStartDate"),
            F.when(kind == "STANDARD", _stamp("2023-06-30 00:00:00")).alias("SellEndDate"),
            F.when(brand == "Brand#7", _stamp("2022-01-01 00:00:00")).alias("DiscontinuedDate"),
            F.lit(None).cast("binary").alias("ThumbNailPhoto"),
            F.lit(None).cast("string").alias("ThumbnailPhotoFileName"),
            F.md5(F.col("p_partkey").cast("string")).alias("rowguid"),
            _modified(cheaper).alias("ModifiedDate"),
        )

    def productcategory(self) -> DataFrame:
        """Three levels: type, brand within type, size class within brand.

        Parts are reduced to their few distinct paths first; ids and levels are made from those.
        """
        root = F.when(self._changed(F.col("p_type") == "PROMO"), "PROMOTION").otherwise(F.col("p_type"))
        no_parent = F.lit(None).cast("int")
        nodes = F.array(
            F.struct(category_id(1).alias("id"), no_parent.alias("parent"), root.alias("name")),
            F.struct(category_id(2).alias("id"), category_id(1).alias("parent"), F.col("p_brand").alias("name")),
            F.struct(category_id(3, "size_class").alias("id"), category_id(2).alias("parent"),
                     F.col("size_class").alias("name")),
        )
        return (
            self.table("part").select("p_type", "p_brand", size_class().alias("size_class")).distinct()
            .select(F.explode(nodes).alias("n")).select("n.*").distinct()
            .select(
                F.col("id").alias("ProductCategoryID"),
                F.col("parent").alias("ParentProductCategoryID"),
                F.col("name").alias("Name"),
                F.md5(F.col("id").cast("string")).alias("rowguid"),
                _modified(F.col("name") == "PROMOTION").alias("ModifiedDate"),
            )
        )

    def _brands(self) -> DataFrame:
        return self.table("part").select("p_brand").distinct()

    def productdescription(self) -> DataFrame:
        return self._brands().select(
            F.explode(F.array(*map(F.lit, CULTURES))).alias("culture"), "p_brand"
        ).select(
            description_id().alias("ProductDescriptionID"),
            _text("Parts of ", F.col("p_brand"), " in ", F.col("culture")).alias("Description"),
            F.md5("p_brand").alias("rowguid"),
            _modified(self._changed(F.col("culture") == "fr")).alias("ModifiedDate"),
        )

    def productmodel(self) -> DataFrame:
        return self._brands().select(
            model_id().alias("ProductModelID"),
            _text("Model ", F.col("p_brand")).alias("Name"),
            F.lit(None).cast("string").alias("CatalogDescription"),
            F.md5("p_brand").alias("rowguid"),
            _stamp(STATE_TIMES[1]).alias("ModifiedDate"),
        )

    def productmodelproductdescription(self) -> DataFrame:
        return self._brands().select(
            F.explode(F.array(*map(F.lit, CULTURES))).alias("culture"), "p_brand"
        ).select(
            model_id().alias("ProductModelID"),
            description_id().alias("ProductDescriptionID"),
            F.col("culture").alias("Culture"),
            F.md5("p_brand").alias("rowguid"),
            _stamp(STATE_TIMES[1]).alias("ModifiedDate"),
        )

    def vgetallcategories(self) -> DataFrame:
        nodes = self.productcategory().select("ProductCategoryID", "ParentProductCategoryID", "Name")
        parents = nodes.select(
            F.col("ProductCategoryID").alias("ParentProductCategoryID"),
            F.col("Name").alias("ParentProductCategoryName"),
        )
        return nodes.join(parents, "ParentProductCategoryID", "left").select(
            "ParentProductCategoryName", F.col("Name").alias("ProductCategoryName"), "ProductCategoryID"
        )

    def vproductanddescription(self) -> DataFrame:
        brand = F.col("p_brand")
        return self.table("part").select(
            F.explode(F.array(*map(F.lit, CULTURES))).alias("culture"), "p_partkey", "p_name", "p_brand"
        ).select(
            F.col("p_partkey").cast("bigint").alias("ProductID"),
            F.col("p_name").alias("Name"),
            _text("Model ", brand).alias("ProductModel"),
            F.col("culture").alias("Culture"),
            _text("Parts of ", brand, " in ", F.col("culture")).alias("Description"),
        )

    def vproductmodelcatalogdescription(self) -> DataFrame:
        from orefold.sources.entities import MODEL_CATALOG

        filled = {
            "ProductModelID": model_id(),
            "Name": _text("Model ", F.col("p_brand")),
            "Summary": _text("Summary of ", F.col("p_brand")),
            "Manufacturer": F.lit("Works"),
            "rowguid": F.md5("p_brand"),
            "ModifiedDate": _stamp(STATE_TIMES[1]),
        }
        return self._brands().select(*[
            filled.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in MODEL_CATALOG.source_columns
        ])

    def entities(self) -> dict[str, DataFrame]:
        """All 13 entities by silver name."""
        from orefold.sources.entities import ENTITIES

        return {name: getattr(self, name)() for name in ENTITIES}


def size_class() -> Column:
    return F.when(F.col("p_size") <= 25, "Compact").otherwise("Large")


def category_id(level: int, class_column: str | None = None) -> Column:
    names = [F.col("p_type"), F.col("p_brand"), F.col(class_column) if class_column else size_class()][:level]
    return digit_id(names, hex_digits=7).cast("int")


def model_id() -> Column:
    return digit_id([F.col("p_brand")], hex_digits=7).cast("int")


def description_id() -> Column:
    return digit_id([F.col("p_brand"), F.col("culture")], hex_digits=7).cast("int")
