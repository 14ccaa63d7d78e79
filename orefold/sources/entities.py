"""The source entities: columns, keys, compared columns.

Silver names follow from source names by rule (``snake_case``); exceptions are listed per entity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions.columns import row_hash, snake_case


@dataclass(frozen=True)
class Entity:
    """``columns`` is the source schema as DDL text, in source order.

    ``tracked``: columns whose change makes the bronze upsert update a row (``None``: always).
    ``hashed``: columns of the silver row hash, in hash order. Columns outside the list can change
    unseen; ``hashed_source(..., every_column=True)`` covers them all.
    """

    name: str
    source: str
    columns: str
    keys: Sequence[str]
    tracked: Sequence[str] | None
    hashed: Sequence[str]
    renames: Mapping[str, str] = field(default_factory=dict)
    dropped: Sequence[str] = ()
    course: bool = False

    @property
    def source_columns(self) -> list[tuple[str, str]]:
        return [tuple(part.strip().split(" ", 1)) for part in self.columns.split(", ")]

    @property
    def source_schema(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.source_columns)

    @property
    def partition_column(self) -> str | None:
        """The leading key, if it is a whole number: a source table is read in ranges of it."""
        kind = dict(self.source_columns)[self.keys[0]]
        return self.keys[0] if kind in ("smallint", "int", "bigint") else None

    def silver_name(self, column: str) -> str:
        return self.renames.get(column, snake_case(column))

    @property
    def silver_keys(self) -> list[str]:
        return [self.silver_name(k) for k in self.keys]

    @property
    def attributes(self) -> list[str]:
        """Silver columns without the keys."""
        names = [self.silver_name(c) for c, _ in self.source_columns if c not in self.dropped]
        return [n for n in names if n not in set(self.silver_keys)]

    @property
    def hash_follows(self) -> bool:
        """Whether silver rows hold all columns of their hash."""
        return not set(self.hashed) & set(self.dropped)

    def renamed(self, bronze: DataFrame) -> DataFrame:
        return bronze.select(*[
            F.col(c).cast(kind).alias(self.silver_name(c)) for c, kind in self.source_columns
        ])

    def hash_value(self, every_column: bool = False) -> Column:
        names = [c for c, _ in self.source_columns if c not in self.keys] if every_column else self.hashed
        return row_hash([self.silver_name(c) for c in names])

    def hashed_source(self, bronze: DataFrame, every_column: bool = False) -> DataFrame:
        """Renamed, typed source rows with their hash."""
        out = self.renamed(bronze).withColumn("_tf_row_hash", self.hash_value(every_column))
        return out.drop(*[self.silver_name(c) for c in self.dropped])


# Names, types and column lists of the order-management source.
ADDRESS = Entity(
    name="address", source="address", course=True,
    columns="AddressID bigint, AddressLine1 string, AddressLine2 string, City string, StateProvince string, "
            "CountryRegion string, PostalCode string, rowguid string, ModifiedDate timestamp",
    keys=["AddressID"],
    tracked=["AddressLine1", "AddressLine2", "City", "ModifiedDate"],
    hashed=["AddressLine1", "AddressLine2", "City", "StateProvince", "CountryRegion", "PostalCode",
            "rowguid", "ModifiedDate"],
)
CUSTOMER = Entity(
    name="customer", source="customer", course=True,
    columns="CustomerID bigint, NameStyle boolean, Title string, FirstName string, MiddleName string, "
            "LastName string, Suffix string, CompanyName string, SalesPerson string, EmailAddress string, "
            "Phone string, PasswordHash string, PasswordSalt string, rowguid string, ModifiedDate timestamp",
    keys=["CustomerID"],
    tracked=["FirstName", "LastName", "EmailAddress", "ModifiedDate"],
    hashed=["NameStyle", "Title", "FirstName", "MiddleName", "LastName", "Suffix", "CompanyName",
            "SalesPerson", "EmailAddress", "Phone", "rowguid", "ModifiedDate"],
)
CUSTOMER_ADDRESS = Entity(
    name="customeraddress", source="customeraddress",
    columns="CustomerID bigint, AddressID bigint, AddressType string, rowguid string, ModifiedDate timestamp",
    keys=["CustomerID", "AddressID"],
    tracked=["AddressType", "ModifiedDate"],
    hashed=["CustomerID", "AddressID", "AddressType", "ModifiedDate"],
)
SALES_ORDER_HEADER = Entity(
    name="sales_order_header", source="salesorderheader", course=True,
    columns="SalesOrderID bigint, RevisionNumber smallint, OrderDate timestamp, DueDate timestamp, "
            "ShipDate timestamp, Status smallint, OnlineOrderFlag boolean, SalesOrderNumber string, "
            "PurchaseOrderNumber string, AccountNumber string, CustomerID bigint, ShipToAddressID bigint, "
            "BillToAddressID bigint, ShipMethod string, CreditCardApprovalCode string, SubTotal decimal(19,4), "
            "TaxAmt decimal(19,4), Freight decimal(19,4), TotalDue decimal(19,4), Comment string, "
            "rowguid string, ModifiedDate timestamp",
    keys=["SalesOrderID"],
    tracked=["RevisionNumber", "Status", "ModifiedDate"],
    hashed=["RevisionNumber", "OrderDate", "Status", "CustomerID", "SubTotal", "TaxAmt", "Freight",
            "TotalDue", "rowguid", "ModifiedDate"],
)
SALES_ORDER_DETAIL = Entity(
    name="sales_order_detail", source="salesorderdetail", course=True,
    columns="SalesOrderID bigint, SalesOrderDetailID bigint, OrderQty smallint, ProductID bigint, "
            "UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), LineTotal decimal(38,6), "
            "rowguid string, ModifiedDate timestamp",
    keys=["SalesOrderID", "SalesOrderDetailID"],
    tracked=["OrderQty", "UnitPrice", "ModifiedDate"],
    hashed=["OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount", "LineTotal", "rowguid",
            "ModifiedDate"],
)
PRODUCT = Entity(
    name="product", source="product",
    columns="ProductID bigint, Name string, ProductNumber string, Color string, StandardCost decimal(19,4), "
            "ListPrice decimal(19,4), Size string, Weight decimal(8,2), ProductCategoryID int, "
            "ProductModelID int, SellStartDate timestamp, SellEndDate timestamp, DiscontinuedDate timestamp, "
            "ThumbNailPhoto binary, ThumbnailPhotoFileName string, rowguid string, ModifiedDate timestamp",
    keys=["ProductID"],
    tracked=["Name", "ListPrice", "ModifiedDate"],
    hashed=["Name", "ProductNumber", "Color", "StandardCost", "ListPrice", "Size", "Weight",
            "ProductCategoryID", "ProductModelID", "SellStartDate", "SellEndDate", "DiscontinuedDate",
            "ModifiedDate"],
    renames={"ThumbNailPhoto": "thumbnail_photo"},
)
PRODUCT_CATEGORY = Entity(
    name="productcategory", source="productcategory",
    columns="ProductCategoryID int, ParentProductCategoryID int, Name string, rowguid string, "
            "ModifiedDate timestamp",
    keys=["ProductCategoryID"],
    tracked=["Name", "ModifiedDate"],
    hashed=["ParentProductCategoryID", "Name", "ModifiedDate"],
)
PRODUCT_DESCRIPTION = Entity(
    name="productdescription", source="productdescription",
    columns="ProductDescriptionID int, Description string, rowguid string, ModifiedDate timestamp",
    keys=["ProductDescriptionID"],
    tracked=["Description", "ModifiedDate"],
    hashed=["Description", "ModifiedDate", "rowguid"],
)
PRODUCT_MODEL = Entity(
    name="productmodel", source="productmodel",
    columns="ProductModelID int, Name string, CatalogDescription string, rowguid string, "
            "ModifiedDate timestamp",
    keys=["ProductModelID"],
    tracked=["Name", "ModifiedDate"],
    hashed=["Name", "CatalogDescription", "ModifiedDate"],
)
MODEL_DESCRIPTION = Entity(
    name="productmodelproductdescription", source="productmodelproductdescription",
    columns="ProductModelID int, ProductDescriptionID int, Culture string, rowguid string, "
            "ModifiedDate timestamp",
    keys=["ProductModelID", "ProductDescriptionID", "Culture"],
    tracked=["ModifiedDate"],
    hashed=["ProductModelID", "ProductDescriptionID", "Culture", "ModifiedDate"],
)
ALL_CATEGORIES = Entity(
    name="vgetallcategories", source="vgetallcategories",
    columns="ParentProductCategoryName string, ProductCategoryName string, ProductCategoryID int",
    keys=["ProductCategoryID"],
    tracked=None,
    hashed=["ParentProductCategoryName", "ProductCategoryName"],
    renames={"ProductCategoryName": "name"},
    dropped=["ParentProductCategoryName"],
)
PRODUCT_AND_DESCRIPTION = Entity(
    name="vproductanddescription", source="vproductanddescription",
    columns="ProductID bigint, Name string, ProductModel string, Culture string, Description string",
    keys=["ProductID", "Culture"],
    tracked=None,
    hashed=["Name", "ProductModel", "Culture", "Description"],
)
MODEL_CATALOG = Entity(
    name="vproductmodelcatalogdescription", source="vproductmodelcatalogdescription",
    columns="ProductModelID int, Name string, Summary string, Manufacturer string, Copyright string, "
            "ProductURL string, WarrantyPeriod string, WarrantyDescription string, NoOfYears string, "
            "MaintenanceDescription string, Wheel string, Saddle string, Pedal string, BikeFrame string, "
            "Crankset string, PictureAngle string, PictureSize string, ProductPhotoID string, "
            "Material string, Color string, ProductLine string, Style string, RiderExperience string, "
            "rowguid string, ModifiedDate timestamp",
    keys=["ProductModelID"],
    tracked=["ModifiedDate"],
    hashed=["Name", "Summary", "Manufacturer", "ModifiedDate"],
    renames={name: name.lower() for name in (
        "ProductURL", "WarrantyPeriod", "WarrantyDescription", "NoOfYears", "MaintenanceDescription",
        "BikeFrame", "PictureAngle", "PictureSize", "ProductPhotoID", "ProductLine", "RiderExperience",
        "ModifiedDate",
    )},
)

ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        ADDRESS, CUSTOMER, CUSTOMER_ADDRESS, SALES_ORDER_HEADER, SALES_ORDER_DETAIL, PRODUCT,
        PRODUCT_CATEGORY, PRODUCT_DESCRIPTION, PRODUCT_MODEL, MODEL_DESCRIPTION, ALL_CATEGORIES,
        PRODUCT_AND_DESCRIPTION, MODEL_CATALOG,
    )
}
COURSE_ENTITIES: dict[str, Entity] = {name: e for name, e in ENTITIES.items() if e.course}


def with_parent_category(categories: DataFrame, bronze_category: DataFrame) -> DataFrame:
    """Adds the parent id, looked up by category id in the category table (one row per id)."""
    lookup = bronze_category.select(
        F.col("ProductCategoryID").cast("int").alias("product_category_id"),
        F.col("ParentProductCategoryID").cast("int").alias("parent_product_category_id"),
    ).dropDuplicates(["product_category_id"])
    return categories.join(lookup, "product_category_id", "left")
