"""Source schemas, the star schema and the container that carries its tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

PRICE = DecimalType(10, 2)
# Money totals: wide enough for any number of quantity * price terms.
MONEY = DecimalType(38, 2)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


TRANSACTIONS = _struct(
    Order_ID=LongType(),
    Order_Date=TimestampNTZType(),
    ProductID=LongType(),
    CustomerID=LongType(),
    CustomerName=StringType(),
    Gender=StringType(),
    Quantity_Ordered=IntegerType(),
)

MASTER = _struct(
    productID=LongType(),
    productName=StringType(),
    productPrice=PRICE,
    supplierID=LongType(),
    supplierName=StringType(),
    storeID=LongType(),
    storeName=StringType(),
)

STAR: dict[str, StructType] = {
    "OrderFacts": _struct(
        OrderID=LongType(),
        OrderDate=DateType(),
        ProductID=LongType(),
        CustomerID=LongType(),
        QuantityOrdered=IntegerType(),
        productPrice=PRICE,
    ),
    "ProductDimension": _struct(
        ProductID=LongType(), productName=StringType(), supplierID=LongType()
    ),
    "CustomerDimension": _struct(
        CustomerID=LongType(), CustomerName=StringType(), Gender=StringType()
    ),
    "SupplierDimension": _struct(supplierID=LongType(), supplierName=StringType()),
    "StoreDimension": _struct(storeID=LongType(), storeName=StringType()),
}

FACT_TABLE = "OrderFacts"

# Parents before children, so that a reader never sees a product without its
# supplier or a fact without its dimensions.
DIMENSION_KEYS: dict[str, str] = {
    "SupplierDimension": "supplierID",
    "ProductDimension": "ProductID",
    "CustomerDimension": "CustomerID",
    "StoreDimension": "storeID",
}
FACT_KEYS = ["OrderID"]
# An order keeps the product it was first loaded with; every other column
# follows the newest row.
FACT_KEEP_FIRST = ["ProductID"]


@dataclass(frozen=True)
class Star:
    """The five warehouse tables. Dimensions are unique on their key."""

    facts: DataFrame
    product: DataFrame
    customer: DataFrame
    supplier: DataFrame
    store: DataFrame

    def __post_init__(self) -> None:
        # Totals are summed in cents and rely on this.
        price = self.facts.schema["productPrice"].dataType
        if price != PRICE:
            raise TypeError(f"productPrice must be {PRICE.simpleString()}, not {price.simpleString()}")

    def tables(self) -> Iterator[tuple[str, DataFrame]]:
        yield "OrderFacts", self.facts
        yield "ProductDimension", self.product
        yield "CustomerDimension", self.customer
        yield "SupplierDimension", self.supplier
        yield "StoreDimension", self.store

    def register(self) -> None:
        """Expose the tables to ``spark.sql`` under their warehouse names."""
        for name, table in self.tables():
            table.createOrReplaceTempView(name)


def create_tables(spark: SparkSession, location: str) -> None:
    """Declare the five Parquet tables in the current database, if absent."""
    for name, schema in STAR.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) "
            f"USING parquet LOCATION '{location.rstrip('/')}/{name}'"
        )


def conform(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Cast ``df`` to the columns and types of ``schema``.

    ``strict`` raises on a value that does not fit (ANSI cast); otherwise such
    a value becomes NULL, for feeds that have not been cleaned.
    """
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
