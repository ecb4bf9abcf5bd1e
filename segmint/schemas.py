"""StructTypes of every layer and a boundary check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
GROUP_KEYS = ["CustomerID", "ProductCategoryID", "ProductCategoryName"]
METRICS = ["Recency", "Frequency", "MonetaryValue"]
BINS = ["r_bin", "f_bin", "m_bin"]

BRONZE = T.StructType([
    T.StructField("InvoiceNo", T.StringType(), False),
    T.StructField("StockCode", T.StringType(), False),
    T.StructField("Description", T.StringType(), True),
    T.StructField("Quantity", T.LongType(), False),
    T.StructField("InvoiceDate", T.TimestampNTZType(), False),
    T.StructField("UnitPrice", T.DoubleType(), True),
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("Country", T.StringType(), True),
    T.StructField("SalesAmount", MONEY, False),
])

# Raw order lines as read from CSV (no SalesAmount yet).
ORDERS_CSV = T.StructType([f for f in BRONZE.fields if f.name != "SalesAmount"])

CATEGORY_LABELS = T.StructType([
    T.StructField("ProductCategoryID", T.IntegerType(), True),
    T.StructField("ProductCategoryName", T.StringType(), True),
])

SILVER = T.StructType(BRONZE.fields + CATEGORY_LABELS.fields)

DAILY = T.StructType([
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("ProductCategoryID", T.IntegerType(), True),
    T.StructField("ProductCategoryName", T.StringType(), True),
    T.StructField("InvoiceDate", T.DateType(), True),
    T.StructField("DailySales", MONEY, True),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("ProductCategoryID", T.IntegerType(), True),
    T.StructField("ProductCategoryName", T.StringType(), True),
    T.StructField("Recency", T.IntegerType(), True),
    T.StructField("Frequency", T.LongType(), True),
    T.StructField("MonetaryValue", T.DoubleType(), True),
])

GOLD = T.StructType(METRICS_SCHEMA.fields + [
    T.StructField(b, T.IntegerType(), True) for b in BINS])

FAVORITE = T.StructType([
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("FavoriteCategoryID", T.IntegerType(), True),
    T.StructField("FavoriteCategoryName", T.StringType(), True),
    T.StructField("Recency", T.IntegerType(), True),
    T.StructField("Frequency", T.LongType(), True),
    T.StructField("MonetaryValue", T.DoubleType(), True),
] + [T.StructField(b, T.IntegerType(), True) for b in BINS])

CENTROIDS = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("r", T.DoubleType(), False),
    T.StructField("f", T.DoubleType(), False),
    T.StructField("m", T.DoubleType(), False),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, expected: T.StructType, nullable: bool = False) -> DataFrame:
    """Fail fast when a layer does not carry the expected columns and types.

    Extra columns are allowed; nullability is only compared when asked."""
    have = {f.name: f for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        got = have.get(f.name)
        if got is None:
            problems.append(f"missing {f.name}")
        elif got.dataType != f.dataType:
            problems.append(f"{f.name}: {got.dataType.simpleString()} != {f.dataType.simpleString()}")
        elif nullable and got.nullable and not f.nullable:
            problems.append(f"{f.name}: nullable")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
