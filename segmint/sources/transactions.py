"""Order-line sources.

``load_transactions`` maps the TPC-H-like test tables onto the bronze layer
(one row per order line); ``read_orders`` reads a typed CSV/Parquet export of
order lines, the distributed replacement for a spreadsheet read on one machine.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE, MONEY, ORDERS_CSV
from ..functions.joins import split_join
from ..session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def product_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category labels from the structured product type.

    ProductCategoryID = dense rank of ``p_type`` - 1. The window runs over the
    *distinct* types only (a dimension, one row per type), never over lines.
    """
    types = _table(spark, sf_dir, "part").select(F.col("p_type").alias("ProductCategoryName")).distinct()
    w = Window.orderBy(F.col("ProductCategoryName"))
    return types.select(
        (F.dense_rank().over(w) - 1).cast("int").alias("ProductCategoryID"),
        "ProductCategoryName")


def unique_dim(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """A dimension reduced to one row per key (max of each attribute).

    A left join of lines to it can never fan out, and because the key is
    provably unique Catalyst removes the join outright from any plan that
    uses none of its attributes (e.g. Country in the metrics)."""
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def _lines(spark: SparkSession, sf_dir: str, product: DataFrame, product_cols: list[str],
           per_order: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """lineitem ⋈ orders, then left lookups of product and customer country.

    lineitem/orders are the facts (inner join: a line needs its order's date
    and customer). Product and customer attributes are lookups on unique keys:
    a missing attribute leaves a null instead of dropping the sale, and an
    unused lookup costs nothing. The country joins the orders, so no line is
    shuffled for it. Sizes are left to the planner/AQE (runtime, size-checked
    broadcast); a part or customer that holds a large share of the lines is
    split by AQE (``split_join``).

    ``per_order`` may add columns that depend on the order alone (its
    CustomerID, say) to the orders, one row out for each row in; they follow
    the lines' own columns.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = unique_dim(
        _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"),
        "c_custkey", ["n_name"])
    od = split_join(od, cust, F.col("o_custkey"), F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("n_name").alias("Country"))
    customer = F.col("o_custkey").cast("string").alias("CustomerID")
    order_cols = []
    if per_order is not None:
        plain = od.columns
        od = per_order(od.select(*plain, customer)).drop("CustomerID")
        order_cols = [c for c in od.columns if c not in plain]
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    j = split_join(j, product, F.col("l_partkey"), F.col("p_partkey"))
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    return j.select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        (F.col("l_quantity").cast("bigint") * sign).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("UnitPrice"),
        customer,
        "Country",
        (F.col("l_extendedprice") * sign).cast(MONEY).alias("SalesAmount"),
        *product_cols,
        *order_cols,
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze order lines from the test tables (SalesAmount = ±extendedprice)."""
    part = unique_dim(_table(spark, sf_dir, "part"), "p_partkey", ["p_name"])
    return _lines(spark, sf_dir, part, [])


def load_typed_silver(spark: SparkSession, sf_dir: str,
                      per_order: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Silver order lines whose category is the structured ``p_type``.

    The id is attached to the product dimension (part ⋈ type labels) before
    the lines meet it, so the big side joins once, on ``l_partkey``.
    ``per_order``: columns added to the orders before they meet the lines.
    """
    labels = product_types(spark, sf_dir)
    part = (unique_dim(_table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_type"])
            .join(labels, F.col("p_type") == F.col("ProductCategoryName"), "left")
            .select("p_partkey", "p_name", "ProductCategoryID", "ProductCategoryName"))
    return _lines(spark, sf_dir, part, ["ProductCategoryID", "ProductCategoryName"], per_order)


def read_orders(spark: SparkSession, path: str, fmt: str = "csv", header: bool = True) -> DataFrame:
    """Read raw order lines with an explicit schema and derive SalesAmount.

    Replaces the single-machine spreadsheet read: any splittable format works
    and nothing passes through the driver.
    """
    if fmt == "csv":
        raw = (spark.read.schema(ORDERS_CSV).option("header", header)
               .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    else:
        raw = spark.read.format(fmt).load(path)
        raw = raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDERS_CSV.fields])
    return raw.withColumn(
        "SalesAmount", (F.col("Quantity") * F.col("UnitPrice").cast("decimal(18,4)")).cast(MONEY)
    ).select([f.name for f in BRONZE.fields])


def _readable(name: str, kind: T.DataType):
    """A raw value as its type: null where it cannot be read as one."""
    raw = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.try_to_timestamp(raw.cast("string"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return raw.try_cast(kind)


def read_orders_checked(spark: SparkSession, path: str, fmt: str = "csv", header: bool = True,
                        max_share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(bronze, rejects): order lines that could be read whole, and the others.

    Every field is read as text (CSV) or as stored, and then as its type.
    Rejects keep the raw fields as strings, the raw line where a CSV line has
    too many or too few fields, and ``reasons``: ``malformed`` for such a line,
    ``bad X`` for a value of X that is not of its type, ``missing X`` for an
    empty X that bronze needs. Nothing turns null on the way. The parsed lines
    are written once; ``max_share`` (0 to 1) raises ValueError when more of the
    lines are rejects."""
    names = [f.name for f in ORDERS_CSV.fields]
    if fmt == "csv":
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
        raw = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_line").csv(path))
    else:
        raw = spark.read.format(fmt).load(path).select(*names).withColumn("_line", F.lit(None).cast("string"))
    typed = {f"_{f.name}": _readable(f.name, f.dataType) for f in ORDERS_CSV.fields}
    amount = (F.col("_Quantity") * F.col("_UnitPrice").try_cast("decimal(18,4)")).try_cast(MONEY)
    needed = {f.name for f in ORDERS_CSV.fields if not f.nullable} | {"UnitPrice"}  # the amount needs a price
    why = [F.when(F.col("_line").isNotNull(), F.lit("malformed"))]
    for n in names:
        bad = F.when(F.col(n).isNotNull() & F.col(f"_{n}").isNull(), F.lit(f"bad {n}"))
        why.append(bad.when(F.col(n).isNull(), F.lit(f"missing {n}")) if n in needed else bad)
    checked = raw.withColumns(typed).withColumn("_amount", amount).withColumn("reasons", F.array_compact(F.array(*why)))
    short = (F.size("reasons") == 0) & F.col("_amount").isNull()
    checked = checked.withColumn("reasons", F.when(short, F.array(F.lit("bad SalesAmount"))).otherwise(F.col("reasons")))
    checked = materialize(checked, "orders-checked")
    if max_share is not None:
        n, lost = checked.agg(F.count(F.lit(1)), F.count_if(F.size("reasons") > 0)).first()
        if lost > max_share * n:
            raise ValueError(f"{lost} of {n} order lines cannot be read")
    good = checked.where(F.size("reasons") == 0).select(*[F.col(f"_{n}").alias(n) for n in names], F.col("_amount").alias("SalesAmount"))
    rejects = checked.where(F.size("reasons") > 0).select(*[F.col(n).cast("string").alias(n) for n in names],
                                                          F.col("_line").alias("line"), "reasons")
    return good.select([f.name for f in BRONZE.fields]), rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(reason, lines): how many lines each reason rejects."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def category_labels(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    """A user-supplied (id, name) label table (inline literal rows)."""
    from ..schemas import CATEGORY_LABELS
    return spark.createDataFrame(rows, CATEGORY_LABELS)
