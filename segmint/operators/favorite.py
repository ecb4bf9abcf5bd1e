"""Per-customer ranking of categories, favourite category, samples, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Full, deterministic order of a customer's categories: most frequent first,
# then higher spend, then most recent (smaller Recency in days), then id and
# name ascending with nulls last.
def category_order() -> list[Column]:
    return [F.col("Frequency").desc(), F.col("MonetaryValue").desc(), F.col("Recency").asc(),
            F.col("ProductCategoryID").asc_nulls_last(), F.col("ProductCategoryName").asc_nulls_last()]


def category_rank(gold: DataFrame) -> DataFrame:
    """Every (customer, category) row with its rank ``rn`` within the customer."""
    w = Window.partitionBy("CustomerID").orderBy(*category_order())
    return gold.withColumn("rn", F.row_number().over(w))


def favorite_category(gold: DataFrame) -> DataFrame:
    """The top-ranked category of each customer, with its metrics and bins.

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so each map task ships at most one row per customer -- a hot
    customer (e.g. the anonymous null id) cannot flood one reducer.
    """
    cols = [F.col("CustomerID"),
            F.col("ProductCategoryID").alias("FavoriteCategoryID"),
            F.col("ProductCategoryName").alias("FavoriteCategoryName"),
            F.col("Recency"), F.col("Frequency"), F.col("MonetaryValue")]
    cols += [F.col(b) for b in ("r_bin", "f_bin", "m_bin") if b in gold.columns]
    return category_rank(gold).where(F.col("rn") == 1).select(*cols)


def customer_lookup(gold: DataFrame, customer_id) -> DataFrame:
    """All rows of one customer. The id is compared as a string (ids are
    strings; comparing with an int would fail on a non-numeric id)."""
    return gold.where(F.col("CustomerID") == F.lit(str(customer_id)))


def category_samples(categorized: DataFrame, n: int = 10, category_col: str = "ProductCategoryID",
                     text_col: str = "Description") -> DataFrame:
    """Up to ``n`` distinct sample texts per category, in one job (the
    descriptions ranked descending within each category)."""
    base = categorized.where(F.col(text_col).isNotNull()).select(category_col, text_col).distinct()
    w = Window.partitionBy(category_col).orderBy(F.col(text_col).desc())
    return (base.withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= n))


def preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in a stated order (a checkable ``display(df.limit(n))``)."""
    return df.orderBy(*order_by).limit(n)
