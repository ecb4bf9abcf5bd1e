"""Recency / Frequency / Monetary per (customer, category).

Grain: daily = (CustomerID, ProductCategoryID, ProductCategoryName, date);
metrics = (CustomerID, ProductCategoryID, ProductCategoryName).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import GROUP_KEYS, MONEY
from ..session import materialize


def daily_sales(silver: DataFrame, anonymous: str = "keep") -> DataFrame:
    """Sum of positive SalesAmount per customer x category x calendar day.

    Returns (``SalesAmount > 0``; zero and null drop) are excluded. A null
    CustomerID (anonymous lines) is one group under ``keep`` and dropped under
    ``drop``. The groupBy is planned with a map-side partial sum, so a hot key
    (e.g. the anonymous customer) ships at most one row per day per map task.
    """
    if anonymous not in ("keep", "drop"):
        raise ValueError("anonymous must be 'keep' or 'drop'")
    df = silver.where(F.col("SalesAmount") > 0)
    if anonymous == "drop":
        df = df.where(F.col("CustomerID").isNotNull())
    return (df.groupBy(*GROUP_KEYS, F.to_date("InvoiceDate").alias("InvoiceDate"))
            .agg(F.sum("SalesAmount").cast(MONEY).alias("DailySales")))


def snapshot_date(lines: DataFrame) -> DataFrame:
    """One-row frame: the latest calendar day with a positive sale.

    Works on order lines (silver) or on ``daily_sales`` output; a return never
    moves it. Planned as a partial max per task, so no data shuffle."""
    return (lines.where(F.col("SalesAmount") > 0) if "SalesAmount" in lines.columns else lines) \
        .agg(F.max(F.to_date("InvoiceDate")).alias("GlobalLastDate"))


def _date_literal(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of).cast("date")


def group_totals(daily: DataFrame) -> DataFrame:
    """Per (customer, category): last purchase day, purchase days, sales. Lazy."""
    return daily.groupBy(*GROUP_KEYS).agg(
        F.max("InvoiceDate").alias("_last"),
        F.count("InvoiceDate").alias("Frequency"),
        F.sum("DailySales").alias("_total"),
    )


def rfmp_from_totals(per: DataFrame, as_of=None) -> DataFrame:
    """Recency, Frequency and MonetaryValue from ``group_totals``. With
    ``as_of`` = None one small job reads the last day of ``per`` (pass a written
    table); it enters the plan as a literal, so there is no cross join."""
    snap = _date_literal(per.agg(F.max("_last")).first()[0] if as_of is None else as_of)
    return per.select(
        *GROUP_KEYS,
        F.datediff(snap, F.col("_last")).alias("Recency"),
        F.col("Frequency"),
        (F.col("_total").cast("double") / F.col("Frequency")).alias("MonetaryValue"),
    )


def rfmp_metrics(daily: DataFrame, as_of=None) -> DataFrame:
    """Recency, Frequency and MonetaryValue per (customer, category).

    * Recency = days from the snapshot to the group's last purchase day
      (= min over days of datediff(snapshot, day)).
    * Frequency = number of purchase days (``daily`` holds one row per day per
      group, so a plain count equals count-distinct without its extra shuffle).
    * MonetaryValue = mean of the daily sums, computed as
      ``cast(sum as double) / days`` so it does not depend on summation order.

    Lazy when ``as_of`` is given. With ``as_of`` = None this is an eager step,
    like a fit: the per-group table is written once to the shared checkpoint
    folder and its last day read, so the upstream plan does not run twice.
    """
    per = group_totals(daily)
    return rfmp_from_totals(materialize(per, "rfm_partial") if as_of is None else per, as_of)


def cap_metrics(metrics: DataFrame, freq_cap: int | None = 30,
                monetary_cap: float | None = 2500.0) -> DataFrame:
    """Cap outliers: Frequency at ``freq_cap`` and MonetaryValue at
    ``monetary_cap`` (CASE WHEN, so a null stays null). ``None`` disables."""
    out = metrics
    if freq_cap is not None:
        out = out.withColumn("Frequency", F.when(F.col("Frequency") > freq_cap, F.lit(freq_cap).cast("bigint"))
                             .otherwise(F.col("Frequency")))
    if monetary_cap is not None:
        out = out.withColumn("MonetaryValue", F.when(F.col("MonetaryValue") > monetary_cap,
                                                     F.lit(float(monetary_cap)))
                             .otherwise(F.col("MonetaryValue")))
    return out


def with_recency_sign(df: DataFrame, recency_sign: int = 1) -> DataFrame:
    """Presentation of Recency in an output table: days >= 0 (``1``, default)
    or negated (``-1``) so that larger is better, as some consumers expect.
    Binning always scores ``-Recency`` on the unsigned days."""
    if recency_sign not in (1, -1):
        raise ValueError("recency_sign must be 1 or -1")
    return df if recency_sign == 1 else df.withColumn("Recency", -F.col("Recency"))
