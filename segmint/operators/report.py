"""Segment outputs and descriptive reports (all DataFrame -> DataFrame).

Everything here is a groupBy, window or equi-join; the only small tables
broadcast are the model's centroids (k rows) and label tables (one row per
segment), both bounded by the number of segments.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import LINE_SALT, left_lookup
from .cluster import BIN_COLS, bin_cells


# ----------------------------------------------------------------------------
# histograms and level counts
# ----------------------------------------------------------------------------
def metric_histogram(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """Equal-width histogram per column, edges from min to max, last bin
    closed: (metric, bin, lo, hi, n). A constant column is one bin 0.

    Two scans whatever the number of columns: a partial min/max per task (two
    numbers per column reach the driver), then one groupBy of the stacked
    (metric, value) rows, which is map-side combined to bins per task."""
    names = list(cols)
    mm = df.agg(*[e for i, c in enumerate(names)
                  for e in (F.min(F.col(c).cast("double")).alias(f"lo{i}"),
                            F.max(F.col(c).cast("double")).alias(f"hi{i}"))]).first()
    edges = {c: (mm[f"lo{i}"], mm[f"hi{i}"]) for i, c in enumerate(names) if mm[f"lo{i}"] is not None}
    if not edges:  # no non-null value in any column
        return df.sparkSession.createDataFrame([], "metric string, bin int, lo double, hi double, n bigint")
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in edges)
    rows = df.selectExpr(f"stack({len(edges)}, {stack}) AS (metric, x)").where(F.col("x").isNotNull())

    def of(value) -> Column:
        out = F.lit(None).cast("double")
        for c, (lo, hi) in edges.items():
            out = F.when(F.col("metric") == c, F.lit(float(value(lo, hi)))).otherwise(out)
        return out

    lo, hi, span = of(lambda a, b: a), of(lambda a, b: b), of(lambda a, b: b - a)
    width = of(lambda a, b: (b - a) / bins if b > a else 0.0)
    spot = F.when(span > 0, F.least(F.floor((F.col("x") - lo) / span * F.lit(bins)), F.lit(bins - 1))).otherwise(0).cast("int")
    g = rows.groupBy("metric", spot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("metric", "bin", (lo + F.col("bin") * width).alias("lo"),
                    F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("hi"), "n")


def level_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row count and number of distinct levels per column: (metric, levels,
    rows). Rows are first counted per distinct combination of levels (one
    shuffle of few rows for ordinal columns); levels are counted on those."""
    cells = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    sets = [F.size(F.collect_set(F.struct(F.col(c).alias("v")))).cast("bigint") for c in cols]
    nulls = [F.max(F.col(c).isNull().cast("int")) for c in cols]
    agg = cells.agg(F.sum("_n").alias("rows"), *[(s - F.coalesce(z, F.lit(0))).alias(f"l{i}")
                                                 for i, (s, z) in enumerate(zip(sets, nulls))])
    stack = ", ".join(f"'{c}', l{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, levels)", "coalesce(rows, 0) AS rows")


# ----------------------------------------------------------------------------
# centroids and labels
# ----------------------------------------------------------------------------
def centroid_levels(centroids: DataFrame) -> DataFrame:
    """Centroids as whole levels: round half-to-even, cast to int, abs."""
    def lvl(c: str) -> Column:
        return F.abs(F.bround(F.col(c), 0).cast("int"))
    return centroids.select("cluster", lvl("r").alias("r_bin"), lvl("f").alias("f_bin"), lvl("m").alias("m_bin"))


def label_text(levels: DataFrame) -> DataFrame:
    """Default descriptive label: 'Cluster <id>: r=<r>, f=<f>, m=<m>'."""
    # Fixed value: the text of the label is a required output format.
    return levels.withColumn("label", F.concat(
        F.lit("Cluster "), F.col("cluster").cast("string"), F.lit(": r="), F.col("r_bin").cast("string"),
        F.lit(", f="), F.col("f_bin").cast("string"), F.lit(", m="), F.col("m_bin").cast("string")))


def segment_labels(assigned: DataFrame, centroids: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Label table for the segments present in ``assigned``: levels, default
    label text and (optionally) a user name joined on the cluster id."""
    present = assigned.where(F.col("cluster").isNotNull()).select("cluster").distinct()
    out = label_text(centroid_levels(centroids)).join(present, "cluster")
    if names is not None:
        out = out.join(names.dropDuplicates(["cluster"]), "cluster", "left")
    return out


def map_labels(df: DataFrame, names: dict[int, str], col: str = "Cluster",
               out: str = "ClusterNames") -> DataFrame:
    """Name lookup through a literal map column; an unknown id gives null."""
    m = F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(int(k)), F.lit(v))])
    return df.withColumn(out, F.try_element_at(m, F.col(col)))


# ----------------------------------------------------------------------------
# joins back to customers and orders
# ----------------------------------------------------------------------------
def orders_with_segment(silver: DataFrame, assigned: DataFrame) -> DataFrame:
    """Order lines (or whole orders, which are fewer: any rows with a
    CustomerID) + the customer's segment and favourite-category metrics.

    ``assigned`` has one row per customer, so the left join cannot fan out; a
    null CustomerID never matches and its lines skip the shuffle
    (``left_lookup``). Both keys are strings."""
    right = assigned.select(F.col("CustomerID").cast("string").alias("CustomerID"),
                            F.col("cluster").alias("Cluster"), "Recency", "Frequency", "MonetaryValue")
    return left_lookup(silver.withColumn("CustomerID", F.col("CustomerID").cast("string")), right, "CustomerID",
                       salt_cols=[c for c in LINE_SALT if c in silver.columns] or None)


def audience_export(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per customer: id, segment, label, favourite category."""
    return (assigned.select("CustomerID", "cluster", "FavoriteCategoryID", "FavoriteCategoryName")
            .join(labels.select("cluster", "label").dropDuplicates(["cluster"]), "cluster", "left"))


# ----------------------------------------------------------------------------
# segment reports
# ----------------------------------------------------------------------------
def _customer_segments(assigned: DataFrame) -> DataFrame:
    return assigned.where(F.col("CustomerID").isNotNull() & F.col("cluster").isNotNull()).select(
        F.col("CustomerID").cast("string").alias("_customer"), F.col("cluster").alias("Cluster"))


def segment_profile(assigned: DataFrame, sales: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """Per segment: customers, share of customers, mean R/F/M (rounded to
    ``digits`` so the figures do not depend on summation order) and, given
    ``sales`` (``group_totals``: one row per customer and category), revenue
    (positive sales, exact decimal) and revenue share. Sales meet the segments
    at customer grain: no order line is read or shuffled again."""
    w = Window.partitionBy()  # over the per-segment rows only (one per segment)
    g = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg(F.col("Recency").cast("double")), digits).alias("avg_recency"),
        F.round(F.avg(F.col("Frequency").cast("double")), digits).alias("avg_frequency"),
        F.round(F.avg("MonetaryValue"), digits).alias("avg_monetary"))
    g = g.withColumn("customer_share", F.round(F.col("customers") / F.sum("customers").over(w), digits))
    if sales is None:
        return g
    per = sales.where(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(F.sum("_total").alias("total"))
    rev = (per.join(_customer_segments(assigned), F.col("CustomerID").cast("string") == F.col("_customer"))
           .groupBy(F.col("Cluster").alias("cluster")).agg(F.sum("total").cast("decimal(38,2)").alias("revenue")))
    g = g.join(rev, "cluster", "left")
    total = F.sum("revenue").over(w).cast("double")
    return g.withColumn("revenue_share", F.round(F.col("revenue").cast("double") / total, digits))


def segment_top_categories(assigned: DataFrame, sales: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` categories per segment by positive sales (ties: lower id),
    from ``sales`` (``group_totals``) at customer grain."""
    g = (sales.where(F.col("CustomerID").isNotNull())
         .join(_customer_segments(assigned), F.col("CustomerID").cast("string") == F.col("_customer"))
         .groupBy("Cluster", "ProductCategoryID", "ProductCategoryName")
         .agg(F.sum("_total").cast("decimal(38,2)").alias("Sales")))
    w = Window.partitionBy("Cluster").orderBy(F.col("Sales").desc(), F.col("ProductCategoryID").asc_nulls_last(),
                                              F.col("ProductCategoryName").asc_nulls_last())
    return g.withColumn("category_rank", F.row_number().over(w)).where(F.col("category_rank") <= n)


def segment_bin_counts(assigned: DataFrame) -> DataFrame:
    """Segment x bin contingency counts: (cluster, metric, level, n)."""
    s = assigned.selectExpr("cluster", "stack(3, 'r_bin', r_bin, 'f_bin', f_bin, 'm_bin', m_bin) AS (metric, level)")
    return s.groupBy("cluster", "metric", "level").agg(F.count(F.lit(1)).alias("n"))


def principal_axes(cells: DataFrame) -> list[list[float]]:
    """The two leading principal axes of the bin vectors, from weighted cells
    (``bin_cells``): one aggregation to ten sums, exact in integers. The entry
    of an axis with the largest size is positive (ties: the first)."""
    from itertools import combinations_with_replacement as pairs
    w = F.col("w").cast("decimal(18,0)")
    row = cells.agg(F.sum(w), *[F.sum(w * F.col(c)) for c in BIN_COLS],
                    *[F.sum(w * (F.col(c) * F.col(d))) for c, d in pairs(BIN_COLS, 2)]).first()
    if not row[0]:
        return [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]
    n, first, second = int(row[0]), [int(x) for x in row[1:4]], [int(x) for x in row[4:]]
    spread = np.zeros((3, 3))
    for (i, j), total in zip(pairs(range(3), 2), second):
        spread[i, j] = spread[j, i] = (n * total - first[i] * first[j]) / (n * n)
    value, axes = np.linalg.eigh(spread)
    out = []
    for k in np.argsort(-value)[:2]:
        v = axes[:, k]
        out.append((v * np.sign(v[np.abs(v).round(9).argmax()])).tolist())
    return out


def segment_projection(assigned: DataFrame, id_col: str = "CustomerID") -> DataFrame:
    """2-D projection of the bin vectors for plotting: the two leading
    principal axes of the weighted cells, applied per row as plain columns.
    (CustomerID, x, y), six decimals; a row with a null bin keeps its place,
    with null x and y."""
    def along(axis: list[float]):
        return F.round(sum((F.col(c) * F.lit(v) for c, v in zip(BIN_COLS, axis)), F.lit(0.0)), 6) + F.lit(0.0)

    x, y = principal_axes(bin_cells(assigned))
    return assigned.select(id_col, along(x).alias("x"), along(y).alias("y"))


def customer_sample(df: DataFrame, fraction: float, seed: int = 42, key: str = "CustomerID") -> DataFrame:
    """Sample of customers (for plots / training on very large inputs): a
    customer is in when a seeded hash of its id falls below ``fraction``.
    Unlike ``DataFrame.sample`` the choice does not depend on row order, so a
    recomputed partition (lost executor, retry) selects the same rows, and all
    rows of a customer are kept or dropped together."""
    part = F.conv(F.substring(F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col(key).cast("string")).cast("binary")), 1, 6), 16, 10)
    return df.where(part.cast("long") % 10_000 < F.lit(int(round(fraction * 10_000))))


def k_candidates(cells: DataFrame, max_k: int) -> DataFrame:
    """Candidate k values 2..max_k (column ``k``) and whether the cells allow
    them (``possible``): k must not exceed the number of distinct cells."""
    count = cells.agg(F.count(F.lit(1)).alias("cells"))
    return count.select(F.explode(F.sequence(F.lit(2).cast("long"), F.lit(max_k).cast("long"))).alias("k"), "cells").select(
        "k", (F.col("k") <= F.col("cells")).alias("possible"))
