"""Connected components of an edge table by alternating large and small stars,
wholly as Spark joins and sums; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release, written, written_since


def _with_minimum(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with m, the least of u and all its v. The minima are
    written first: read back, the join has an exchange of its own on either
    side, so that AQE can split a node with very many neighbours."""
    low = materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
    return pairs.join(low, "u").withColumn("m", F.least("m", "u"))


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns x, y of one type);
    root is the smallest node of the component. Each round's edges are written
    to the shared folder, so a lost executor repeats one round at most."""
    spark, a, b = edges.sparkSession, F.col("x"), F.col("y")
    start = written(spark)
    e = materialize(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    mark = None
    for _ in range(max_rounds):
        # Large star: each neighbour above u hangs on the least around u.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = _with_minimum(both)
        big = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        big = materialize(big, "cc-large")
        # Small star: u and its smaller neighbours hang on the least of them.
        joined = _with_minimum(big)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        new = materialize(small, "cc-small")
        got = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        done = mark == (got["n"], got["h"])
        mark, e = (got["n"], got["h"]), new
        before = written_since(spark, start)[:-1]
        if before:  # this round's edges replace all that came before
            release(spark, *before)
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
