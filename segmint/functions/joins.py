"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Order-line columns that identify a line well enough to spread null keys.
LINE_SALT = ["InvoiceNo", "StockCode", "Quantity", "SalesAmount"]


def split_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "left") -> DataFrame:
    """Equi-join whose hot keys AQE can split.

    AQE splits a skewed join only when each input is an exchange made for this
    join. A right side that is an aggregate or a window over the key is already
    partitioned by it, gets no exchange of its own, and a hot key then stays in
    one task. A second equality on a hash of the key changes no result but asks
    for a partitioning by both, so both sides get their own exchange (or, when
    the right side turns out small, are broadcast). The key stays provably
    unique for Catalyst, so an unused left lookup is still removed."""
    return left.join(right, (left_key == right_key) & (F.xxhash64(left_key) == F.xxhash64(right_key)), how)


def left_lookup(left: DataFrame, right: DataFrame, key: str, salt_cols: list[str] | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` in one pass, safe for a hot null key.

    A null key never matches, but in a plain shuffle join every null-key row
    hashes to the same reducer -- and the null key (anonymous customers,
    missing descriptions) may hold a large share of all rows. Here the join
    is on ``coalesce(key, row hash)`` and a hash of it with the key's null flag: null-key rows get a
    distinct salt (a hash of the row), so they spread over all partitions,
    and their ``true`` flag can never meet the right side's ``false``. A hot
    real key is split by AQE, as in ``split_join``.

    The salt must be a deterministic function of the row (a recomputed map
    task must send each row to the same reducer); ``salt_cols`` names a few
    cheap columns that vary between rows, so the salt does not keep every
    left column alive (all columns by default).
    """
    rcols = [c for c in right.columns if c != key]
    salt = F.xxhash64(*[F.col(c) for c in (salt_cols or left.columns)]).cast("string")
    lk = left.withColumns({
        "_lk_null": F.col(key).isNull(),
        "_lk": F.when(F.col(key).isNull(), salt).otherwise(F.col(key).cast("string")),
    })
    rk = right.select(F.col(key).cast("string").alias("_rk"), *rcols)
    on = (F.col("_lk") == F.col("_rk")) & (F.xxhash64("_lk", "_lk_null") == F.xxhash64("_rk", F.col("_rk").isNull()))
    return lk.join(rk, on, "left").select(*left.columns, *[rk[c] for c in rcols])
