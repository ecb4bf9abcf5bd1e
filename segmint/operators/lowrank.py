"""Principal components of sparse rows without a dense covariance matrix.

Randomised range finder with power steps: tasks return their part of
``X'W(X Q)`` for a thin matrix Q (W: row weights), rounds of sums of at most
``FAN`` parts each combine them, and the driver orthogonalises a matrix of
``width`` x (k + margin), whatever the number of rows. Centring is applied to
the products: (X - m)'W(X - m) Q = X'W(X Q) - n m (m'Q), n the sum of weights."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MARGIN = 16
POWER_STEPS = 4
FAN = 16  # parts that one group adds up in a round
ENTRIES = 1 << 16  # entries of the sparse rows that one product takes


def sum_parts(parts: DataFrame, count: int | None = None) -> np.ndarray:
    """Sum of equally long arrays (slot from 0, data: bytes of doubles) in
    rounds: each adds groups of FAN neighbouring slots, until one is left.
    ``count`` is the number of slots; without it the parts are written and
    their slots looked up."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > FAN:
            raise ValueError(f"{len(rows)} parts in one group")
        total = sum(np.frombuffer(x) for x in rows.sort_values("slot")["data"])
        return pd.DataFrame({"slot": [rows["slot"].iloc[0] // FAN], "data": [total.tobytes()]})

    if count is None:
        parts = materialize(parts, "lowrank-parts")
        count = (parts.agg(F.max("slot")).first()[0] or 0) + 1
    last = count - 1
    while last > 0:
        parts = parts.groupBy(F.floor(F.col("slot") / FAN).alias("g")).applyInPandas(add, "slot int, data binary")
        last //= FAN
    got = parts.collect()
    return np.frombuffer(got[0]["data"]) if got else np.zeros(0)


def sparse_product(at: np.ndarray, value: np.ndarray, start: np.ndarray, weight: np.ndarray, q: np.ndarray, gram: bool) -> np.ndarray:
    """X'W(X Q), or (X Q)'W(X Q), of sparse rows: flat positions and values,
    where each row starts (no row is empty), and its weight."""
    y = np.add.reduceat(value[:, None] * q[at], start)
    if gram:
        return (y * weight[:, None]).T @ y
    size = np.diff(np.append(start, len(at)))
    parts = (value * np.repeat(weight, size))[:, None] * np.repeat(y, size, axis=0)
    order = np.argsort(at, kind="stable")
    column = at[order]
    edge = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
    out = np.zeros(q.shape)
    out[column[edge]] = np.add.reduceat(parts[order], edge)
    return out


def _product(rows: DataFrame, q: np.ndarray, gram: bool, count: int | None = None) -> np.ndarray:
    width = q.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = None
        for b in batches:
            ends = b["at"].offsets.to_numpy()
            at, value = b["at"].flatten().to_numpy(), b["value"].flatten().to_numpy()
            ends = ends - ends[0]
            weight, lo = b["weight"].to_numpy(), 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + ENTRIES, "right")) - 1)
                cut = slice(ends[lo], ends[hi])
                got = sparse_product(at[cut], value[cut], ends[lo:hi] - ends[lo], weight[lo:hi], q, gram)
                out, lo = got if out is None else out + got, hi
        if out is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([out.tobytes()], pa.binary())],
                                  names=["slot", "data"])

    total = sum_parts(rows.select("at", "value", "weight").mapInArrow(part, "slot int, data binary"), count)
    return total.reshape(-1, width) if len(total) else np.zeros((width, width) if gram else q.shape)


def sparse_rows(df: DataFrame, vector: str, weight: str | None = None) -> DataFrame:
    """(at, value, weight): positions and values of a column of ML vectors."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    v = df.select(F.unwrap_udt(F.col(vector)).alias("v"), w.alias("weight"))
    every = F.sequence(F.lit(0), F.size("v.values") - 1)
    dense = F.col("v.indices").isNull()
    return v.where(F.size("v.values") > 0).select(
        F.when(dense, every).otherwise(F.col("v.indices")).alias("at"), F.col("v.values").alias("value"), "weight")


def principal_components(df: DataFrame, vector: str, width: int, k: int, seed: int = 42, weight: str | None = None,
                         count: int | None = None) -> np.ndarray:
    """width x k matrix of the leading principal components of a column of ML
    vectors (signs: the largest entry of each is positive). A row of weight w
    counts as w equal rows. ``count``: the number of partitions of ``df``, if
    it is known."""
    if not 0 < k <= width:
        raise ValueError(f"k={k} components of {width} features")
    each = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    n = df.where(F.col(vector).isNotNull()).agg(F.sum(each)).first()[0] or 0.0
    rows = sparse_rows(df, vector, weight)
    flat = rows.select(F.explode(F.arrays_zip("at", "value")).alias("x"), "weight")
    sums = flat.groupBy("x.at").agg(F.sum(F.col("x.value") * F.col("weight")).alias("s")).collect()  # width rows at most
    mean = np.zeros(width)
    for r in sums:
        mean[r["at"]] = r["s"] / n
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, min(width, k + MARGIN))))[0]
    for _ in range(1 + POWER_STEPS):
        q = np.linalg.qr(_product(rows, q, False, count) - n * np.outer(mean, mean @ q))[0]
    small = _product(rows, q, True, count) - n * np.outer(mean @ q, mean @ q)
    value, vec = np.linalg.eigh(small)
    out = q @ vec[:, np.argsort(-value)[:k]]
    return out * np.sign(out[np.abs(out).argmax(0), np.arange(k)])


def project(vector: Column, components: np.ndarray) -> Column:
    """array<double>: an ML vector times the components."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for p in parts:
            out = []
            for at, value in zip(p["indices"], p["values"], strict=True):
                out.append((value @ (components if at is None else components[at])).tolist())
            yield pd.Series(out)

    v = F.unwrap_udt(vector)
    return F.pandas_udf(run, "array<double>")(F.struct(v["indices"].alias("indices"), v["values"].alias("values")))
