"""Quantile / uniform binning with ordinal output (0 .. n_bins-1).

Semantics (documented public behaviour of the classic ordinal discretizer):
edges are the n_bins+1 quantiles (or an even grid from min to max); an edge
not more than 1e-8 above its predecessor is dropped; the bin of x is the
number of *inner* kept edges <= x, so a value on an edge goes up, values
outside the fitted range land in the first/last bin, and a constant column
gives a single bin 0. Fewer than n_bins levels can therefore occur.

Fitting is one distributed pass (exact quantiles, see ``quantiles``); the
edges -- at most n_bins+1 numbers per metric -- become literals in the
transform, which is a plain codegen'd projection.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import approx_quantiles, exact_quantiles, exact_quantiles_many

EDGE_TOL = 1e-8

# Default inputs of the three RFM bins: recency is scored negated so that a
# higher bin always means a better customer.
RFM_INPUTS = {"r_bin": "-Recency", "f_bin": "Frequency", "m_bin": "MonetaryValue"}


def kept_edges(edges: list[float]) -> list[float]:
    if not edges:
        return []
    return [edges[0]] + [e for prev, e in zip(edges, edges[1:]) if e - prev > EDGE_TOL]


def inner_edges(edges: list[float]) -> list[float]:
    k = kept_edges(edges)
    return k[1:-1]


def bin_column(x: Column, edges: list[float] | None) -> Column:
    """Ordinal bin of ``x`` for the fitted ``edges`` (null stays null)."""
    inner = inner_edges(edges or [])
    if not inner:
        return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(F.lit(0))
    total = None
    for e in inner:
        term = (x >= F.lit(float(e))).cast("int")
        total = term if total is None else total + term
    return total


def uniform_edges(df: DataFrame, cols: list[str], n_bins: int) -> dict[str, list[float] | None]:
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{i}")
                   for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out: dict[str, list[float] | None] = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
        if lo is None:
            out[c] = None
            continue
        step = (hi - lo) / n_bins
        out[c] = [j * step + lo for j in range(n_bins)] + [hi]
    return out


@dataclass
class BinnerModel:
    """Fitted edges per output column; ``inputs`` maps output -> SQL expr."""
    inputs: dict[str, str]
    edges: dict[str, list[float] | None]
    n_bins: int
    strategy: str = "quantile"

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({out: bin_column(F.expr(expr), self.edges.get(out))
                               for out, expr in self.inputs.items()})

    def edges_frame(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Long table (metric, i, edge) plus kept flag -- what a model stores."""
        rows = []
        for out, es in self.edges.items():
            for i, e in enumerate(es or []):
                kept = i == 0 or e - es[i - 1] > EDGE_TOL
                rows.append((version, out, i, float(e), kept))
        schema = T.StructType([
            T.StructField("version", T.IntegerType(), True),
            T.StructField("metric", T.StringType(), False),
            T.StructField("i", T.IntegerType(), False),
            T.StructField("edge", T.DoubleType(), False),
            T.StructField("kept", T.BooleanType(), False),
        ])
        return spark.createDataFrame(rows, schema)

    def to_json(self) -> str:
        return json.dumps({"inputs": self.inputs, "edges": self.edges,
                           "n_bins": self.n_bins, "strategy": self.strategy})

    @staticmethod
    def from_json(s: str) -> "BinnerModel":
        d = json.loads(s)
        return BinnerModel(d["inputs"], d["edges"], d["n_bins"], d.get("strategy", "quantile"))


@dataclass
class QuantileBinner:
    """Estimator: ``fit(df) -> BinnerModel``.

    strategy='quantile' (exact, distributed) | 'uniform'; approx=True swaps
    the exact selection for a ``percentile_approx`` sketch (very large data,
    documented as different: no interpolation, rank error <= n/accuracy)."""
    inputs: dict[str, str] = field(default_factory=lambda: dict(RFM_INPUTS))
    n_bins: int = 5
    strategy: str = "quantile"
    approx: bool = False
    accuracy: int = 10000

    def fit(self, df: DataFrame) -> BinnerModel:
        outs = list(self.inputs)
        proj = df.select([F.expr(e).alias(o) for o, e in self.inputs.items()])
        if self.strategy == "uniform":
            edges = uniform_edges(proj, outs, self.n_bins)
        elif self.strategy == "quantile":
            probs = [j / self.n_bins for j in range(self.n_bins + 1)]
            q = (approx_quantiles(proj, outs, probs, self.accuracy) if self.approx
                 else exact_quantiles(proj, outs, probs))
            edges = {o: (None if v[0] is None else v) for o, v in q.items()}
        else:
            raise ValueError(f"unknown strategy {self.strategy}")
        return BinnerModel(dict(self.inputs), edges, self.n_bins, self.strategy)


def fit_edges(df: DataFrame, inputs: dict[str, str] | None = None, n_bins: int = 5,
              strategy: str = "quantile", approx: bool = False) -> BinnerModel:
    return QuantileBinner(dict(inputs or RFM_INPUTS), n_bins, strategy, approx).fit(df)


def apply_edges(df: DataFrame, model: BinnerModel) -> DataFrame:
    return model.transform(df)


def fit_edges_many(frames: list[DataFrame], inputs: dict[str, str] | None = None, n_bins: int = 5) -> list[BinnerModel]:
    """Exact quantile binners for several frames in one job (e.g. the gold
    edges on all rows and the model edges on the favourites)."""
    inputs = dict(inputs or RFM_INPUTS)
    outs = list(inputs)
    probs = [j / n_bins for j in range(n_bins + 1)]
    projs = [(df.select([F.expr(e).alias(o) for o, e in inputs.items()]), outs) for df in frames]
    res = exact_quantiles_many(projs, probs)
    return [BinnerModel(dict(inputs), {o: (None if v[0] is None else v) for o, v in r.items()}, n_bins)
            for r in res]
