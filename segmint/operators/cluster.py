"""Customer segments: k-means on the (r_bin, f_bin, m_bin) ordinals.

The clustered points are three small ordinals, so at most n_bins**3 distinct
points exist however many customers there are. k-means inertia and the mean
silhouette over rows equal the same quantities over the *distinct cells
weighted by their row counts*. So one distributed ``groupBy(cells).count()``
summarises any number of customers, and the expensive part -- many random
restarts for every k -- runs as independent Spark tasks over (k, restart)
pairs, each on the <= n_bins**3 weighted cells shipped in the task closure.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .binning import BinnerModel

BIN_COLS = ["r_bin", "f_bin", "m_bin"]


# ----------------------------------------------------------------------------
# cells
# ----------------------------------------------------------------------------
def bin_cells(df: DataFrame, cols: list[str] = BIN_COLS, extra: list[str] | None = None) -> DataFrame:
    """(r_bin, f_bin, m_bin, w): distinct cells with their row counts, and the
    columns in ``extra``, which must depend on the cell alone. Rows with a null
    in any bin belong to no cell."""
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull()
    return df.where(whole).groupBy(*cols, *(extra or [])).agg(F.count(F.lit(1)).alias("w"))


def silhouette_of_cells(cells: DataFrame, digits: int = 9) -> DataFrame:
    """One row (silhouette, customers, cells) for cells with their ``cluster``
    and weight ``w``: the mean Euclidean silhouette over the rows they stand
    for. The cells are gathered in one row (at most n_bins**3, whatever the
    data) and exploded against themselves, so no join is needed."""
    one = cells.agg(F.collect_list(F.struct(*BIN_COLS, "cluster", "w")).alias("all"))
    pair = one.select(F.explode("all").alias("i"), "all").select("i", F.explode("all").alias("j"))
    gap = F.sqrt(sum(((F.col(f"i.{c}") - F.col(f"j.{c}")).cast("double") ** 2 for c in BIN_COLS), F.lit(0.0)))
    to = pair.groupBy("i", F.col("j.cluster").alias("cj")).agg(
        F.sum(F.col("j.w") * gap).alias("s"), F.sum("j.w").alias("size"))
    own = F.col("cj") == F.col("i.cluster")
    ab = to.groupBy("i").agg(
        F.max(F.when(own, F.col("s") / F.nullif(F.col("size") - 1, F.lit(0)))).alias("a"),
        F.max(F.when(own, F.col("size"))).alias("n"), F.min(F.when(~own, F.col("s") / F.col("size"))).alias("b"))
    score = F.when(F.col("n") <= 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    w = F.col("i.w")
    return ab.agg(F.round(F.sum(w * score) / F.sum(w), digits).alias("silhouette"), F.sum(w).alias("customers"),
                  F.count(F.lit(1)).cast("int").alias("cells"))


def collect_cells(cells: DataFrame, n_bins: int, cols: list[str] = BIN_COLS):
    """Bring the cells to the driver: at most n_bins**3 rows by construction
    (every bin is an integer in [0, n_bins)); checked, never data-sized."""
    limit = n_bins ** len(cols)
    rows = cells.orderBy(*cols).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} cells: bins outside [0, {n_bins})")
    X = np.array([[float(r[c]) for c in cols] for r in rows], dtype=float).reshape(-1, len(cols))
    w = np.array([float(r["w"]) for r in rows], dtype=float)
    return X, w


# ----------------------------------------------------------------------------
# weighted Lloyd with random init
# ----------------------------------------------------------------------------
def _sqdist(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    return ((X[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)


def weighted_kmeans(X: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator,
                    max_iter: int = 300, tol: float = 1e-4):
    """One restart: init = k distinct cells drawn with probability ∝ weight;
    ties in assignment go to the lowest centre; an emptied centre is moved to
    the cell farthest from its centre. Returns (inertia, centres)."""
    n = len(X)
    if k > n:
        raise ValueError(f"k={k} exceeds the {n} distinct cells")
    mean = np.average(X, axis=0, weights=w)
    var = np.average((X - mean) ** 2, axis=0, weights=w).mean()
    tol_abs = tol * var
    C = X[rng.choice(n, size=k, replace=False, p=w / w.sum())].copy()
    labels = None
    for _ in range(max_iter):
        d2 = _sqdist(X, C)
        new_labels = d2.argmin(axis=1)
        W = np.bincount(new_labels, weights=w, minlength=k)
        sums = np.stack([np.bincount(new_labels, weights=w * X[:, j], minlength=k)
                         for j in range(X.shape[1])], axis=1)
        nz = W > 0
        newC = np.empty_like(C)
        newC[nz] = sums[nz] / W[nz][:, None]
        if not nz.all():
            far = np.argsort(-d2[np.arange(n), new_labels], kind="stable")
            for c, idx in zip(np.flatnonzero(~nz), far):
                newC[c] = X[idx]
        shift = ((newC - C) ** 2).sum()
        C = newC
        if (labels is not None and np.array_equal(labels, new_labels)) or shift <= tol_abs:
            labels = new_labels
            break
        labels = new_labels
    d2 = _sqdist(X, C)
    inertia = float((w * d2.min(axis=1)).sum())
    return inertia, C


def weighted_kmeans_batch(X: np.ndarray, w: np.ndarray, k: int, restarts: int, rng: np.random.Generator,
                          max_iter: int = 300, tol: float = 1e-4):
    """``restarts`` runs of ``weighted_kmeans`` at once, as one tensor: the
    best inertia, its number and centres. Runs that have settled drop out of
    the tensor; the same rules hold for ties and emptied centres."""
    n, d = X.shape
    if k > n:
        raise ValueError(f"k={k} exceeds the {n} distinct cells")
    var = np.average((X - np.average(X, axis=0, weights=w)) ** 2, axis=0, weights=w).mean()
    # k distinct cells, each drawn in proportion to the weights left: the k
    # largest of log w plus Gumbel noise.
    draw = np.argsort(-(np.log(w) + rng.gumbel(size=(restarts, n))), axis=1)[:, :k]
    C = X[draw]
    x2 = (X ** 2).sum(1)

    def distances(c):
        return np.maximum(0.0, x2[None, :, None] - 2 * (c @ X.T).transpose(0, 2, 1) + (c ** 2).sum(2)[:, None, :])

    live, last = np.arange(restarts), np.full((restarts, n), -1)
    for _ in range(max_iter):
        c = C[live]
        d2 = distances(c)
        lab = d2.argmin(2)
        hot = (lab[:, :, None] == np.arange(k)) * w[None, :, None]
        size = hot.sum(1)
        new = hot.transpose(0, 2, 1) @ X / np.where(size > 0, size, 1)[:, :, None]
        for r, e in zip(*np.nonzero(size == 0)):  # the farthest cells take the place of emptied centres
            far = np.argsort(-d2[r, np.arange(n), lab[r]], kind="stable")
            new[r, e] = X[far[int((size[r, :e] == 0).sum())]]
        shift = ((new - c) ** 2).sum((1, 2))
        done = (lab == last[live]).all(1) | (shift <= tol * var)
        C[live], last[live] = new, lab
        live = live[~done]
        if not len(live):
            break
    inertia = (distances(C).min(2) * w).sum(1)
    best = int(np.argmin(np.round(inertia, 9)))
    return float((w * _sqdist(X, C[best]).min(1)).sum()), best, C[best]


def assign_cells(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Nearest centre per cell; ties go to the lowest cluster id."""
    return _sqdist(X, C).argmin(axis=1)


def weighted_silhouette(X: np.ndarray, w: np.ndarray, labels: np.ndarray) -> float:
    """Mean Euclidean silhouette over rows, computed on weighted cells.

    a(i): mean distance to the other rows of its cluster (copies in the same
    cell are at 0; a cluster of one row scores 0); b(i): smallest mean
    distance to another cluster's rows."""
    ks = np.unique(labels)
    if len(ks) < 2:
        return float("nan")
    D = np.sqrt(_sqdist(X, X))
    S = np.stack([(D[:, labels == c] * w[labels == c]).sum(axis=1) for c in ks], axis=1)
    Wc = np.array([w[labels == c].sum() for c in ks])
    own = np.searchsorted(ks, labels)
    n_own = Wc[own] - 1.0
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(n_own > 0, S[np.arange(len(X)), own] / np.where(n_own > 0, n_own, 1), 0.0)
        mean_other = S / Wc[None, :]
        mean_other[np.arange(len(X)), own] = np.inf
        b = mean_other.min(axis=1)
        s = (b - a) / np.maximum(a, b)
    s = np.where(n_own > 0, np.nan_to_num(s), 0.0)
    return float((w * s).sum() / w.sum())


def canonical_order(C: np.ndarray) -> np.ndarray:
    """Stable cluster ids: centres sorted by (r+f+m desc, r desc, f desc, m desc)."""
    keys = [-C[:, j] for j in reversed(range(C.shape[1]))] + [-C.sum(axis=1)]
    return np.lexsort(keys)


# ----------------------------------------------------------------------------
# distributed restarts
# ----------------------------------------------------------------------------
_RESTART_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType(), False),
    T.StructField("restart", T.LongType(), False),
    T.StructField("inertia", T.DoubleType(), False),
    T.StructField("centers", T.ArrayType(T.DoubleType()), False),
])


BATCH = 250  # restarts that a task runs as one tensor


def _restarts(spark: SparkSession, X, w, ks: list[int], restarts: int, seed: int) -> DataFrame:
    """The best of every batch of restarts: one row per (k, batch)."""
    from ..session import ship_package
    ship_package(spark)
    batches_per_k = -(-restarts // BATCH)
    total = len(ks) * batches_per_k
    parts = max(1, min(total, spark.sparkContext.defaultParallelism * 2))
    # Neighbouring ids are different k, so the costly ones are spread out.
    tasks = spark.range(0, total, numPartitions=parts).select(
        F.element_at(F.array(*[F.lit(int(k)) for k in ks]), (F.col("id") % len(ks)).cast("int") + 1).alias("k"),
        F.floor(F.col("id") / len(ks)).alias("batch"))
    Xc, wc = X.copy(), w.copy()

    def run(batches):
        for pdf in batches:
            out = []
            for k, b in zip(pdf["k"].to_numpy(), pdf["batch"].to_numpy()):
                n = min(BATCH, restarts - int(b) * BATCH)
                rng = np.random.default_rng([int(seed), int(k), int(b)])
                inertia, at, C = weighted_kmeans_batch(Xc, wc, int(k), n, rng)
                out.append((int(k), int(b) * BATCH + at, inertia, C.reshape(-1).tolist()))
            yield pd.DataFrame(out, columns=["k", "restart", "inertia", "centers"])

    return tasks.mapInPandas(run, _RESTART_SCHEMA)


def best_per_k(restart_rows: DataFrame) -> DataFrame:
    """Lowest inertia per k (ties: lowest restart number)."""
    return restart_rows.groupBy("k").agg(
        F.min_by(F.struct("inertia", "restart", "centers"),
                 F.struct("inertia", "restart")).alias("b")).select(
        "k", "b.inertia", "b.restart", "b.centers")


def k_sweep(cells: DataFrame, n_bins: int, ks: list[int] | None = None, restarts: int = 10_000,
            seed: int = 42) -> DataFrame:
    """(k, inertia, silhouette) for every k asked for: best of ``restarts``
    random-init runs, silhouette of that best model. Restarts are spread over
    tasks. A k beyond the number of distinct cells has no model: its row has
    nulls."""
    spark = cells.sparkSession
    X, w = collect_cells(cells, n_bins)
    ks = list(ks or range(2, 21))
    able = [k for k in ks if k <= len(X)]
    if not able:
        raise ValueError(f"every k exceeds the {len(X)} distinct (r_bin, f_bin, m_bin) cells")
    best = best_per_k(_restarts(spark, X, w, able, restarts, seed))
    Xc, wc, d = X.copy(), w.copy(), X.shape[1]
    schema = T.StructType([T.StructField("k", T.LongType(), False),
                           T.StructField("inertia", T.DoubleType(), True),
                           T.StructField("silhouette", T.DoubleType(), True)])

    def score(batches):
        for pdf in batches:
            rows = []
            for k, inertia, cs in zip(pdf["k"], pdf["inertia"], pdf["centers"]):
                C = np.asarray(cs, dtype=float).reshape(-1, d)
                rows.append((int(k), float(inertia), weighted_silhouette(Xc, wc, assign_cells(Xc, C))))
            yield pd.DataFrame(rows, columns=["k", "inertia", "silhouette"])

    scored = best.mapInPandas(score, schema)
    rest = [(int(k), None, None) for k in ks if k > len(X)]
    return scored.union(spark.createDataFrame(rest, schema)) if rest else scored


def choose_k(sweep: DataFrame, override: int | None = None, min_gain: float = 0.01) -> int:
    """Elbow rule on the sweep (<= 19 rows): the largest k before the
    silhouette gain per added cluster first drops below ``min_gain``."""
    if override is not None:
        return int(override)
    rows = k_choice(sweep, min_gain).where(F.col("chosen")).select("k").collect()
    return int(rows[0]["k"]) if rows else int(sweep.agg(F.max("k")).first()[0])


def k_choice(sweep: DataFrame, min_gain: float = 0.01) -> DataFrame:
    """Sweep with ``gain`` = silhouette(k+1) - silhouette(k) (window lead) and
    ``chosen`` marking the first k whose next gain falls below ``min_gain``.
    The window has no partition key on purpose: the sweep is one row per k."""
    from pyspark.sql import Window
    w = Window.orderBy("k")
    low = F.col("gain") < min_gain
    return (sweep.withColumn("gain", F.lead("silhouette").over(w) - F.col("silhouette"))
            .withColumn("_lows", F.sum(F.when(low, 1).otherwise(0)).over(
                w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("chosen", F.coalesce(low & (F.col("_lows") == 1), F.lit(False)))
            .drop("_lows"))


# ----------------------------------------------------------------------------
# the model
# ----------------------------------------------------------------------------
@dataclass
class SegmentModel:
    binner: BinnerModel
    centroids: list[tuple[int, float, float, float]]
    version: int | None = None
    meta: dict = field(default_factory=dict)

    @property
    def n_bins(self) -> int:
        return self.binner.n_bins

    def centers(self) -> np.ndarray:
        return np.array([c[1:] for c in sorted(self.centroids)], dtype=float)

    def centroids_frame(self, spark: SparkSession) -> DataFrame:
        from ..schemas import CENTROIDS
        return spark.createDataFrame([(int(c), float(r), float(f), float(m)) for c, r, f, m in self.centroids],
                                     CENTROIDS)

    def cell_map(self, spark: SparkSession) -> DataFrame:
        """Cluster of every grid cell (n_bins**3 rows, built on the driver from
        the model alone) -- scoring becomes an equi-join on the three bins."""
        n = self.n_bins
        grid = np.array([(r, f, m) for r in range(n) for f in range(n) for m in range(n)], dtype=float)
        lab = assign_cells(grid, self.centers())
        ids = [c[0] for c in sorted(self.centroids)]
        rows = [(int(a), int(b), int(c), int(ids[l])) for (a, b, c), l in zip(grid, lab)]
        schema = T.StructType([T.StructField(b, T.IntegerType(), False) for b in BIN_COLS]
                              + [T.StructField("cluster", T.IntegerType(), False)])
        return spark.createDataFrame(rows, schema)

    def assign(self, df: DataFrame, binned: bool = False) -> DataFrame:
        """Add bins (with the model's edges) unless ``binned``, then ``cluster``.
        The cell map is n_bins**3 rows (a proven bound), so it is broadcast."""
        out = df if binned else self.binner.transform(df)
        return out.join(F.broadcast(self.cell_map(df.sparkSession)), BIN_COLS, "left")

    def score(self, df: DataFrame, out_col: str = "Cluster") -> DataFrame:
        """Add only ``out_col``: the model's bins are computed into temporary
        columns, so rows keep their own (e.g. gold) bins untouched."""
        from .binning import bin_column
        tmp = {b: f"_model_{b}" for b in BIN_COLS}
        binned = df.withColumns({tmp[o]: bin_column(F.expr(e), self.binner.edges.get(o))
                                 for o, e in self.binner.inputs.items()})
        cm = self.cell_map(df.sparkSession).select(*[F.col(b).alias(tmp[b]) for b in BIN_COLS],
                                                   F.col("cluster").alias(out_col))
        return binned.join(F.broadcast(cm), list(tmp.values()), "left").drop(*tmp.values())

    def to_json(self) -> str:
        return json.dumps({"binner": json.loads(self.binner.to_json()),
                           "centroids": self.centroids, "version": self.version, "meta": self.meta})

    @staticmethod
    def from_json(s: str) -> "SegmentModel":
        d = json.loads(s)
        return SegmentModel(BinnerModel.from_json(json.dumps(d["binner"])),
                            [tuple(c) for c in d["centroids"]], d.get("version"), d.get("meta", {}))


def fit_segments(favorites: DataFrame, k: int = 8, restarts: int = 10_000, seed: int = 42,
                 n_bins: int = 5, inputs: dict[str, str] | None = None,
                 binner: BinnerModel | None = None) -> SegmentModel:
    """Re-bin ``favorites`` (the model's own edges -- fitted here unless a
    ``binner`` fitted on the same favourites is given), then the best of
    ``restarts`` weighted k-means runs on the cells, with canonical ids."""
    from .binning import QuantileBinner, RFM_INPUTS
    if binner is None:
        binner = QuantileBinner(dict(inputs or RFM_INPUTS), n_bins).fit(favorites)
    n_bins = binner.n_bins
    cells = bin_cells(binner.transform(favorites))
    spark = favorites.sparkSession
    X, w = collect_cells(cells, n_bins)
    if k > len(X):
        raise ValueError(f"k={k} exceeds the {len(X)} distinct (r_bin, f_bin, m_bin) cells")
    best = best_per_k(_restarts(spark, X, w, [k], restarts, seed)).first()
    C = np.asarray(best["centers"], dtype=float).reshape(k, -1)
    order = canonical_order(C)
    cents = [(i, *map(float, C[j])) for i, j in enumerate(order)]
    return SegmentModel(binner, cents, meta={"k": k, "restarts": restarts, "seed": seed,
                                             "inertia": float(best["inertia"])})


def assign_segment(df: DataFrame, model: SegmentModel) -> DataFrame:
    """Bins (model edges) and ``cluster`` for every row of ``df``."""
    return model.assign(df)


def silhouette(cells: DataFrame, model: SegmentModel, n_bins: int | None = None) -> float:
    """Mean silhouette over the rows summarised by ``cells`` (r_bin, f_bin,
    m_bin, w) for ``model``'s assignment, computed on the weighted cells."""
    X, w = collect_cells(cells, n_bins or model.n_bins)
    return weighted_silhouette(X, w, assign_cells(X, model.centers()))
