"""Hot keys are split, shared files are removed, the model store is safe, and
the batched and low-rank solvers equal plain ones."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint import session
from segmint.functions.joins import left_lookup, split_join
from segmint.operators.binning import BinnerModel
from segmint.operators.categorize import attach_category, tfidf_terms
from segmint.operators.cluster import (SegmentModel, bin_cells, k_sweep, silhouette_of_cells, weighted_kmeans,
                                       weighted_kmeans_batch, weighted_silhouette)
from segmint.operators.lowrank import principal_components, project
from segmint.operators.report import level_counts, orders_with_segment, segment_projection
from segmint.sources import model_store

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    """A session that splits small partitions, and lines of which half share
    one key, spread over several files."""
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    path = tempfile.mkdtemp() + "/lines"
    n = 40_000
    spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("key"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8).write.parquet(path)
    yield spark.read.parquet(path)
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ran(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregated_lookup_side_is_split(skewed):
    dim = skewed.groupBy("key").agg(F.max("pad").alias("top")).withColumnRenamed("key", "dk")
    plain = skewed.join(dim, F.col("key") == F.col("dk"), "left")
    better = split_join(skewed, dim, F.col("key"), F.col("dk"))
    assert "skew=true" not in ran(plain)
    assert "skew=true" in ran(better)
    assert better.count() == skewed.count()


def test_orders_with_segment_splits_a_hot_customer(skewed):
    lines = skewed.select(F.col("key").alias("CustomerID"), F.col("id").alias("InvoiceNo"), F.col("pad").alias("StockCode"),
                          F.lit(1).alias("Quantity"), F.lit(1.0).alias("SalesAmount"))
    seg = lines.groupBy("CustomerID").agg(F.lit(1).alias("cluster"), F.lit(1).alias("Recency"), F.lit(1).alias("Frequency"),
                                          F.lit(1.0).alias("MonetaryValue"))
    df = orders_with_segment(lines, seg)
    assert "skew=true" in ran(df) and df.where("Cluster is null").count() == 0


def test_tfidf_and_attach_category_split_a_hot_term(skewed):
    tok = skewed.select("id", F.col("key").alias("token"))
    assert "skew=true" in ran(tfidf_terms(skewed.select("id"), tok, "id"))
    lines = skewed.select(F.col("key").alias("Description"), "id", "pad")
    cats = lines.groupBy("Description").agg(F.lit(1).alias("ProductCategoryID"))
    labels = skewed.sparkSession.createDataFrame([(1, "a"), (1, "b")], "ProductCategoryID int, ProductCategoryName string")
    out = attach_category(lines, cats, labels)
    assert "skew=true" in ran(out) and out.count() == lines.count()  # a repeated label doesn't fan out


def test_left_lookup_real_key_never_meets_a_null_row(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    salt = left.where("k is null").select(F.xxhash64("k", "v").cast("string")).first()[0]
    right = spark.createDataFrame([(salt, 9), ("a", 7), (None, 5)], "k string, w int")
    got = {r.v: r.w for r in left_lookup(left, right, "k").collect()}
    assert got == {1: None, 2: 7}


def test_shared_folder_must_be_named_off_local_masters(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_written_tables_are_removed(spark):
    df = session.materialize(spark.range(5), "gone")
    path = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert os.path.exists(path)
    folder = [p for p in session._WRITTEN[spark.sparkContext.applicationId] if "/gone-" in p]
    session.release(spark, *folder)
    assert not os.path.exists(path)
    assert not [p for p in session._WRITTEN[spark.sparkContext.applicationId] if "/gone-" in p]


def test_threads_release_their_own_tables_only(spark):
    import threading
    mark, there, gone, kept = session.written(spark), threading.Event(), threading.Event(), []

    def other():
        mine = session.written(spark)
        kept.append(session.materialize(spark.range(3), "theirs"))
        session.materialize(spark.range(3), "theirs-too")
        there.set()
        gone.wait(60)
        session.release_since(spark, mine, keep=("theirs",))

    t = threading.Thread(target=other)
    t.start()
    assert there.wait(60)
    own = session.materialize(spark.range(4), "own")
    left = session.materialize(spark.range(5), "left")
    session.release_since(spark, mark, keep=("left",))
    names = [os.path.basename(p) for p in session._WRITTEN[spark.sparkContext.applicationId]]
    assert not any(n.startswith("own-") for n in names) and any(n.startswith("theirs-too-") for n in names)
    gone.set()
    t.join(60)
    assert kept[0].count() == 3 and left.count() == 5
    assert not os.path.exists(own.inputFiles()[0].removeprefix("file:").removeprefix("//"))
    names = [os.path.basename(p) for p in session._WRITTEN[spark.sparkContext.applicationId]]
    assert not any(n.startswith("theirs-too-") for n in names)


def test_store_refuses_unknown_versions_and_keeps_all_rows(spark):
    where = session.shared_path(spark, "store-test")
    model = SegmentModel(BinnerModel({"r_bin": "-Recency"}, {"r_bin": [0.0, 1.0]}, 1), [(0, 0.0, 0.0, 0.0)])
    assert [model_store.save_model(spark, where, "m", model) for _ in range(2)] == [1, 2]
    model_store.promote(spark, where, "m", 1)
    with pytest.raises(LookupError):
        model_store.promote(spark, where, "m", 99)
    assert model_store.load_model(spark, where, "m").version == 1
    model_store.promote(spark, where, "m", 2)
    assert {(r.version, r.stage) for r in model_store.models(spark, where).collect()} == {(1, "archived"), (2, "production")}
    model_store.promote(spark, where, "m", 1)
    assert {(r.version, r.stage) for r in model_store.models(spark, where).collect()} == {(1, "production"), (2, "archived")}
    assert model_store.load_model(spark, where, "m").version == 1


def test_batched_restarts_find_what_single_runs_find():
    rng = np.random.default_rng(3)
    grid = np.array([(r, f, m) for r in range(4) for f in range(4) for m in range(3)], float)
    w = rng.integers(1, 50, len(grid)).astype(float)
    for k in (2, 5, 9):
        one = min(weighted_kmeans(grid, w, k, np.random.default_rng([k, i]))[0] for i in range(200))
        many, _, c = weighted_kmeans_batch(grid, w, k, 400, np.random.default_rng(k))
        assert many <= one * 1.02
        assert np.isclose(many, (w * ((grid[:, None] - c[None]) ** 2).sum(2).min(1)).sum())


def test_sweep_reports_every_k(spark):
    cells = spark.createDataFrame([(0, 0, 0, 3), (1, 1, 1, 2), (2, 2, 2, 4)], "r_bin int, f_bin int, m_bin int, w long")
    rows = {r.k: r for r in k_sweep(cells, 3, [2, 3, 4, 5], restarts=20).collect()}
    assert sorted(rows) == [2, 3, 4, 5]
    assert rows[3].inertia == pytest.approx(0) and rows[4].inertia is None and rows[5].silhouette is None


def test_silhouette_of_cells_equals_the_plain_one(spark):
    rng = np.random.default_rng(5)
    cells = [(r, f, m) for r in range(3) for f in range(3) for m in range(2)]
    w = rng.integers(1, 9, len(cells))
    lab = rng.integers(0, 3, len(cells))
    df = spark.createDataFrame([(*c, int(a), int(b)) for c, a, b in zip(cells, w, lab)],
                               "r_bin int, f_bin int, m_bin int, w long, cluster int")
    got = silhouette_of_cells(df).first()
    assert got.silhouette == pytest.approx(weighted_silhouette(np.array(cells, float), w.astype(float), lab), abs=1e-8)
    assert (got.customers, got.cells) == (int(w.sum()), len(cells))


def test_null_bins_stay_in_the_outputs(spark):
    df = spark.createDataFrame([("a", 0, 1, 2), ("b", 1, None, 0), ("c", 2, 2, 1), ("d", None, None, None)],
                               "CustomerID string, r_bin int, f_bin int, m_bin int")
    assert bin_cells(df).count() == 2
    got = {r.CustomerID: r.x for r in segment_projection(df).collect()}
    assert sorted(got) == ["a", "b", "c", "d"] and got["b"] is None and got["a"] is not None
    levels = {r.metric: (r.levels, r.rows) for r in level_counts(df, ["r_bin", "f_bin", "m_bin"]).collect()}
    assert levels == {"r_bin": (3, 4), "f_bin": (2, 4), "m_bin": (3, 4)}


def test_components_equal_an_exact_decomposition(spark):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(7)
    x = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 30)) * (rng.random((80, 30)) < 0.8) + 1.0
    x[rng.random(x.shape) < 0.5] = 0.0
    rows = [(i, Vectors.sparse(30, {j: float(v) for j, v in enumerate(r) if v}) if i % 2 else Vectors.dense(r.tolist()))
            for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["i", "v"]).repartition(4)
    v = principal_components(df, "v", 30, 5)
    exact = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :5]
    assert np.allclose(np.abs((v * exact).sum(0)), 1.0, atol=1e-3)
    got = np.array([r.p for r in df.withColumn("p", project(F.col("v"), v)).orderBy("i").collect()])
    assert np.allclose(got, x @ v)
    with pytest.raises(ValueError):
        principal_components(df, "v", 30, 31)
