import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators import categorize as C
from segmint.operators import lowrank as L

GROUPS = {"red": "rose ruby crimson", "green": "moss olive fern", "blue": "navy azure sky"}


def lines(spark):
    """Order lines of nine descriptions, each with another number of lines."""
    rows, n = [], 0
    for name, words in GROUPS.items():
        for w in words.split():
            n += 1
            rows += [(f"{name} {name} {name} {words} {w}",)] * (n * 3)
    return spark.createDataFrame(rows + [(None,)] * 5, "Description string")


def categories(model, df):
    return {r.Description: r.ProductCategoryID for r in C.categorize(model, df).collect()}


def test_all_rows_fit_equals_an_unweighted_fit_on_the_repeated_rows(spark):
    df = lines(spark)
    model = C.fit_categories(df, 64, 3, 3, 42, dedupe=False)
    # The plain way: the pipeline and the components of one vector a line.
    kept = df.where("Description is not null")
    plain = C.feature_pipeline(64).fit(kept)
    x = np.array([r.v for r in plain.transform(kept).select(C.vector_to_array("tfidf_features").alias("v")).collect()])
    y = {r.Description: r.v for r in model.features.transform(kept.distinct()).select(
        "Description", C.vector_to_array("tfidf_features").alias("v")).collect()}
    assert all(np.allclose(y[d], v) for d, v in zip([r.Description for r in kept.collect()], x))
    value, vec = np.linalg.eigh(np.cov(x.T, bias=True))
    want = vec[:, np.argsort(-value)[:3]]
    assert np.allclose(np.abs(want.T @ model.components), np.eye(3), atol=1e-6)
    got = categories(model, df)
    # Three colours, numbered by their number of lines.
    assert {c: {d.split()[0] for d in got if got[d] == c} for c in set(got.values())} == {0: {"blue"}, 1: {"green"}, 2: {"red"}}
    again = C.fit_categories(kept.unionByName(kept), 64, 3, 3, 42, dedupe=False)
    assert categories(again, df) == got


@pytest.mark.parametrize("dedupe", [True, False])
def test_categories_do_not_depend_on_partitions(spark, dedupe):
    words = [f"w{i}" for i in range(30)]
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(" ".join(rng.choice(words, 6)),) for _ in range(150)], "Description string")
    got = [categories(C.fit_categories(df.repartition(n), 128, 5, 6, 1, dedupe=dedupe), df) for n in (1, 16)]
    assert got[0] == got[1] and set(got[0].values()) == set(range(6))


def test_saved_model_keeps_its_numbers(spark, tmp_path):
    df = lines(spark)
    model = C.fit_categories(df, 64, 3, 3)
    model.save(str(tmp_path / "m"))
    assert categories(C.CategoryModel.load(str(tmp_path / "m")), df) == categories(model, df)


def test_sums_have_a_bounded_fan_in(spark, monkeypatch):
    monkeypatch.setattr(L, "FAN", 3)
    parts = spark.range(0, 32, 1, 8).select(F.col("id").cast("int").alias("slot"), F.lit(np.arange(4.0).tobytes()).alias("data"))
    assert L.sum_parts(parts).tolist() == (32 * np.arange(4.0)).tolist()  # three rounds and more; a group of four raises
    assert len(L.sum_parts(parts.where("false"))) == 0


def test_sparse_product_equals_dense(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 12)) * (rng.random((40, 12)) < 0.3)
    x[:, 0] += 1
    w, q = rng.integers(1, 5, 40).astype(float), rng.normal(size=(12, 4))
    row, at = np.nonzero(x)
    start = np.searchsorted(row, np.arange(40))
    assert np.allclose(L.sparse_product(at, x[row, at], start, w, q, False), x.T @ (w[:, None] * (x @ q)))
    assert np.allclose(L.sparse_product(at, x[row, at], start, w, q, True), (x @ q).T @ (w[:, None] * (x @ q)))


def test_nearest_centre(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, 1.0],), ([5.0, 5.0],)], "v array<double>")
    got = [r.c for r in df.select(C.nearest_centre(F.col("v"), [[2, 2], [0, 0], [4, 6]]).alias("c")).collect()]
    assert got == [1, 0, 2]
