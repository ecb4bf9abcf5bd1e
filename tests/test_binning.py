import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from segmint.operators.binning import QuantileBinner, bin_column, inner_edges, kept_edges
from segmint.operators.quantiles import _exact_ranged, _stack, exact_quantiles, exact_quantiles_many

PROBS = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


def one_col(spark, xs):
    return spark.createDataFrame([(float(x),) for x in xs], "x double")


def bins(spark, xs, n=5, fit_xs=None):
    b = QuantileBinner({"b": "x"}, n).fit(one_col(spark, fit_xs if fit_xs is not None else xs))
    return [r.b for r in b.transform(one_col(spark, xs)).collect()], b.edges["b"]


def test_duplicate_edges(spark):
    got, edges = bins(spark, [1, 1, 1, 1, 1, 1, 2, 3, 4, 5])
    assert edges == pytest.approx([1.0, 1.0, 1.0, 1.4, 3.2, 5.0], abs=1e-12)
    assert kept_edges(edges) == pytest.approx([1.0, 1.4, 3.2, 5.0], abs=1e-12)
    assert got == [0, 0, 0, 0, 0, 0, 1, 1, 2, 2]


def test_constant_column_single_bin(spark):
    got, _ = bins(spark, [7, 7, 7])
    assert got == [0, 0, 0]


def test_value_on_edge_goes_up_and_out_of_range(spark):
    b = QuantileBinner({"b": "x"}, 5).fit(one_col(spark, range(11)))
    inner = inner_edges(b.edges["b"])
    vals = [inner[0], -100.0, 100.0]
    got = [r.b for r in b.transform(one_col(spark, vals)).collect()]
    assert got == [1, 0, 4]


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "x double")
    got = [r.b for r in df.select(bin_column(F.col("x"), [0.0, 0.5, 1.0]).alias("b")).collect()]
    assert got == [None, 1]


def _numpy_bins(xs, n):
    e = np.percentile(np.asarray(xs, float), np.linspace(0, 100, n + 1))
    k = kept_edges(list(e))
    return list(np.searchsorted(np.asarray(k[1:-1]), np.asarray(xs, float), side="right"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=2, max_size=40))
def test_bins_match_numpy_and_are_monotone(spark, xs):
    got, _ = bins(spark, xs)
    assert got == [int(v) for v in _numpy_bins(xs, 5)]
    order = np.argsort(xs, kind="stable")
    s = [got[i] for i in order]
    assert s == sorted(s) and max(got) <= 4


def test_ranged_plan_equals_single_task_plan(spark):
    rng = np.random.default_rng(7)
    xs = list(np.round(rng.gamma(2.0, 100.0, 3000), 2)) + [5.0] * 1000
    ys = list(rng.integers(0, 30, 4000))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(xs, ys)], "x double, y double")
    small = exact_quantiles(df, ["x", "y"], PROBS)
    ranged = _exact_ranged(_stack(df, ["x", "y"]), ["x", "y"], PROBS, partitions=7)
    assert small == ranged
    for col, vals in (("x", xs), ("y", ys)):
        ref = np.percentile(np.asarray(vals, float), [p * 100 for p in PROBS])
        assert np.allclose(small[col], ref, rtol=0, atol=1e-9)


def test_uniform_and_ten_bins(spark):
    got, edges = bins(spark, list(range(11)), 10)
    assert len(edges) == 11 and got[-1] == 9
    b = QuantileBinner({"b": "x"}, 5, strategy="uniform").fit(one_col(spark, [0, 10]))
    assert b.edges["b"] == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]


def test_approx_path_runs(spark):
    b = QuantileBinner({"b": "x"}, 5, approx=True).fit(one_col(spark, range(100)))
    assert len(b.edges["b"]) == 6


@pytest.mark.parametrize("edges,inner", [([1, 2, 3], [2]), ([1, 1, 1], []), ([1, 2, 2], [])])
def test_inner_edges(edges, inner):
    assert inner_edges(edges) == inner


def test_many_sources_equal_separate_fits(spark):
    a = spark.createDataFrame([(float(i % 17), float(i % 5)) for i in range(200)], "x double, y double")
    b = a.where("x > 3")
    both = exact_quantiles_many([(a, ["x", "y"]), (b, ["x"])], PROBS)
    assert both[0] == exact_quantiles(a, ["x", "y"], PROBS)
    assert both[1] == exact_quantiles(b, ["x"], PROBS)
    big = exact_quantiles_many([(a, ["x"]), (b, ["x"])], PROBS, partitions=3)
    assert big == [exact_quantiles(a, ["x"], PROBS), exact_quantiles(b, ["x"], PROBS)]


def test_edges_equal_numpy_for_any_number_of_partitions(spark):
    rng = np.random.default_rng(11)
    rows = [(int(rng.integers(0, 400)), int(rng.integers(1, 9)), float(np.round(rng.gamma(2, 60), 2)))
            for _ in range(1500)]
    df = spark.createDataFrame(rows, "Recency int, Frequency long, MonetaryValue double")
    probs = [j / 5 for j in range(6)]
    want = {c: np.quantile([r[i] for r in rows], probs) for i, c in enumerate(df.columns)}
    for parts in (1, 3, 11):
        got = exact_quantiles(df, df.columns, probs, partitions=parts)
        assert all(np.allclose(got[c], want[c], rtol=1e-12) for c in df.columns)


@pytest.mark.parametrize("small,grid,accuracy", [(4096, 1024, 10_000), (8, 16, 100), (2, 4, 10), (2, 4, 1)])
def test_brackets_equal_numpy_with_ties_and_a_hot_value(spark, monkeypatch, small, grid, accuracy):
    from segmint.operators import quantiles as Q
    for name, v in (("SMALL", small), ("GRID", grid), ("ACCURACY", accuracy)):
        monkeypatch.setattr(Q, name, v)
    rng = np.random.default_rng(5)
    cols = {
        "hot": np.concatenate([rng.normal(size=2000), np.full(1000, 0.25)]),
        "ties": rng.integers(0, 8, 3000).astype(float),
        "one": np.full(3000, 3.0),
        "wide": rng.gamma(0.1, 1e6, 3000),
        "low": np.where(np.arange(3000) < 2990, -1.0, rng.normal(size=3000)),
    }
    rows = [tuple(map(float, r)) for r in zip(*cols.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    probs = [0.0, 0.001, 0.2, 1 / 3, 0.5, 0.6667, 0.999, 1.0]
    got = exact_quantiles(df, list(cols), probs)
    for c, xs in cols.items():
        assert np.allclose(got[c], np.quantile(xs, probs), rtol=1e-12, atol=0), c


def test_brackets_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.0, 0.5]) == {"x": [None, None], "y": [1.0, 1.0]}
    assert exact_quantiles(df.where("false"), ["x"], [0.5]) == {"x": [None]}


def test_brackets_neither_range_partition_nor_sort(spark):
    from segmint.operators import quantiles as Q
    df = spark.range(1000).selectExpr("cast(id as double) x")
    plan = Q._regions([(df, ["x"])], {0: [3.0, 9.0]}).groupBy("m", "g").count()._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan.split("== Physical Plan ==")[1]
