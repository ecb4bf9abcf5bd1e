import pytest
from pyspark.sql import functions as F

from segmint.operators.binning import BinnerModel
from segmint.operators.cluster import SegmentModel
from segmint.sources import layers, model_store


@pytest.fixture
def schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS layer_test")
    yield "layer_test"
    for t in spark.catalog.listTables("layer_test"):
        layers.drop_layer(spark, f"layer_test.{t.name}")


def test_a_failed_write_leaves_the_layer(spark, schema):
    t = f"{schema}.a"
    layers.write_layer(spark.range(10), t)
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        layers.write_layer(bad, t)
    assert spark.table(t).count() == 10 and len(layers.versions(spark, t)) == 1


def test_a_refused_version_is_never_seen(spark, schema):
    t = f"{schema}.b"

    def some(df):
        if df.isEmpty():
            raise ValueError("no rows")

    layers.write_layer(spark.range(3), t, check=some)
    with pytest.raises(ValueError):
        layers.write_layer(spark.range(0), t, check=some)
    assert spark.table(t).count() == 3


def test_readers_see_one_version_and_columns_may_change(spark, schema):
    t = f"{schema}.c"
    before = layers.write_layer(spark.range(5), t)
    first = layers.current(spark, t)
    after = layers.write_layer(spark.range(7).selectExpr("cast(id as string) as id", "id * 2 as twice"), t)
    assert before.count() == 5 and before.columns == ["id"]  # a plan made before the swap
    assert after.count() == 7 and spark.table(t).columns == ["id", "twice"]
    assert layers.current(spark, t) != first and len(layers.versions(spark, t)) == 2
    layers.write_layer(spark.range(1), t)
    assert first not in layers.versions(spark, t) and len(layers.versions(spark, t)) == 2


def test_a_layer_may_be_made_of_itself(spark, schema):
    t = f"{schema}.d"
    layers.write_layer(spark.range(4), t)
    layers.write_layer(spark.table(t).where("id > 1"), t)
    assert sorted(r.id for r in spark.table(t).collect()) == [2, 3]


def test_tables_are_not_taken_for_layers(spark, schema):
    spark.range(2).write.mode("overwrite").saveAsTable(f"{schema}.plain")
    try:
        with pytest.raises(ValueError):
            layers.write_layer(spark.range(1), f"{schema}.plain")
    finally:
        spark.sql(f"DROP TABLE {schema}.plain")


def _model(x):
    edges = [0.0, 1.0, 2.0]
    return SegmentModel(BinnerModel({"r_bin": "Recency"}, {"r_bin": edges}, 2), [(0, x, 0.0, 0.0)])


@pytest.mark.parametrize("order", ["first", "second"])
@pytest.mark.parametrize("store", ["path", "catalog"])
def test_two_savers_never_share_a_version(spark, monkeypatch, tmp_path, order, store):
    """One saver reads the store, the other saves, then the first goes on with
    what it read; the claims decide, in either order."""
    where = str(tmp_path / "models") if store == "path" else f"claims_{order}"
    if store == "catalog":
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {where}")
    real, got = model_store._rows, {}

    def stale(spark, w):
        rows = real(spark, w)
        if "inner" not in got:
            seen = rows.collect()  # what the outer saver knows
            got["inner"] = None
            got["inner"] = model_store.save_model(spark, where, "m", _model(1.0 if order == "first" else 2.0))
            return spark.createDataFrame(seen, model_store.ROWS_SCHEMA)
        return rows

    monkeypatch.setattr(model_store, "_rows", stale)
    outer = model_store.save_model(spark, where, "m", _model(2.0 if order == "first" else 1.0))
    monkeypatch.setattr(model_store, "_rows", real)
    assert sorted((outer, got["inner"])) == [1, 2]
    back = {}
    for v in (1, 2):
        model_store.promote(spark, where, "m", v)
        back[v] = model_store.load_model(spark, where, "m").centroids
    inner = 1.0 if order == "first" else 2.0
    assert tuple(back[got["inner"]][0]) == (0, inner, 0.0, 0.0) and tuple(back[outer][0]) == (0, 3.0 - inner, 0.0, 0.0)
    assert not model_store.claim_version(spark, where, "m", 1) and model_store.claim_version(spark, where, "m", 3)
    assert model_store.save_model(spark, where, "m", _model(0.0)) == 4
    assert model_store.save_model(spark, where, "other", _model(0.0)) == 1
