import datetime as dt
from decimal import Decimal

from segmint.operators.metrics import cap_metrics, daily_sales, rfmp_metrics, snapshot_date
from segmint.schemas import SILVER

T = dt.datetime


def silver(spark, rows):
    full = []
    for cust, cat, ts, amount in rows:
        full.append(("1", "s", "d", 1, ts, 1.0, cust, "X", Decimal(amount), cat, None if cat is None else f"c{cat}"))
    return spark.createDataFrame(full, SILVER)


def test_returns_zero_and_negative_excluded(spark):
    df = silver(spark, [("a", 1, T(2020, 1, 1), "10.00"), ("a", 1, T(2020, 1, 2), "0.00"),
                        ("a", 1, T(2020, 1, 3), "-4.00")])
    d = daily_sales(df).collect()
    assert [(r.InvoiceDate, r.DailySales) for r in d] == [(dt.date(2020, 1, 1), Decimal("10.00"))]


def test_same_day_lines_and_time_of_day(spark):
    df = silver(spark, [("a", 1, T(2020, 1, 1, 0, 0, 0), "1.00"), ("a", 1, T(2020, 1, 1, 23, 59, 59), "2.00"),
                        ("a", 1, T(2020, 1, 5), "4.00")])
    m = rfmp_metrics(daily_sales(df)).collect()[0]
    assert m.Frequency == 2
    assert m.MonetaryValue == (3.0 + 4.0) / 2
    assert m.Recency == 0


def test_snapshot_is_global_and_ignores_returns(spark):
    df = silver(spark, [("a", 1, T(2020, 1, 1), "1.00"), ("b", 1, T(2020, 1, 11), "1.00"),
                        ("b", 1, T(2020, 2, 1), "-9.00")])
    assert snapshot_date(df).first()[0] == dt.date(2020, 1, 11)
    m = {r.CustomerID: r.Recency for r in rfmp_metrics(daily_sales(df)).collect()}
    assert m == {"a": 10, "b": 0}


def test_explicit_as_of(spark):
    df = silver(spark, [("a", 1, T(2020, 1, 1), "1.00")])
    assert rfmp_metrics(daily_sales(df), "2020-01-31").first().Recency == 30


def test_null_customer_keep_and_drop(spark):
    df = silver(spark, [(None, 1, T(2020, 1, 1), "1.00"), (None, 1, T(2020, 1, 2), "1.00"),
                        ("a", 1, T(2020, 1, 2), "1.00")])
    keep = rfmp_metrics(daily_sales(df, "keep")).collect()
    assert sorted((r.CustomerID or "", r.Frequency) for r in keep) == [("", 2), ("a", 1)]
    drop = rfmp_metrics(daily_sales(df, "drop")).collect()
    assert [r.CustomerID for r in drop] == ["a"]


def test_null_category_is_a_group(spark):
    df = silver(spark, [("a", None, T(2020, 1, 1), "1.00"), ("a", 1, T(2020, 1, 1), "1.00")])
    assert rfmp_metrics(daily_sales(df)).count() == 2


def test_caps_keep_nulls(spark):
    from segmint.schemas import METRICS_SCHEMA
    df = spark.createDataFrame([("a", 1, "x", 1, 40, 3000.0), ("b", 1, "x", 1, None, None)], METRICS_SCHEMA)
    got = {r.CustomerID: (r.Frequency, r.MonetaryValue) for r in cap_metrics(df, 30, 2500).collect()}
    assert got == {"a": (30, 2500.0), "b": (None, None)}


def test_recency_sign_presentation(spark):
    from segmint.operators.metrics import with_recency_sign
    from segmint.schemas import METRICS_SCHEMA
    df = spark.createDataFrame([("a", 1, "x", 5, 1, 1.0)], METRICS_SCHEMA)
    assert with_recency_sign(df, -1).first().Recency == -5
    assert with_recency_sign(df, 1).first().Recency == 5


def test_check_schema_and_parquet_reader(spark, tmp_path):
    import pytest
    from segmint.schemas import BRONZE, SchemaMismatch, check_schema
    from segmint.sources.transactions import load_transactions, read_orders
    bronze = load_transactions(spark, "/root/testdata/sf0.001")
    check_schema(bronze, BRONZE)
    with pytest.raises(SchemaMismatch):
        check_schema(bronze.drop("Country"), BRONZE)
    p = str(tmp_path / "orders")
    bronze.drop("SalesAmount").write.parquet(p)
    again = read_orders(spark, p, fmt="parquet")
    assert again.count() == bronze.count()
