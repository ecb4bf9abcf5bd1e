import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators.binning import BinnerModel
from segmint.operators.cluster import SegmentModel, bin_cells
from segmint.operators.report import principal_axes, segment_projection
from segmint.schemas import BRONZE, EVENTS, check_schema
from segmint.sources import model_store
from segmint.sources.transactions import read_orders_checked, reject_counts
from segmint.streaming.stream import file_stream, late_rows, run_to_completion, stream_daily_sales, \
    stream_score_production, stream_to_end

HEAD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
GOOD = ["1,a,red mug,2,2024-01-05 10:00:00,1.25,7,NO", "2,b,,1,2024-01-06 00:00:00,3,,", '3,c,"two, words",-4,2024-01-07 23:59:59,0.5,8,SE']
BAD = {
    "4,d,x,two,2024-01-05 10:00:00,1.25,7,NO": ["bad Quantity"],
    "5,e,x,2,someday,1.25,7,NO": ["bad InvoiceDate"],
    "6,f,x,2,2024-01-05 10:00:00,cheap,7,NO": ["bad UnitPrice"],
    "7,g,x,many,never,dear,7,NO": ["bad Quantity", "bad InvoiceDate", "bad UnitPrice"],
    "8,h,x,2,2024-01-05 10:00:00,,7,NO": ["missing UnitPrice"],
    "9,i,x,,2024-01-05 10:00:00,1,7,NO": ["missing Quantity"],
    "10,j,x,2,2024-01-05 10:00:00,1,7,NO,more": ["malformed"],
    "11,k,x,2,2024-02-30 10:00:00,1,7,NO": ["bad InvoiceDate"],
    "12,l,x,2,2024-01-05 10:00:00,1e30,7,NO": None,
}


def test_bad_lines_are_rejected_and_good_ones_read(spark, tmp_path):
    p = str(tmp_path / "o.csv")
    with open(p, "w") as f:
        f.write(HEAD + "\n".join([GOOD[0], *BAD, *GOOD[1:]]) + "\n")
    good, rejects = read_orders_checked(spark, p)
    check_schema(good, BRONZE)
    rows = {r.InvoiceNo: r for r in good.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert str(rows["1"].SalesAmount) == "2.50" and rows["2"].CustomerID is None and rows["3"].Description == "two, words"
    got = {r.InvoiceNo: r for r in rejects.collect()}
    assert set(got) == {x.split(",")[0] for x in BAD}
    for line, why in BAD.items():
        r = got[line.split(",")[0]]
        assert r.reasons == why if why else len(r.reasons) == 1, line
    assert got["10"].line.endswith(",more") and got["7"].Quantity == "many"
    counts = {r.reason: r.lines for r in reject_counts(rejects).collect()}
    assert counts["bad Quantity"] == 2 and counts["bad InvoiceDate"] == 3
    with pytest.raises(ValueError, match="9 of 12"):
        read_orders_checked(spark, p, max_share=0.5)
    assert read_orders_checked(spark, p, max_share=0.8)[0].count() == 3


def test_stored_columns_of_another_type(spark, tmp_path):
    p = str(tmp_path / "o")
    spark.createDataFrame([("1", "a", None, "2", "2024-01-05 10:00:00", "1.5", None, None), ("2", "a", None, "x", "2024-01-05 10:00:00", "1", None, None)],
                          ", ".join(f"{n} string" for n in HEAD.strip().split(","))).write.parquet(p)
    good, rejects = read_orders_checked(spark, p, fmt="parquet")
    assert [r.InvoiceNo for r in good.collect()] == ["1"] and [r.reasons for r in rejects.collect()] == [["bad Quantity"]]


def event(i, day, hour=1, value=5.0):
    return (i, dt.datetime(2024, 1, day, hour), i % 3, "buy", value, None)


def test_late_rows_of_each_batch(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "late")
    schema = EVENTS
    batches = [[event(1, 10), event(2, 1)], [event(3, 7), event(4, 8, 0), event(5, 15), event(6, 3, value=-1.0)], [event(7, 12, 23), event(8, 13)]]
    for rows in batches:
        spark.createDataFrame([r[: len(schema)] for r in rows], schema).coalesce(1).write.mode("append").parquet(src)
        out = late_rows(file_stream(spark, src, schema), "late", "2 days", base=base)
    got = sorted((r.batch, r.event_us, r.delay_seconds) for r in out.collect())
    us = lambda d, h: int(dt.datetime(2024, 1, d, h, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    # Batch 1: the watermark is the 8th, 1 am; only the 7th is closed. Batch 2: the 13th, 1 am.
    assert got == [(1, us(7, 1), 86400.0), (2, us(12, 23), 7200.0)]
    again = late_rows(file_stream(spark, src, schema), "late", "2 days", base=base)
    assert again.count() == 2  # nothing new arrived


def test_a_source_without_files_gives_no_rows(spark, tmp_path):
    for where in (tmp_path, tmp_path / "not there yet"):
        stream = lambda: file_stream(spark, str(where), EVENTS, glob="*.parquet")  # noqa: E731,B023
        assert run_to_completion(stream_daily_sales(stream()), "none").count() == 0
        assert stream_to_end(stream(), "none").count() == 0
        assert late_rows(stream(), "none").count() == 0


def test_promotion_between_batches_changes_later_scores_only(spark, tmp_path):
    store, src, sink = (str(tmp_path / x) for x in ("store", "src", "sink"))
    schema = "CustomerID string, Recency int, Frequency long, MonetaryValue double"
    edges = {c: [0.0, 5.0, 10.0] for c in ("r_bin", "f_bin", "m_bin")}
    binner = BinnerModel({"r_bin": "Recency", "f_bin": "Frequency", "m_bin": "MonetaryValue"}, edges, 2)

    def batch(ids):
        spark.createDataFrame([(i, 1, 2, 9.0) for i in ids], schema).coalesce(1).write.mode("append").parquet(src)
        return stream_score_production(file_stream(spark, src, spark.read.parquet(src).schema), store, "m", sink)

    spark.createDataFrame([], schema).write.parquet(src)
    with pytest.raises(Exception, match="no production model"):
        batch(["a"])
    for cluster in (4, 9):
        v = model_store.save_model(spark, store, "m", SegmentModel(binner, [(cluster, 0.0, 0.0, 0.0)]))
        if cluster == 4:
            model_store.promote(spark, store, "m", v)
            first = sorted((r.CustomerID, r.cluster, r.model_version) for r in batch(["b"]).collect())
    model_store.promote(spark, store, "m", 2)
    both = sorted((r.CustomerID, r.cluster, r.model_version) for r in batch(["c"]).collect())
    assert [r[1:] for r in first] == [(4, 1)] * len(first)
    assert both == sorted(first + [("c", 9, 2)])


def test_axes_equal_an_exact_decomposition(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 5, 500), rng.integers(0, 3, 500), np.zeros(500, int)])
    x[:, 2] = np.clip(x[:, 0] + rng.integers(-1, 2, 500), 0, 4)
    df = spark.createDataFrame([(str(i), *map(int, r)) for i, r in enumerate(x)] + [("none", None, 1, 1)],
                               "CustomerID string, r_bin int, f_bin int, m_bin int")
    value, vec = np.linalg.eigh(np.cov(x.T))
    for axis, k in zip(principal_axes(bin_cells(df)), np.argsort(-value)):
        v = vec[:, k] * np.sign(vec[np.abs(vec[:, k]).argmax(), k])
        assert np.allclose(axis, v, atol=1e-9)
    got = {r.CustomerID: (r.x, r.y) for r in segment_projection(df).collect()}
    assert got["none"] == (None, None) and abs(got["0"][0] - x[0] @ principal_axes(bin_cells(df))[0]) < 1e-6
    assert segment_projection(df.where("false")).count() == 0
