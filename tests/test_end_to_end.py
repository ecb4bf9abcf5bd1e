import datetime as dt
import os
import tempfile

import pandas as pd

from segmint.plans.pipeline import PipelineConfig, run_pipeline
from segmint.sources import model_store
from segmint.sources.transactions import load_transactions, read_orders
from segmint.streaming.stream import file_stream, run_to_completion, stream_daily_sales
from segmint.schemas import EVENTS

SF = "/root/testdata/sf0.001"


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"r_bin", "f_bin", "m_bin", "Recency"} <= set(df.columns)
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_pipeline_end_to_end_and_model_store(spark):
    cfg = PipelineConfig(schema="e2e", freq_cap=8, monetary_cap=120000.0, restarts=5, num_features=256, pca_k=10,
                         recency_sign=-1)
    out = run_pipeline(spark, load_transactions(spark, SF), cfg)
    assert out["gold"].where("Recency > 0").count() == 0
    og = out["orders_gold"]
    assert og.count() == out["orders_silver"].count()
    assert og.where("CustomerID IS NOT NULL AND Cluster IS NULL").count() == 0
    m = model_store.models(spark, "e2e").collect()
    assert [r.stage for r in m] == ["production"]
    seg = model_store.load_model(spark, "e2e", cfg.model_name)
    v2 = model_store.save_model(spark, "e2e", cfg.model_name, seg)
    model_store.promote(spark, "e2e", cfg.model_name, v2)
    stages = {r.version: r.stage for r in model_store.models(spark, "e2e").collect()}
    assert stages == {1: "archived", 2: "production"}
    assert model_store.latest_model(spark, "e2e", cfg.model_name).first().version == 2
    shares = [r.revenue_share for r in out["segment_profile"].collect()]
    assert abs(sum(s for s in shares if s is not None) - 1.0) < 1e-5


def test_read_orders_csv(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    p = os.path.join(d, "o.csv")
    pd.DataFrame({"InvoiceNo": ["1"], "StockCode": ["s"], "Description": ["x"], "Quantity": [3],
                  "InvoiceDate": ["2011-01-02 10:00:00"], "UnitPrice": [1.25], "CustomerID": ["7"],
                  "Country": ["UK"]}).to_csv(p, index=False)
    r = read_orders(spark, p).first()
    assert str(r.SalesAmount) == "3.75" and r.InvoiceDate == dt.datetime(2011, 1, 2, 10)


def test_stream_late_row_dropped(spark):
    """Late rows are filtered with the previous batch's watermark (Spark >= 3.4),
    so the late 4.0 for day 10 arrives two batches after the watermark passed."""
    import glob
    import shutil
    import time
    d, src = tempfile.mkdtemp(dir="/tmp"), tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 10)
    batches = [
        [(1, base, 1, "a", 1.0, None), (2, base + dt.timedelta(days=5), 1, "a", 2.0, None)],
        [(4, base + dt.timedelta(days=9), 1, "a", 1.0, None)],
        [(3, base, 1, "a", 4.0, None)],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
        for f in glob.glob(os.path.join(d, f"b{i}", "*.parquet")):
            shutil.copy(f, os.path.join(src, f"part{i}.parquet"))
        time.sleep(1.1)
    s = file_stream(spark, src, EVENTS, max_files_per_trigger=1)
    out = {(r.InvoiceDate, float(r.DailySales)) for r in run_to_completion(stream_daily_sales(s), "late").collect()}
    assert (dt.date(2024, 1, 10), 1.0) in out
    assert (dt.date(2024, 1, 15), 2.0) in out
    assert not any(day == dt.date(2024, 1, 19) for day, _ in out)  # still open
