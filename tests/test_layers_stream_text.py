"""SURVEY §5 items: layer schemas, text-pipeline invariants, stream vs batch."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from segmint.operators import categorize as cat
from segmint.plans import catalog as C
from segmint.schemas import DAILY, FAVORITE, GOLD, METRICS_SCHEMA, SILVER, check_schema, EVENTS
from segmint.sources.transactions import load_transactions
from segmint.streaming.stream import file_stream, run_to_completion, stream_daily_sales

SF = "/root/testdata/sf0.001"


def test_layer_schemas(spark):
    check_schema(C.silver(spark, SF), SILVER)
    check_schema(C.q_daily_sales(spark, SF), DAILY)
    check_schema(C.metrics(spark, SF), METRICS_SCHEMA)
    check_schema(C.gold(spark, SF), GOLD)
    check_schema(C.favorites(spark, SF), FAVORITE)


def test_each_description_one_category_and_seeded(spark):
    bronze = load_transactions(spark, SF)
    descs = cat.description_table(bronze)
    m1 = cat.fit_categories(bronze, 256, 10, 5, 42, descriptions=descs)
    a = cat.categorize(m1, bronze, descriptions=descs)
    rows = a.collect()
    n_desc = descs.count()
    assert len(rows) == n_desc == len({r.Description for r in rows})
    assert all(0 <= r.ProductCategoryID < 5 for r in rows)
    m2 = cat.fit_categories(bronze, 256, 10, 5, 42, descriptions=descs)
    b = cat.categorize(m2, bronze, descriptions=descs)
    assert sorted(a.collect()) == sorted(b.collect())


def test_stream_over_split_files_equals_batch_on_closed_days(spark):
    events = spark.read.parquet(os.path.join(SF, "events.parquet"))
    src = tempfile.mkdtemp(dir="/tmp")
    # one file per calendar day, in time order
    (events.withColumn("d", F.to_date("ts")).repartition(1, "d")
     .write.partitionBy("d").parquet(os.path.join(src, "by_day")))
    days = sorted(os.listdir(os.path.join(src, "by_day")))
    flat = tempfile.mkdtemp(dir="/tmp")
    import glob
    import shutil
    import time
    for i, d in enumerate(x for x in days if x.startswith("d=")):
        for f in glob.glob(os.path.join(src, "by_day", d, "*.parquet")):
            shutil.copy(f, os.path.join(flat, f"part-{i:04d}.parquet"))
        time.sleep(0.02)
    stream = file_stream(spark, flat, EVENTS, max_files_per_trigger=3)
    got = {(r.CustomerID, r.ProductCategoryName, r.InvoiceDate): r.DailySales
           for r in run_to_completion(stream_daily_sales(stream), "split").collect()}
    last = events.agg(F.max("ts")).first()[0]
    closed_before = (last - dt.timedelta(days=2)).date()
    batch = (events.where("value > 0").where(F.to_date("ts") < F.lit(closed_before))
             .groupBy(F.col("user_id").cast("string").alias("c"), "event_type", F.to_date("ts").alias("d"))
             .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("s")))
    want = {(r.c, r.event_type, r.d): r.s for r in batch.collect()}
    # every day closed by the final watermark is emitted with the batch total
    assert {k: v for k, v in got.items() if k[2] < closed_before} == want
