"""Structured Streaming: daily consolidation of a live order/event feed and
scoring of a stream of customer metrics with a saved segment model."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cluster import BIN_COLS, SegmentModel
from ..schemas import MONEY
from ..session import shared_path
from ..sources import model_store


def utc_instant(df: DataFrame, col: str):
    """Event time as a TIMESTAMP (watermarks need one) without depending on
    the session time zone: a wall-clock TIMESTAMP_NTZ is read as UTC."""
    if isinstance(df.schema[col].dataType, T.TimestampType):
        return F.col(col)
    c = F.col(col)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def stream_daily_sales(events: DataFrame, watermark: str = "2 days", customer: str = "user_id",
                       category: str = "event_type", ts: str = "ts", amount: str = "value") -> DataFrame:
    """Streaming version of the daily consolidation: positive amounts summed
    per customer x category x 1-day tumbling window. Rows older than the
    watermark are dropped; in append mode a day is emitted once the
    watermark passes its end, and its state is then evicted."""
    t = utc_instant(events, ts)
    return (events.where(F.col(amount) > 0)
            .withColumn("_t", t)
            .withWatermark("_t", watermark)
            .groupBy(F.window("_t", "1 day").alias("day"), F.col(customer), F.col(category))
            .agg(F.sum(F.col(amount).cast(MONEY)).cast(MONEY).alias("DailySales"))
            .select(F.col(customer).cast("string").alias("CustomerID"),
                    F.col(category).alias("ProductCategoryName"),
                    F.date_from_unix_date((F.unix_seconds(F.col("day.start")) / 86400).cast("int"))
                    .alias("InvoiceDate"),
                    "DailySales"))


def stream_to_end(events: DataFrame, name: str, customer: str = "user_id", category: str = "event_type",
                  ts: str = "ts", amount: str = "value") -> DataFrame:
    """Daily consolidation of everything available, with the days that are
    still open. The stream does the stateless part: each micro-batch appends
    its own sums per customer, category and day (exactly once, through the
    sink's log), so no row is late and no state is kept; the sums of a day are
    added up when the sink is read."""
    spark = events.sparkSession
    day = F.date_from_unix_date(F.floor(F.unix_seconds(utc_instant(events, ts)) / 86400).cast("int"))
    path = shared_path(spark, name)

    def add(batch: DataFrame, batch_id: int) -> None:
        # Overwriting the batch's own folder makes a repeated batch harmless.
        batch.where(F.col(amount) > 0).groupBy(
            F.col(customer).cast("string").alias("CustomerID"), F.col(category).alias("ProductCategoryName"),
            day.alias("InvoiceDate")).agg(F.sum(F.col(amount).cast(MONEY)).alias("part")).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}")

    q = events.writeStream.foreachBatch(add).option("checkpointLocation", shared_path(spark, name + "-log")).trigger(
        availableNow=True).start()
    q.awaitTermination()
    parts = _sink(spark, path, "CustomerID string, ProductCategoryName string, InvoiceDate date, part decimal(28,2), batch long")
    return parts.groupBy("CustomerID", "ProductCategoryName", "InvoiceDate").agg(F.sum("part").cast(MONEY).alias("DailySales"))


def _sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a sink holds: no rows where no batch has written any."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def late_rows(events: DataFrame, name: str, watermark: str = "2 days", customer: str = "user_id", category: str = "event_type",
              ts: str = "ts", amount: str = "value", base: str | None = None) -> DataFrame:
    """Side sink of the daily consolidation: the rows it drops as late, with
    the watermark that closed their day and how far they were behind it.

    The watermark of a batch is the latest event time of all batches before it
    less the delay, as in ``stream_daily_sales`` (rows with a positive amount
    count). Each batch writes its late rows and its latest time to folders of
    its own number, so a repeated batch changes nothing; the times (a row a
    batch) are all the state there is. Runs over everything available; ``base``
    names the folder of a stream that is to be continued later."""
    spark = events.sparkSession
    base = base or shared_path(spark, name)
    late, times, log = (os.path.join(base, x) for x in ("late", "times", "log"))
    t = F.unix_micros(utc_instant(events, ts))
    rows = events.where(F.col(amount) > 0).select(
        F.col(customer).cast("string").alias("CustomerID"), F.col(category).alias("ProductCategoryName"),
        F.col(amount).cast(MONEY).alias("SalesAmount"), t.alias("us"))
    day = 86_400_000_000

    def split(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            before = _sink(spark, times, "us long, batch long").where(F.col("batch") < batch_id)
            latest = before.agg(F.max("us")).first()[0]
            batch.agg(F.max("us").alias("us")).write.mode("overwrite").parquet(f"{times}/batch={batch_id}")
            if latest is not None:
                mark = F.unix_micros(F.timestamp_micros(F.lit(latest)) - F.expr(f"interval {watermark}"))
                closed = (F.floor(F.col("us") / day) + 1) * day <= mark
                out = batch.where(closed).withColumn("watermark_us", mark)
                out.write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        finally:
            batch.unpersist()

    q = rows.writeStream.foreachBatch(split).option("checkpointLocation", log).trigger(availableNow=True).start()
    q.awaitTermination()
    found = _sink(spark, late, "CustomerID string, ProductCategoryName string, SalesAmount decimal(18,2), us long, "
                               "watermark_us long, batch long")
    return found.select("batch", "CustomerID", "ProductCategoryName", "SalesAmount",
                        F.col("us").alias("event_us"), ((F.col("watermark_us") - F.col("us")) / 1e6).alias("delay_seconds"))


def stream_score_production(metrics_stream: DataFrame, store: str, name: str, sink: str, id_col: str = "CustomerID") -> DataFrame:
    """Score a stream with the store's production model: each micro-batch takes
    the version that is in production when it starts and writes it beside the
    scores, under the batch's own number. A batch that is repeated after a
    failure takes the version of its first start from its own record. Runs over
    everything available; the same ``sink`` continues the stream."""
    spark = metrics_stream.sparkSession
    rows, used, log = (os.path.join(sink, x) for x in ("scores", "versions", "log"))

    def score(batch: DataFrame, batch_id: int) -> None:
        known = _sink(spark, used, "version int, batch long").where(F.col("batch") == batch_id).first()
        if known is None:
            version = model_store.load_model(spark, store, name).version
            spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").parquet(f"{used}/batch={batch_id}")
        else:
            version = known["version"]
        model = model_store.load_version(spark, store, name, version)
        out = model.assign(batch).select(id_col, *BIN_COLS, "cluster", F.lit(version).alias("model_version"))
        out.write.mode("overwrite").parquet(f"{rows}/batch={batch_id}")

    q = metrics_stream.writeStream.foreachBatch(score).option("checkpointLocation", log).trigger(availableNow=True).start()
    q.awaitTermination()
    bins = ", ".join(f"{c} int" for c in BIN_COLS)
    return _sink(spark, rows, f"{id_col} string, {bins}, cluster int, model_version int, batch long")


def stream_score(metrics_stream: DataFrame, model: SegmentModel) -> DataFrame:
    """Score a stream of (customer, category) metrics: bins with the model's
    edges (literals) and a stream-static equi-join with the broadcast cell map
    (n_bins**3 rows). Stateless, so any output mode works."""
    return model.assign(metrics_stream)


def run_to_completion(query_df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame over everything available now into a Parquet
    sink (checkpointed in the shared folder, so a restart resumes exactly) and
    return the sink as a batch DataFrame."""
    spark = query_df.sparkSession
    base = shared_path(spark, f"stream-{name}")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    q = (query_df.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _sink(spark, out, query_df.schema)


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file source over ``directory`` (optionally filtered by a file
    name glob), with an explicit schema as streaming sources require. A folder
    without files, or one that is yet to be made, is a source without rows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        fs.mkdirs(where)  # streaming sources want the folder itself
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)
