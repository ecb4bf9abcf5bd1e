"""Catalog layers that change in one step.

A layer is a view of the catalog over one version of its files. ``write_layer``
writes a new version to a folder of its own, checks what was written, and then
replaces the view: readers see the former version or the new one, also when the
columns change. A write or check that fails leaves the layer as it was.
Versions that readers may still be scanning are kept (``keep`` former ones);
older ones are deleted after the swap.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, table: str):
    """(Hadoop path of the layer's versions, its file system)."""
    schema, _, name = table.rpartition(".")
    base = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/_layers/{name}")
    return path, path.getFileSystem(sc._jsc.hadoopConfiguration())


def versions(spark: SparkSession, table: str) -> list[str]:
    """Paths of the versions on disk, oldest first."""
    path, fs = _folder(spark, table)
    if not fs.exists(path):
        return []
    found = sorted(fs.listStatus(path), key=lambda s: s.getPath().getName())
    return [s.getPath().toString() for s in found]


def current(spark: SparkSession, table: str) -> str | None:
    """Path of the version that readers see."""
    if not spark.catalog.tableExists(table):
        return None
    files = spark.table(table).limit(1).inputFiles() or spark.table(table).inputFiles()
    known = versions(spark, table)
    return next((v for v in known if any(f.split(":", 1)[-1].lstrip("/").startswith(v.split(":", 1)[-1].lstrip("/") + "/") for f in files)), None)


def write_layer(df: DataFrame, table: str, fmt: str = "parquet", check: Callable[[DataFrame], None] | None = None,
                keep: int = 1) -> DataFrame:
    """Write ``df`` as the new version of ``table`` (``schema.name``) and return
    the layer. ``check`` gets the written version and raises to refuse it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is a table, not a layer")
    folder, fs = _folder(spark, table)
    known = versions(spark, table)
    number = int(known[-1].rsplit("/", 1)[-1].split("-")[0]) + 1 if known else 1
    path = f"{folder.toString()}/{number:08d}-{uuid.uuid4().hex}"
    staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.format(fmt).save(path)
        if check:
            check(spark.read.format(fmt).schema(df.schema).load(path))
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {fmt}.`{path}`")
    except Exception:
        fs.delete(staged, True)
        raise
    for old in known[: len(known) - keep]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old), True)
    return spark.table(table)


def drop_layer(spark: SparkSession, table: str) -> None:
    """Drop the layer and all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    folder, fs = _folder(spark, table)
    fs.delete(folder, True)
