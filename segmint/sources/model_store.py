"""Segment-model persistence in catalog tables (versioned, with stages).

``<schema>.segment_models`` is append-only: a row for every save (with the
model: JSON of edges and centroids) and for every later change of a version's
stage (without). Nothing is ever rewritten, so a failed write loses nothing.
A version is claimed before its row is written: an empty file per version,
created without overwrite through the Hadoop FileSystem API (exclusive where
the file system's create is, as on HDFS or a local disk), so two savers never
share one, whatever either had read before. A saver that dies between the claim
and the row leaves a gap in the numbers.
On read a version's stage is that of its last row; at most one version of a
name is ``production`` after ``promote``. The table holds a few rows per
version, so reading it whole is bounded by the number of versions.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cluster import SegmentModel

MODELS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("model", T.StringType(), False),
])

ROWS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("at", T.TimestampType(), False),
    T.StructField("save_id", T.StringType(), True),
    T.StructField("model", T.StringType(), True),
])


def _is_path(where: str) -> bool:
    return "/" in where or ":" in where


def _table(schema: str) -> str:
    return f"{schema}.segment_models"


def _exists(spark: SparkSession, where: str) -> bool:
    if _is_path(where):
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(path))
    return spark.catalog.tableExists(_table(where))


def _rows(spark: SparkSession, where: str) -> DataFrame:
    if not _exists(spark, where):
        return spark.createDataFrame([], ROWS_SCHEMA)
    if _is_path(where):
        return spark.read.schema(ROWS_SCHEMA).parquet(where)
    return spark.table(_table(where))


def models(spark: SparkSession, where: str) -> DataFrame:
    """The store, one row per version: ``where`` is a catalog schema (table
    ``<schema>.segment_models``) or a storage path (a Parquet folder, e.g.
    under the shared checkpoint dir)."""
    saved = F.col("save_id").isNotNull()
    return _rows(spark, where).groupBy("name", "version").agg(
        F.max_by("stage", F.struct("at", (~saved).alias("change"))).alias("stage"),
        F.min_by("at", F.when(saved, F.col("save_id"))).alias("created_at"),
        F.min_by("model", F.when(saved, F.col("save_id"))).alias("model"))


def _append(spark: SparkSession, rows: list[tuple], where: str, fmt: str) -> None:
    df = spark.createDataFrame(rows, ROWS_SCHEMA).coalesce(1)  # one file: all its rows or none
    if _is_path(where):
        df.write.mode("append").parquet(where)
    else:
        df.write.format(fmt).mode("append").saveAsTable(_table(where))


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _claims(spark: SparkSession, where: str, name: str) -> str:
    """Folder of a model's claims: hidden from readers of the store."""
    base = where if _is_path(where) else spark.catalog.getDatabase(where).locationUri
    return f"{base.rstrip('/')}/_segment_model_claims/{hashlib.sha256(name.encode()).hexdigest()}"


def claim_version(spark: SparkSession, where: str, name: str, version: int) -> bool:
    """Take a version for one saver: false if it is taken already."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{_claims(spark, where, name)}/{version}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    try:
        fs.create(path, False).close()
    except Py4JJavaError as e:
        if fs.exists(path):
            return False
        raise e
    return True


def save_model(spark: SparkSession, where: str, name: str, model: SegmentModel, fmt: str = "parquet") -> int:
    """Append a new version (stage 'none'); returns the version number, the
    first one after the highest known that no other saver has claimed."""
    if not _is_path(where):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {where}")
    version = (_rows(spark, where).where(F.col("name") == name).agg(F.max("version")).first()[0] or 0) + 1
    while not claim_version(spark, where, name, version):
        version += 1
    model.version = version
    _append(spark, [(name, version, "none", _now(), uuid.uuid4().hex, model.to_json())], where, fmt)
    return version


def promote(spark: SparkSession, where: str, name: str, version: int, fmt: str = "parquet") -> None:
    """Make ``version`` the production model of ``name`` and archive the one
    before, in one append. Raises LookupError for an unknown version."""
    known = {r["version"]: r["stage"] for r in models(spark, where).where(F.col("name") == name).select("version", "stage").collect()}
    if version not in known:
        raise LookupError(f"no version {version} of model {name}")
    at = _now()
    rows = [(name, v, "archived", at, None, None) for v, s in known.items() if s == "production" and v != version]
    _append(spark, [*rows, (name, version, "production", at, None, None)], where, fmt)


def latest_model(spark: SparkSession, schema: str, name: str, stage: str | None = None) -> DataFrame:
    """One row: the highest version of ``name`` (optionally in ``stage``)."""
    m = models(spark, schema).where(F.col("name") == name)
    if stage:
        m = m.where(F.col("stage") == stage)
    return m.groupBy("name").agg(F.max_by(F.struct("version", "stage", "created_at", "model"), "version").alias("m")) \
        .select("name", "m.version", "m.stage", "m.created_at", "m.model")


def load_model(spark: SparkSession, schema: str, name: str, stage: str | None = "production") -> SegmentModel:
    row = latest_model(spark, schema, name, stage).first()
    if row is None:
        raise LookupError(f"no {stage or 'saved'} model named {name}")
    m = SegmentModel.from_json(row["model"])
    m.version = row["version"]
    return m


def load_version(spark: SparkSession, where: str, name: str, version: int) -> SegmentModel:
    """The model of one version, whatever its stage."""
    row = models(spark, where).where((F.col("name") == name) & (F.col("version") == version)).first()
    if row is None:
        raise LookupError(f"no version {version} of model {name}")
    m = SegmentModel.from_json(row["model"])
    m.version = version
    return m
