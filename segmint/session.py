"""Session helpers: a tuned local session for tests/bench, and the shared
folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app: str = "segmint", driver_memory: str = "16g",
              extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE on, UTC time zone and the UI off."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage-cut folder.

    On a cluster this is whatever the cluster put in ``spark.checkpoint.dir``
    (or already set on the context). Only a local master (tests), where driver
    and executors are one process, gets a folder of its own when nothing is
    configured; elsewhere a machine-local folder would lose files, so this
    raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="segmint-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


#: Application -> path of a written table -> the thread that wrote it.
_WRITTEN: dict[str, dict[str, int]] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed by ``release`` or when the
    driver's process ends."""
    path = os.path.join(checkpoint_dir(spark), "segmint", f"{name}-{uuid.uuid4().hex}")
    app = spark.sparkContext.applicationId
    if app not in _WRITTEN:
        _WRITTEN[app] = {}
        atexit.register(release, spark)
    _WRITTEN[app][path] = threading.get_ident()
    return path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete the given written tables (all of this application's when none is
    given) through the Hadoop FileSystem API. Safe to call after the session
    has stopped: what a dead JVM cannot delete stays for the folder's owner."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    left = _WRITTEN.get(sc.applicationId, {})
    for path in list(paths or left):
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        left.pop(path, None)


def written(spark: SparkSession) -> frozenset[str]:
    """The tables this thread has written so far: a mark for ``release_since``."""
    return frozenset(written_since(spark, frozenset()))


def written_since(spark: SparkSession, mark: frozenset[str]) -> list[str]:
    """This thread's tables beyond ``mark``, oldest first. Another thread's
    tables are never among them, whatever it writes or releases meanwhile."""
    me = threading.get_ident()
    mine = _WRITTEN.get(spark.sparkContext.applicationId, {}).copy()
    return [p for p, thread in mine.items() if thread == me and p not in mark]


def release_since(spark: SparkSession, mark: frozenset[str], keep: tuple[str, ...] = ()) -> None:
    """Delete the tables this thread wrote after ``mark`` that nothing reads
    any more: all but those whose name is in ``keep``."""
    gone = [p for p in written_since(spark, mark) if os.path.basename(p).rpartition("-")[0] not in keep]
    if gone:
        release(spark, *gone)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back. Cuts lineage (a lost executor does not force recomputation of the
    upstream joins) and, unlike an RDD checkpoint, keeps column pruning and
    filter pushdown for every later reader. The files live until ``release``
    or the end of the driver's process."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (what ``--py-files``
    does): zip its sources once per application and ``addPyFile`` the zip.
    Needed by the operators that run Python in tasks (k-means restarts); a
    deployment that installs the package on every node can skip it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="segmint-pyfiles-"), "segmint.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.join("segmint", os.path.relpath(full, root)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
