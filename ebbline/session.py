"""Spark session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on.  Shuffle partition counts are
# left to the cluster: AQE coalesces them to the data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods above this size uncompiled; wide aggregates are
    # faster outside a generated method that is only interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Wide matrices are built from hundreds of expressions; do not record a
    # Python call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_work_dirs: dict[str, str] = {}
_scopes: dict[str, list[str]] = {}
_shipped: set[str] = set()


def build_session(app: str = "ebbline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the package settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        # Big shuffles start with many partitions; AQE merges the small ones.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "2000")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application, so that their Python can import it."""
    app_id = spark.sparkContext.applicationId
    if app_id in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ebbline-code-"), "ebbline.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app_id)


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Local sessions without that setting get a temporary folder of their own;
    a cluster without it is refused, since executors share no local disk.
    """
    app_id = spark.sparkContext.applicationId
    if _scopes.get(app_id):
        return _scopes[app_id][-1]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if app_id not in _work_dirs:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        _work_dirs[app_id] = tempfile.mkdtemp(prefix="ebbline-")
    return _work_dirs[app_id]


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside go to a folder of their own, which is removed at the end.

    Results must have been written elsewhere by then.  For nightly runs: without it every run
    leaves its intermediates in :func:`work_dir`.
    """
    app_id = spark.sparkContext.applicationId
    folder = f"{work_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    _scopes.setdefault(app_id, []).append(folder)
    try:
        yield folder
    finally:
        _scopes[app_id].remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under :func:`work_dir` and read it back.

    Cuts lineage into a columnar table that survives the loss of executors and
    still allows column pruning and filter push-down.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
