"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000
_local_fallback: list[str] = []
_shipped_to: set[str] = set()


def build_session(app: str = "catalog_spark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; keyword names use ``_`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.memory", "12g")
                .config("spark.sql.shuffle.partitions", "8")
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of the session, once per application.

    Arrow batches are bounded at ``BATCH_ROWS`` unless the session says otherwise: rows may hold long texts.
    """
    if spark.conf.get(BATCH_KEY) == "10000":  # the default
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped_to:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="catalog-spark-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))  # served by the driver
        _shipped_to.add(app)
    return spark


def work_folder(spark: SparkSession, label: str = "table") -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder of the machine.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        if not _local_fallback:
            _local_fallback.append(tempfile.mkdtemp(prefix="catalog-spark-"))
        base = _local_fallback[0]
    app = spark.sparkContext.applicationId  # one folder per application, to be dropped as a whole
    return f"{base.rstrip('/')}/catalog_spark/{app}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work when a table has fewer input splits than there are cores.

    For heavy per-row work on a few small files; a table with enough splits is
    returned as it is, without a shuffle.  ``df`` should be a plain scan, as its
    splits are counted by planning it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage is cut by a file that outlives any executor, the rows are computed
    once however often they are used, and Catalyst knows the true size of the
    result, so its broadcast decision is a checked one.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``materialize`` whose tables are removed at the end of the block, whether it succeeds or not.

    After each table is written, the JVM is asked to let go of the shuffle files of the finished steps, so a job of
    many steps needs the disk of its largest step and not of their sum.
    """
    folders: list[str] = []

    def keep(df: DataFrame, label: str = "table") -> DataFrame:
        path = work_folder(spark, label)
        folders.append(path)
        df.write.option("compression", "zstd").parquet(path)
        schema = df.schema
        del df
        release(spark)
        return spark.read.schema(schema).parquet(path)

    try:
        yield keep
    finally:
        for path in folders:
            remove(spark, path)


def release(spark: SparkSession) -> None:
    """Ask both sides of the driver to collect garbage, so that Spark drops shuffle files that nothing refers to.

    Twice, as what the first round lets go of may hold more; the executors get a moment to delete.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
