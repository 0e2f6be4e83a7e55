"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only runtime settings: they can be applied to a session that somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Streams keep their state on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (UTC, ANSI, dynamic overwrite, AQE)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "tidewire", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one process, may fall back to a
    temporary folder, which is deleted when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):  # a local cluster has processes of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="tidewire-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialized(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared folder and read back: what follows starts from files.

    Cuts the lineage of a frame that several later steps use, and survives lost executors.
    """
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when that write ends, and not at some later garbage collection of the driver."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, filesystem = _filesystem(spark, path)
    return bool(filesystem.exists(hadoop_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder (one listing call; used for a handful of snapshot folders)."""
    hadoop_path, filesystem = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(hadoop_path)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is about to be written anew."""
    hadoop_path, filesystem = _filesystem(spark, path)
    filesystem.delete(hadoop_path, True)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; fails if there is one of that name."""
    hadoop_path, filesystem = _filesystem(spark, path)
    out = filesystem.create(hadoop_path, False)
    out.write(bytearray(text, "utf-8"))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, filesystem = _filesystem(spark, path)
    stream = filesystem.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
