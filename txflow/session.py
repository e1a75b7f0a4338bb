"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every job wants; sizes stay the cluster's choice.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partitioned writes keep a few files open instead of sorting their rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # The JVM never compiles a method of more than 8000 bytes of code: wide expressions go into several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "txflow", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the library's settings applied."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def filled(rows: DataFrame) -> int:
    """Tasks of a scan that have rows; row groups of Parquet files are counted, no column is read."""
    return rows.select(F.spark_partition_id().alias("part")).distinct().count()


def remove(spark: SparkSession, pattern: str) -> None:
    """Delete the folders that match a path pattern, in any storage Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in store.globStatus(path) or []:
        store.delete(found.getPath(), True)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [found.getPath().getName() for found in store.listStatus(path)] if store.exists(path) else []


def below(spark: SparkSession, folder: str) -> list[str]:
    """Paths, from ``folder`` on, of all files in it and in the folders under it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    top, found, paths = store.makeQualified(path).toUri().getPath(), store.listFiles(path, True), []
    while found.hasNext():
        paths.append(found.next().getPath().toUri().getPath().removeprefix(top).lstrip("/"))
    return paths


def read_text(spark: SparkSession, name: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, name: str) -> str | None:
    """The first line of a text file, unpacked if its name says so; None if it is empty. Reads no more than it needs."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(name)
    stream = path.getFileSystem(settings).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
        return jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")).readLine()
    finally:
        stream.close()


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Replace a small file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Where that is unset, a local one is made if driver and tasks are one process;
    on a cluster that would give every executor a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex}"
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix='txflow-')}/{name}"
