"""Session settings the plans rely on, and lineage cuts in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "layoutgraph", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; anything in ``extra`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a temporary one of our own in local mode; on a cluster, whose
    executors don't share the driver's disk, an error."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="layoutgraph-")
        sc.setCheckpointDir(folder)
        atexit.register(shutil.rmtree, folder, True)
    return folder.rstrip("/")


def new_table_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/layoutgraph-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables written so far in this process. To be called when no frame built on them is still
    needed, such as at the end of a job."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def cut(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: ends the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_table_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
