"""Saved tables: where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of our own only where that is unset in local mode. On a cluster each
    machine would write to its own disk, so there it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def save(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and read it back: lineage ends there, and a lost
    executor costs nothing but the task it ran."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return _marked(spark.read.schema(df.schema).parquet(path), path)


def _marked(df: DataFrame, path: str, table: str | None = None) -> DataFrame:
    df._saved = (path, table)  # for drop_saved()
    return df


def drop_saved(*saved: DataFrame) -> None:
    """Delete tables that save() or save_bucketed() returned, once nothing that is still to run reads them."""
    for df in saved:
        path, table = df._saved
        if table:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def save_bucketed(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """As save(), but bucketed by a column: later joins on it leave this table where it is."""
    spark = df.sparkSession
    name = f"t_{uuid.uuid4().hex}"
    buckets = min(100_000, buckets or 2 * partitions(spark))
    path = f"{shared_dir(spark)}/{name}"
    df.write.bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(name)
    return _marked(spark.table(name), path, name)
