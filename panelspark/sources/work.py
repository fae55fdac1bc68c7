"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where the setting is missing a temporary folder serves a session that runs on this machine alone; a cluster must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        place = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not place and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(place or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder, once, and read it again.

    Unlike checkpoint() this computes df a single time and stores it compressed. The files go with drop(), or when the JVM ends. The shuffles
    that made df go once it is written, as no plan reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    files, place = _place(spark, path)
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete the files of cut tables that no job reads any more: every frame built on them must have been cut before."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            files, place = _place(table.sparkSession, file)
            files.delete(place.getParent(), True)
