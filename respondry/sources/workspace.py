"""Written intermediate tables.

Used where a result is read more than once: the table is computed once, its lineage ends there,
and a lost executor costs a re-read instead of a recomputation.

Every application has one folder of its own below ``spark.checkpoint.dir`` (or the checkpoint folder
already set; the warehouse, which executors share as well, where neither is named). It goes when the
application ends; after a crash, or earlier, :func:`clear` removes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), file


def shared_folder(spark: SparkSession) -> str:
    """This application's folder, made if it is not there yet."""
    context = spark.sparkContext
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    folder = f"{base.rstrip('/')}/respondry-{context.applicationId}"
    system, file = _file(spark, folder)
    if system.mkdirs(file):
        system.deleteOnExit(file)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    system, file = _file(spark, path)
    return system.exists(file)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    system, file = _file(spark, path)
    system.delete(file, True)


def clear(spark: SparkSession) -> None:
    """Remove this application's written tables; results that still read them are lost."""
    system, file = _file(spark, shared_folder(spark))
    system.delete(file, True)


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and return a scan of it."""
    path = new_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
