"""Reading tables and cutting lineage at durable points."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def _hadoop(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` as a table written once to the shared folder: lost executors re-read files.

    The files go when the application ends, or earlier by `discard`.
    """
    spark = df.sparkSession
    own = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    path = f"{own}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    folder, files = _hadoop(spark, own)
    files.deleteOnExit(folder)
    # Spark deletes shuffle files once their plan is garbage; the driver seldom collects by itself
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by `written` that nothing reads any more."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        folder, files = _hadoop(df.sparkSession, path)
        files.delete(folder, True)
