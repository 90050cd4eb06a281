"""Session set-up and the shared folder for staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the library relies on. The time zone is part of the data
# model (all calendars are UTC); the others are Spark's skew and sizing rules.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition once it is one advisory partition (64 MB) too large,
    # not only at the default of 256 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Written tables are read back several times: about a third smaller than with the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
}

# Settings fixed when a session starts. Capturing the Python call site of every
# column costs several round trips to the JVM per call.
START_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tallyhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; on a cluster `master` stays unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Where staged tables go: the folder named by `spark.checkpoint.dir`, else one below the warehouse.

    Both must be places every executor can reach. The warehouse's default lies on the driver's own disk,
    so without the setting such a place is refused unless driver and executors are one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = folder.startswith("file:") or "://" not in folder
    if own_disk and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {folder} is machine-local")
    return folder + "/_stages"


def _application_folder(spark: SparkSession):
    """Hadoop path of everything this application stages, and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    This cuts the lineage at a durable point: a lost executor re-reads files
    instead of recomputing, several consumers share one computation, and the
    parquet footers give the optimizer true sizes and prunable columns.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    free_shuffles(spark)
    # removed when the application ends, unless `drop_stages` does so earlier
    folder, files = _application_folder(spark)
    files.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them once their plan is garbage, and the driver seldom collects."""
    spark.sparkContext._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on whatever file system it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def drop_stages(spark: SparkSession) -> None:
    """Delete everything this application staged; frames built on it can no longer be read."""
    folder, files = _application_folder(spark)
    files.delete(folder, True)
