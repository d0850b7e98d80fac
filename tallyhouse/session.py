"""Session for local work, and the shared folder for tables a job writes on its way."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, **settings: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Where spark.checkpoint.dir is unset it is a folder in the session's warehouse, which
    all executors share by definition.
    """
    folder = spark.conf.get(SHARED_FOLDER, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tallyhouse"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what a job wrote at a path of fresh_path, on whatever file system it lies."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def stage(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """Write df once, one folder per value of `folders`, and return the written table, for results that share it.

    Its lineage starts at the files, so a lost executor costs a re-read at most. The
    files stay, as results that read them may run at any later time; the caller may
    remove the table's `staged_at` once it has what it wants.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*folders).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table
