"""Session for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the platform's own session is used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="aljibe-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, *partitioned_by: str) -> str:
    """Write ``df`` to a new folder below the shared folder; its path."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitioned_by).parquet(path)
    return path


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Runs a job. Cuts the lineage, survives the loss of executors, frees the
    result from the tables it was read from, and lets Spark plan with its real size.
    The frame is lazy, so the folder stays; cleaning the shared folder is the cluster's task.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage(df))
