"""Session defaults."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; further settings by keyword, dots as double underscores."""
    builder = SparkSession.builder.master(master).appName("factloom")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. A local session without one gets a temporary
    folder; on a cluster that is an error, as no machine's own folder is seen by the others."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="factloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{work_folder(spark)}/factloom/{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    if spark._jvm is not None and spark.sparkContext._jsc is not None:  # else the session has ended already
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a path of the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Of what is kept in between: ids are digits of a digest, of which codecs that only look for repeats save nothing.
KEPT_CODEC = "zstd"


def kept(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read from there, so that nothing is worked out twice and no lost executor
    takes it along."""
    path = work_path(df.sparkSession, label)
    df.write.option("compression", KEPT_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_with(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """`kept`, and aggregates of its rows, taken while they are written."""
    seen = Observation()
    path = work_path(df.sparkSession, label)
    df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.option("compression", KEPT_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark would use for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
