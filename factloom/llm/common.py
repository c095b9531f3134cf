"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where a local session names none (tests), a temporary folder is made and set once; on a cluster that is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="factloom-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below shared_dir(), removed when the driver ends."""
    path = f"{shared_dir(spark)}/factloom/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_remove)
    _WRITTEN[path] = spark
    return path


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark would use for it."""
    target, system = _file_system(spark, path)
    return system.makeQualified(target).toString()


def _remove() -> None:
    for path, spark in _WRITTEN.items():
        if spark._jvm is None or spark.sparkContext._jsc is None:  # the session has ended already
            return
        target, system = _file_system(spark, path)
        system.delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, so that the lineage ends there."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.materialised_at = path
    return out


def release(df: DataFrame) -> None:
    """Deletes what `materialise` wrote for df, once nothing reads it any more."""
    path = df.materialised_at
    if _WRITTEN.pop(path, None) is not None:
        target, system = _file_system(df.sparkSession, path)
        system.delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_runs(texts: list[str], chars: int = 1 << 20):
    """The texts in runs of about so many characters, a longer text alone."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > chars:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def spread(flat: np.ndarray, width: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of values put one after another: (the values, where each row ends). flat: the values of the distinct rows,
    width: how many each has, number: which of them stand in a row."""
    size = width[number]
    ends = np.cumsum(size)
    source = np.repeat((np.cumsum(width) - width)[number] - (ends - size), size)
    source += np.arange(len(source))
    return flat[source], ends


def settle() -> None:
    """Gives memory that is free inside of this process back to the system. A worker lives through many batches and
    stages, and what one batch needed for a moment would else stay with it: 300 of 550 MB after some batches of texts."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # only some C libraries have it
        trim(0)


class Recent:
    """A memory of what was met lately, in two generations of at most `most` entries: when the young one is full it
    becomes the old one, and what is found there moves to the young one again. Values are never None."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def find(self, keys: list) -> list:
        """The value of each key, None where it is not known."""
        found = list(map(self.young.get, keys))
        if None in found:
            for i, value in enumerate(found):
                if value is None and (value := self.old.get(keys[i])) is not None:
                    found[i] = value
                    self.put(keys[i], value)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value
