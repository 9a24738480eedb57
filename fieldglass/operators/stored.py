"""Tables derived from an input once and read many times: indexes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_BUILT: dict[tuple, tuple[dict[str, str], dict[str, DataFrame]]] = {}


def shared_folder(spark: SparkSession) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``; only a local master without one uses a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="fieldglass-")
    path = f"{root.rstrip('/')}/fieldglass-index-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def settled(df: DataFrame) -> DataFrame:
    """``df`` written and read again: no condition on it is turned into one on what it is made of, and nothing of that runs twice."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _remove(spark: SparkSession, path: str) -> None:
    try:
        fs, target = _file_system(spark, path)
        fs.delete(target, True)
    except Exception:  # the JVM may be gone by now
        pass


def state_of(spark: SparkSession, path: str) -> tuple:
    """What changes when a table's files do: bytes, files, time of the last change."""
    fs, target = _file_system(spark, path)
    sums = fs.getContentSummary(target)
    return path, sums.getLength(), sums.getFileCount(), fs.getFileStatus(target).getModificationTime()


def built_once(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], dict[str, tuple[DataFrame, list[str]]]]) -> dict[str, DataFrame]:
    """The tables that ``build`` gives, as (frame, partition columns) by name; written at the first call and again when an input's files changed.

    A table that could not be written whole is not remembered, so a failed build is
    made anew.
    """
    key = (spark.sparkContext.applicationId, name, *(state_of(spark, p) for p in inputs))
    if key not in _BUILT:
        folder, paths = shared_folder(spark), {}
        for table, (frame, by) in build().items():
            paths[table] = f"{folder}/{table}"
            writer = frame.write
            (writer.partitionBy(*by) if by else writer).parquet(paths[table])
        for old in [k for k in _BUILT if k[:2] == key[:2] and [x[0] for x in k[2:]] == [x[0] for x in key[2:]]]:
            for path in _BUILT.pop(old)[0].values():
                _remove(spark, path)
        _BUILT[key] = paths, {table: spark.read.parquet(path) for table, path in paths.items()}  # files are listed once
    return dict(_BUILT[key][1])
