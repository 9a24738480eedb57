"""What the operators share: table access, shared scratch space, worker paths."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import time
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than space and \t\n\v\f\r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``, whatever store that is in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster where executors lack the folder, pass the package with
    ``--py-files``; the entry added here is then merely unused.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it.  Only where that is unset and the master is
    local (tests) a temporary folder is made and set as the checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fieldglass-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_root(spark)}/fieldglass-{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may be gone by now; the folder is then left to the cluster
        pass


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here and survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Tables that an operator writes on its way; those no longer needed are removed at once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = scratch(self.spark, tag)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables written here, and shuffle files that nothing refers to any more.

        Spark frees the latter when the driver collects its garbage, which a driver
        with a roomy heap may not do while a loop fills the executors' disks.
        """
        for t in tables:
            _remove(self.spark, self._paths.pop(id(t))[1])
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def free(self) -> None:
        """Let a large shuffle go that nothing refers to any more: what held it goes in a first round, it itself in a second."""
        for _ in range(2):
            self.drop()
            time.sleep(0.5)


def filesystem(path: str):
    """(pyarrow filesystem, path in it) of a path with or without a scheme."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions now set."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def maybe_in(docs: DataFrame, ids: DataFrame, bits: int = 26) -> DataFrame:
    """Rows whose doc_id may be in ``ids``, before texts are shuffled.

    A bitmap of 2**bits hash places (8 MB at 26, whatever the input) goes to every
    task.  It only ever lets too much through; the join that follows is exact.
    """
    spark = docs.sparkSession
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))

    def fill(t: pa.Table) -> pa.Table:
        field = np.zeros(1 << 16, np.uint8)
        field[t.column("at").to_numpy() & 0xFFFF] = 1
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "field": pa.array([np.packbits(field).tobytes()], pa.binary())})

    at = ids.select(place(F.col("doc_id")).alias("at")).select("at", F.shiftright("at", 16).cast("int").alias("part"))
    fields = at.groupBy("part").applyInArrow(fill, "part int, field binary").collect()  # 2**(bits - 16) rows of 8 KB at most
    full = np.zeros(1 << (bits - 3), np.uint8)
    for r in fields:
        full[r.part << 13 : (r.part + 1) << 13] = np.frombuffer(r.field, np.uint8)
    sent = spark.sparkContext.broadcast(full.tobytes())

    def keep(batches):
        field = np.frombuffer(sent.value, np.uint8)
        for b in batches:
            i = b.column("at").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text")], ["doc_id", "text"]).filter(pa.array((field[i >> 3] >> (7 - (i & 7)).astype(np.uint8)) & 1 == 1))

    return docs.where("doc_id is not null").select("doc_id", "text", place(F.col("doc_id")).alias("at")).mapInArrow(keep, "doc_id long, text string")
