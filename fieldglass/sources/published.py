"""Tables whose files count once a manifest names them: atomic writes, replaced partitions, zone maps, keyed upserts.

A folder holds ``data`` with parquet files under names of their own and ``manifests``
with one JSON file a version.  The last version is the table; what no manifest names
is not there, so a task that failed, ran twice or never finished leaves no row.  A
version is published by creating its file, which only one writer can do.

Each entry names a file, its rows, the value of the partition column, and the least
and the largest value of chosen columns (a zone map), from which readers tell the
files they need.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import ship


def _files(path: str):
    """(pyarrow filesystem, path in it)."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _plain(v):
    """A value as JSON can hold and order it."""
    return v if v is None or isinstance(v, (bool, int, float, str)) else str(v)


def versions(path: str) -> list[int]:
    from pyarrow import fs

    own, root = _files(path)
    found = own.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[:-5].isdigit())


def manifest(path: str, version: int | None = None) -> dict:
    """The last (or the given) version: files, and what its writer noted; version 0 is an empty table."""
    known = versions(path)
    if not known and version is None:
        return {"version": 0, "files": [], "notes": {}}
    own, root = _files(path)
    with own.open_input_stream(f"{root}/manifests/{version or known[-1]:010d}.json") as f:
        return json.loads(f.read())


def publish(path: str, base: int, files: list[dict], notes: dict) -> int:
    """Make ``files`` the version after ``base``; raises FileExistsError if another writer was first."""
    own, root = _files(path)
    own.create_dir(f"{root}/manifests", recursive=True)
    target, staged = f"{root}/manifests/{base + 1:010d}.json", f"{root}/manifests/.{uuid.uuid4().hex}"
    with own.open_output_stream(staged) as f:
        f.write(json.dumps({"version": base + 1, "files": files, "notes": notes}).encode())
    try:
        if own.type_name == "local":
            import os

            os.link(staged, target)  # fails if the version is there
        elif own.get_file_info(target).type.name != "NotFound":
            raise FileExistsError(target)
        else:
            own.move(staged, target)
    finally:
        if own.get_file_info(staged).type.name != "NotFound":
            own.delete_file(staged)
    return base + 1


class _Staged(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class _Writer(DataSourceArrowWriter):
    """Each task stages one file for each value of the partition column it has rows of."""

    def __init__(self, options: dict, overwrite: bool, rows_a_file: int = 1_000_000):
        self.path, self.by, self.overwrite, self.most = options["path"], options.get("by"), overwrite, int(options.get("rowsafile", rows_a_file))
        self.zones = [c for c in options.get("zones", "").split(",") if c]
        self.replaced = json.loads(options.get("replace", "[]"))
        self.notes = json.loads(options.get("notes", "{}"))
        self.base = manifest(self.path)

    def _stage(self, own, root: str, table: pa.Table, value) -> dict:
        name = f"data/{uuid.uuid4().hex}.parquet"
        own.create_dir(f"{root}/data", recursive=True)
        with own.open_output_stream(f"{root}/{name}") as f:
            pq.write_table(table, f)
        zones = {}
        for c in self.zones:
            ends = pc.min_max(table.column(c))
            zones[c] = [_plain(ends["min"].as_py()), _plain(ends["max"].as_py())]
        return {"file": name, "rows": table.num_rows, "part": value, "zones": zones}

    def write(self, iterator):
        own, root = _files(self.path)
        held, files = {}, []

        def flush(value):
            files.append(self._stage(own, root, pa.Table.from_batches(held.pop(value)), value))

        for b in iterator:
            if not b.num_rows:
                continue
            values = [None] if self.by is None else b.column(self.by).unique().to_pylist()
            for v in values:
                mask = None if self.by is None else pc.is_null(b.column(self.by)) if v is None else pc.equal(b.column(self.by), pa.scalar(v, b.column(self.by).type))
                held.setdefault(_plain(v), []).append(b if mask is None else b.filter(mask))
                if sum(x.num_rows for x in held[_plain(v)]) >= self.most:
                    flush(_plain(v))
        for v in list(held):
            flush(v)
        return _Staged(files)

    def commit(self, messages):
        new = [f for m in messages if m for f in m.files]
        gone = {*map(_plain, self.replaced), *(f["part"] for f in new if self.by)} if self.by else set()
        kept = [] if self.overwrite else [f for f in self.base["files"] if not (self.by and f["part"] in gone and ("replace" in self.notes or self.replaced))]
        publish(self.path, self.base["version"], kept + new, {k: v for k, v in self.notes.items() if k != "replace"})

    def abort(self, messages):
        own, root = _files(self.path)
        for m in messages:
            for f in m.files if m else ():
                own.delete_file(f"{root}/{f['file']}")


class PublishedTable(DataSource):
    """The sink ``published``; options path, by, zones, rowsAFile, replace and notes (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "published"

    def writer(self, schema, overwrite: bool):
        return _Writer({k.lower(): v for k, v in self.options.items()}, overwrite)


def write(df: DataFrame, path: str, by: str | None = None, zones: list[str] = (), replace: list | None = None, overwrite: bool = False, notes: dict | None = None, rows_a_file: int = 1_000_000) -> None:
    """Adds ``df`` to a table, or makes it the table (``overwrite``), as one version.

    With ``replace`` (a list of values of ``by``, it may be empty) the partitions
    named and those that ``df`` has rows of are put in place of what they held, so a
    partition that became empty goes.  Doing it again changes nothing but files.
    """
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(PublishedTable)
    said = dict(notes or {}) | ({"replace": True} if replace is not None else {})
    w = df.write.format("published").mode("overwrite" if overwrite else "append").option("path", path).option("zones", ",".join(zones)).option("notes", json.dumps(said)).option("replace", json.dumps(replace or [])).option("rowsAFile", rows_a_file)
    (w.option("by", by) if by else w).save()


def _read(spark: SparkSession, path: str, files: list[dict], schema: str) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f['file']}" for f in files])


def read(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The table of the last (or a given) version; ``schema`` as in DDL."""
    return _read(spark, path, manifest(path, version)["files"], schema)


def files_above(files: list[dict], column: str, after, n: int) -> list[dict]:
    """The files that hold the first ``n`` rows with ``column`` > ``after`` (all rows, if there are fewer).

    Taken by their largest values: once files that begin above ``after`` and end at a
    bound have n rows, no row above the bound is among the first n, so files that
    begin above the bound are not opened.  A column that is all NULL has no such row.
    """
    some = [f for f in files if f["zones"][column][1] is not None and (after is None or f["zones"][column][1] > after)]
    bound, sure = None, 0
    for f in sorted(some, key=lambda f: f["zones"][column][1]):
        if after is None or f["zones"][column][0] > after:
            sure += f["rows"]
            if sure >= n and bound is None:
                bound = f["zones"][column][1]
    return some if bound is None else [f for f in some if f["zones"][column][0] <= bound]


def page(spark: SparkSession, path: str, schema: str, column: str, after, n: int) -> DataFrame:
    """The ``n`` rows that follow ``after`` by a column without NULLs and with a zone map, in order; only files that may hold them are opened."""
    after = _plain(after)
    df = _read(spark, path, files_above(manifest(path)["files"], column, after, n), schema)
    return (df if after is None else df.where(F.col(column) > F.lit(after))).orderBy(column).limit(n)


def since(spark: SparkSession, path: str, schema: str, column: str, mark) -> DataFrame:
    """All rows with ``column`` at or after ``mark``; files that end before it are not opened."""
    mark = _plain(mark)
    some = [f for f in manifest(path)["files"] if f["zones"][column][1] is not None and f["zones"][column][1] >= mark]
    return _read(spark, path, some, schema).where(F.col(column) >= F.lit(mark))


class KeyedTable:
    """A table with one row a key, kept up to date by micro-batches, each of which counts once.

    Keys are dealt into ``buckets``; a batch reads and writes the buckets it has keys of
    and no others.  The number of the batch is published with the files, in one step:
    a batch that died before it is as if it had not begun, and one that comes again
    after it is passed over.  A NULL never overwrites a value (``merge=False``) or does
    (``merge=True``).
    """

    def __init__(self, path: str, schema: str, keys: list[str], order: str | None = None, buckets: int = 64, merge: bool = False):
        self.path, self.schema, self.keys, self.order, self.buckets, self.merge = path, schema, keys, order, buckets, merge
        self._stored = f"{schema}, _bucket int"

    def read(self, spark: SparkSession) -> DataFrame:
        return read(spark, self.path, self._stored).drop("_bucket")

    def batches(self) -> int:
        """The number of the last batch that counted, -1 before any."""
        return manifest(self.path)["notes"].get("batch", -1)

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """For ``foreachBatch``: whether the batch was new. Of rows with one key, that with the largest ``order`` counts; keys are not NULL."""
        from pyspark.sql import Window as W

        from .writers import merge, upsert

        base = manifest(self.path)
        if batch_id <= base["notes"].get("batch", -1):
            return False
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = batch.dropna(subset=self.keys)
        if self.order:
            new = new.withColumn("_rn", F.row_number().over(W.partitionBy(*self.keys).orderBy(F.desc(self.order)))).where("_rn = 1").drop("_rn")
        else:
            new = new.dropDuplicates(self.keys)
        new = new.persist()
        try:
            touched = [r.b for r in new.select(bucket.alias("b")).distinct().collect()]  # as many as there are buckets at most
            old = _read(batch.sparkSession, self.path, [f for f in base["files"] if f["part"] in touched], self._stored).drop("_bucket")
            out = (merge if self.merge else upsert)(old, new.select(*old.columns), self.keys)
            write(out.withColumn("_bucket", bucket).repartition("_bucket"), self.path, by="_bucket", replace=touched, notes={"batch": batch_id})
        finally:
            new.unpersist()
        return True


def follow(stream: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = None):
    """A running query that keeps ``table`` up to date: one round over what is new, or one ``every`` interval until it is stopped."""
    w = stream.writeStream.foreachBatch(lambda batch, n: table.apply(batch, n) and None).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
