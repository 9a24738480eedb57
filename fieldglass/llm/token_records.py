"""Token ids in files of length-delimited binary records, with an offset index.

A record is: length of the payload (uint64), masked checksum of those eight
bytes (uint32), payload, masked checksum of the payload (uint32), all
little-endian.  The mask is the usual one of record files: the checksum turned
right by 15 bits plus a constant, so that a checksum stored inside data does not
check itself.  The checksum under the mask is CRC-32 (zlib's polynomial).  A
payload is the doc_id (int64), a flag for a null doc_id (uint8), the width of an
id in bytes (uint8) and the ids.

Beside each data file lies its index: the offset of each record (uint64), so
records can be read in any order.  Files are dealt out by ranges of doc_id and
sorted inside, so their names give the order of all documents.  A file is written
under a name of its own attempt and moved when complete, so a task that runs
again, or twice at once, does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, partitions, ship
from .grams import slices
from .tokens import encoder

_HEAD = struct.Struct("<QI")
_DOC = struct.Struct("<qBB")
_SHARDS = "path string, shard int, n_docs long, n_tokens long, n_bytes long"
_RECORDS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    """The masked checksum of ``data``."""
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record."""
    width = 2 if not len(ids) or ids.max() < 65536 else 4
    payload = _DOC.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, where the next record starts); raises ValueError on any damage."""
    size, check = _HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"length checksum at {at}")
    a = at + _HEAD.size
    payload = data[a : a + size]
    if len(payload) < size or struct.unpack_from("<I", data, a + size)[0] != masked(payload):
        raise ValueError(f"payload checksum at {at}")
    doc_id, null, width = _DOC.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=_DOC.size), a + size + 4


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, files: int | None = None) -> DataFrame:
    """Write all documents in ascending doc_id (null last); one row per file, in order.

    Null and empty texts give the end id alone; rows that repeat a doc_id lie
    next to each other in order of their text, and so do rows without one, which the
    beginning of their text deals out over files; other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)

    def run(batches):
        enc, fs, base = encoder(tokenizer), *filesystem(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"{base}/part-{task.partitionId():06d}"
        own = f"{base}/.{uuid.uuid4().hex}"
        end = np.array([end_id], "<u4").tobytes()
        docs_n = tokens_n = at = 0
        offsets: list[int] = []
        out = None
        for b in batches:
            for i, j in slices(b.column("text"), 2 << 20):
                part = b.slice(i, j - i)
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.ids(part.column("text").to_pylist())):
                    if out is None:
                        out = fs.open_output_stream(own)
                    ids = np.frombuffer(ids + end, "<u4")
                    record = frame(doc, ids)
                    out.write(record)
                    offsets.append(at)
                    at += len(record)
                    docs_n += 1
                    tokens_n += len(ids)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(own + "i") as index:
            index.write(np.array(offsets, "<u8").tobytes())
        fs.move(own + "i", name + ".idx")
        fs.move(own, name + ".rec")
        yield pa.RecordBatch.from_pydict({"path": [name], "shard": pa.array([task.partitionId()], pa.int32()), "n_docs": [docs_n], "n_tokens": [tokens_n], "n_bytes": [at]})

    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(files or partitions(spark), F.col("doc_id").asc_nulls_last(), F.substring(F.coalesce("text", F.lit("")), 1, 32))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    )
    shards = dealt.mapInArrow(run, _SHARDS).collect()  # a row per file
    shards.sort(key=lambda r: r.shard)
    start, rows = 0, []
    for r in shards:
        rows.append((r.path, r.shard, r.n_docs, r.n_tokens, r.n_bytes, start))
        start += r.n_tokens
    return spark.createDataFrame(rows, _SHARDS + ", start long")


def read_records(shards: DataFrame, folder: str) -> DataFrame:
    """All records of the files, checked: doc_id, start (ids before it), n_tokens, ids_crc32."""
    spark = shards.sparkSession
    ship(spark)

    def run(batches):
        fs, _ = filesystem(folder)
        for b in batches:
            for r in b.to_pylist():
                before, rows = r["start"], []
                with fs.open_input_file(r["path"] + ".idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8")
                ends = np.append(offsets[1:], r["n_bytes"]).astype(np.int64)
                if len(offsets) != r["n_docs"]:
                    raise ValueError(f"{r['path']}: index of {len(offsets)} records, {r['n_docs']} written")
                with fs.open_input_file(r["path"] + ".rec") as f:
                    i = 0
                    while i < len(offsets):
                        j = max(i + 1, int(np.searchsorted(ends, int(offsets[i]) + (4 << 20), "right")))
                        f.seek(int(offsets[i]))
                        data = f.read(int(ends[j - 1] - offsets[i]))
                        for at in offsets[i:j].astype(np.int64) - int(offsets[i]):
                            doc, ids, _ = unframe(data, int(at))
                            rows.append((doc, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                            before += len(ids)
                        i = j
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [x.split()[0] for x in _RECORDS.split(", ")])
                        rows = []

    n = max(1, shards.count())
    return shards.repartition(min(n, 10_000)).mapInArrow(run, _RECORDS)


def read_shuffled(path: str, folder: str, seed: int, first: int = 0, count: int | None = None):
    """(doc_id, ids) of one file's records in a permuted order, by its offset index."""
    fs, _ = filesystem(folder)
    with fs.open_input_file(path + ".idx") as f:
        offsets = np.frombuffer(f.read(), "<u8")
    order = np.random.default_rng(seed).permutation(len(offsets))[first : None if count is None else first + count]
    with fs.open_input_file(path + ".rec") as f:
        for i in order:
            f.seek(int(offsets[i]))
            head = f.read(_HEAD.size)
            doc, ids, _ = unframe(head + f.read(_HEAD.unpack(head)[0] + 4))
            yield doc, ids
