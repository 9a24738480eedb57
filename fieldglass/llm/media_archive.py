"""Media columns: members of archives, read by byte ranges through a Spark data source.

A payload is kept as an 8-bit grey image (PNG, rows of 64 samples, deflate), many
images to a zip archive, one archive per task, in a shared folder.  The data
source ``member_archive`` plans partitions as (archive, first byte, last byte)
from file sizes alone; a task reads the central directory of its archive and
takes the members that start in its range.  Members are fetched by offset, each
checked against its stored checksum and retried alone; one that stays unreadable
becomes a row with ``error`` set, and the others of the batch are unharmed.
Batches of payloads go through Arrow, bounded in bytes.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import filesystem, ship
from .grams import slices

WIDTH = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


# --- the media format -------------------------------------------------------


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def pad(raw: bytes) -> bytes:
    """``raw`` with zero bytes up to a positive multiple of the row width."""
    return raw + bytes(-len(raw) % WIDTH or (0 if raw else WIDTH))


def encode_image(payload: bytes, n_bytes: int) -> bytes:
    """An 8-bit grey PNG whose samples are the payload; its true length goes along as text."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"bytes\x00%d" % n_bytes) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + _chunk(b"IEND", b"")


def decode_image(media: bytes) -> tuple[np.ndarray, int]:
    """(samples by row, true length); raises ValueError where the file is damaged or of another kind."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, data, shape, n = 8, [], None, -1
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            w, h, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("not 8-bit grey")
            shape = h, w
        elif kind == b"tEXt" and body.startswith(b"bytes\x00"):
            n = int(body[6:])
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(shape[0], shape[1] + 1)
    if rows[:, 0].any():
        raise ValueError("row filters are not in use here")
    return rows[:, 1:], n


def feature(samples: np.ndarray) -> str:
    """Size, mean (in thousandths) and an average hash of 8 x 8 fields, in whole numbers only."""
    h, w = samples.shape
    edge = np.arange(8) * h // 8
    rows = np.add.reduceat(samples.astype(np.int64), np.minimum(edge, h - 1), axis=0)
    fields = rows.reshape(8, 8, w // 8).sum(2)
    count = np.maximum(np.diff(np.append(edge, h)), 1)[:, None] * (w // 8)
    bits = fields * (h * w) > int(samples.sum(dtype=np.int64)) * count
    return f"{w}x{h}:{int(samples.sum(dtype=np.int64)) * 1000 // samples.size}:{int(''.join('1' if b else '0' for b in bits.ravel()), 2):016x}"


# --- writing ----------------------------------------------------------------


def write_archives(docs: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """Store the text of every row; one row per archive: path, members, bytes.

    Runs when the result is used; a task writes under a name of its own and moves
    the archive when it is complete.
    """
    ship(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        own, name = f"{base}/.{uuid.uuid4().hex}", f"{base}/part-{TaskContext.get().partitionId():06d}.zip"
        out = archive = None
        n = 0
        for whole in batches:
            for i, j in slices(whole.column(1), 4 << 20):
                b = whole.slice(i, j - i)
                for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if archive is None:
                        out = fs.open_output_stream(own)
                        archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    raw = (t or "").encode()
                    archive.writestr(zipfile.ZipInfo(f"{'' if key is None else key}_{n}.png"), encode_image(pad(raw), len(raw)))
                    n += 1
        if archive is None:
            return
        archive.close()
        out.close()
        fs.move(own, name)
        yield pa.RecordBatch.from_pydict({"path": [name], "members": [n], "bytes": [fs.get_file_info(name).size]})

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(run, "path string, members long, bytes long")


# --- reading ----------------------------------------------------------------


class Range(InputPartition):
    """Members of ``path`` that start from byte ``first`` to before ``last``."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


def fetch(fs, path: str, info: zipfile.ZipInfo, tries: int) -> tuple[bytes | None, str | None]:
    """(payload, error) of one member, opened anew at its offset for each try."""
    said = None
    for _ in range(tries):
        try:
            with fs.open_input_file(path) as f:
                f.seek(info.header_offset)
                head = f.read(30)
                if head[:4] != b"PK\x03\x04":
                    raise ValueError(f"no member at {info.header_offset}")
                name, extra = struct.unpack("<HH", head[26:30])
                f.seek(info.header_offset + 30 + name + extra)
                data = f.read(info.compress_size)
            if info.compress_type == zipfile.ZIP_DEFLATED:
                data = zlib.decompress(data, -15)
            if len(data) != info.file_size or zlib.crc32(data) != info.CRC:
                raise ValueError(f"checksum of the member at {info.header_offset}")
            return data, None
        except (OSError, ValueError, zlib.error, struct.error) as e:
            said = f"{type(e).__name__}: {e}"
    return None, said


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.range = int(options.get("rangebytes", 32 << 20))
        self.batch = int(options.get("batchbytes", 4 << 20))
        self.tries = int(options.get("tries", 3))

    def partitions(self):
        from pyarrow import fs as pfs

        fs, base = filesystem(self.folder)
        out = []
        for f in sorted(fs.get_file_info(pfs.FileSelector(base, recursive=True)), key=lambda f: f.path):
            if f.is_file and f.path.endswith(".zip"):
                parts = max(1, -(-f.size // self.range))
                edges = [f.size * i // parts for i in range(parts + 1)]
                out += [Range(f.path, a, b) for a, b in zip(edges, edges[1:])]
        return out or [Range("", 0, 0)]

    def read(self, part: Range):
        if not part.path:
            return
        fs, _ = filesystem(self.folder)
        with fs.open_input_file(part.path) as f:
            members = [m for m in zipfile.ZipFile(f).infolist() if part.first <= m.header_offset < part.last]
        rows, held = [], 0
        for m in sorted(members, key=lambda m: m.header_offset):
            data, error = fetch(fs, part.path, m, self.tries)
            rows.append((part.path, m.filename, m.header_offset, data, error))
            held += len(data or b"")
            if held >= self.batch:
                yield _rows(rows)
                rows, held = [], 0
        if rows:
            yield _rows(rows)


def _rows(rows):
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["archive", "member", "offset", "payload", "error"])


class ArchiveSource(DataSource):
    """``spark.read.format("member_archive").load(folder)``; options rangeBytes, batchBytes, tries."""

    @classmethod
    def name(cls):
        return "member_archive"

    def schema(self):
        return "archive string, member string, offset long, payload binary, error string"

    def reader(self, schema):
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    """All members of the archives below ``folder``."""
    ship(spark)
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("member_archive").options(**options).load(folder)


_MEDIA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_features(members: DataFrame) -> DataFrame:
    """Decode members and describe them; a member that could not be read raises, so no row is lost unseen."""
    ship(members.sparkSession)

    def run(batches):
        for b in batches:
            out = []
            for name, media, error in zip(b.column("member").to_pylist(), b.column("payload").to_pylist(), b.column("error").to_pylist()):
                if media is None:
                    raise ValueError(f"{name}: {error}")
                samples, n = decode_image(media)
                payload = samples.tobytes()
                key = name.rpartition("_")[0]
                out.append((int(key) if key else None, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if any(x is not None for x in c) else pa.array(c, pa.int64()) for c in zip(*out)], [x.split()[0] for x in _MEDIA.split(", ")])

    return members.select("member", "payload", "error").mapInArrow(run, _MEDIA)


def media_column(docs: DataFrame, folder: str) -> DataFrame:
    """Store every text, read the archives back and return a row of features per row.

    A null or empty text is 64 zero bytes.  A null doc_id stays null; repeated
    rows are members of their own with equal values; other columns are not looked
    at; an empty table stores nothing and gives an empty result.
    """
    write_archives(docs, folder).agg(F.sum("members")).collect()
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    return media_features(read_archives(docs.sparkSession, folder))
