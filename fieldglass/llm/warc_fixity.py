"""Merkle fixity audit of WARC replicas.

Every record (one gzip member) is hashed; the records of a file in the order of
their offsets are the leaves of a tree, and each inner node hashes the hashes of a
range of ``fanout`` consecutive nodes below it.  Two replicas are compared from
their roots; only children of nodes that differ are looked at on the next level,
down to the records.  Nodes are rows, a level is one grouped hash over bounded
groups, written once, and a descent is a join with the mismatching parents, so neither
a long file nor a damaged one gathers anywhere.  Bytes after the last record of a
file belong to no leaf and are looked for apart.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, filesystem, ship, written
from .grams import slices

_INDEX = "shard int, seq long, offset long, length long, key long, n_bytes long, payload_sha256 string"
_LEAVES = "shard int, seq long, hash string, n_bytes long, payload_sha256 string"
_HEAD_END = re.compile(rb"\r\nWARC-Payload-Digest: sha256:([0-9a-f]{64})\r\nContent-Type: text/html\r\nContent-Length: (\d+)\r\n\r\n")

#: What a header line cannot hold; it is percent-encoded.
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record(url: str | None, body: bytes, record_id: str) -> bytes:
    """One WARC/1.1 resource record as a gzip member."""
    digest = hashlib.sha256(body).hexdigest()
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{record_id}>\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: {target}\r\nWARC-Payload-Digest: sha256:{digest}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", 1, mtime=0)


def payload(data: bytes) -> tuple[int, str] | None:
    """Length and digest of the body of a record, or None if it is not a whole record that agrees with its own head."""
    try:
        text = gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return None
    m = _HEAD_END.search(text)
    if not m or text[m.end() + int(m.group(2)) :] != b"\r\n\r\n":
        return None
    body = text[m.end() : -4]
    digest = hashlib.sha256(body).hexdigest()
    return (len(body), digest) if digest == m.group(1).decode() and len(body) == int(m.group(2)) else None


def write_warc(pages: DataFrame, folder: str, key: str = "page_id") -> DataFrame:
    """Write pages to WARC files, one a task; returns an index row per record.

    Runs when the result is used, so write the index to a table before reading on.
    A null html is an empty body, a null url an empty target; keys may be null and
    rows repeat, since every record has an id of its own file and place; other
    columns are not looked at; an empty table writes no file.
    """
    ship(pages.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        shard = TaskContext.get().partitionId()
        own, out, at, seq = f"{base}/.{uuid.uuid4().hex}", None, 0, 0
        for whole in batches:
            for i, j in slices(whole.column("html"), 4 << 20):
                b, rows = whole.slice(i, j - i), []
                for k, url, html in zip(*(b.column(c).to_pylist() for c in (0, 1, 2))):
                    out = out or fs.open_output_stream(own)
                    body = (html or "").encode()
                    data = record(url, body, str(uuid.uuid5(uuid.NAMESPACE_URL, f"{shard} {seq} {k} {url}")))
                    out.write(data)
                    rows.append((shard, seq, at, len(data), k, len(body), hashlib.sha256(body).hexdigest()))
                    at, seq = at + len(data), seq + 1
                kinds = (pa.int32(), *[pa.int64()] * 5, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in _INDEX.split(", ")])
        if out:
            out.close()
            fs.move(own, f"{base}/{shard:06d}.warc.gz")

    return pages.select(F.col(key).cast("long"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, _INDEX)


def copy_replica(index: DataFrame, source: str, target: str, damage=None) -> DataFrame:
    """Copy the files of a replica; ``damage(key)`` says which records get their last byte flipped (a drill).

    A task copies one file, record by record; an empty index copies nothing.
    """
    ship(index.sparkSession)

    def run(t: pa.Table) -> pa.Table:
        shard = t.column("shard")[0].as_py()
        (fs, a), (to, b) = filesystem(source), filesystem(target)
        to.create_dir(b, recursive=True)
        rows = sorted(t.select(["offset", "length", "key"]).to_pylist(), key=lambda r: r["offset"])
        own = f"{b}/.{uuid.uuid4().hex}"
        with fs.open_input_file(f"{a}/{shard:06d}.warc.gz") as f, to.open_output_stream(own) as out:
            for r in rows:
                data = f.read(r["length"])
                if damage and damage(r["key"]):
                    data = data[:-1] + bytes([data[-1] ^ 1])
                out.write(data)
        to.move(own, f"{b}/{shard:06d}.warc.gz")
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(rows)], pa.int64())})

    return index.select("shard", "offset", "length", "key").groupBy("shard").applyInArrow(run, "shard int, n long")


def leaves(index: DataFrame, folder: str) -> DataFrame:
    """The hash of every indexed record as a replica holds it, and its body's length and digest; null where it cannot be read."""
    ship(index.sparkSession)

    def run(batches):
        fs, base = filesystem(folder)
        last, f = None, None
        for b in batches:
            out = []
            for s, q, o, n in zip(*(b.column(c).to_pylist() for c in ("shard", "seq", "offset", "length"))):
                if s != last:
                    if f:
                        f.close()
                    last = s
                    try:
                        f = fs.open_input_file(f"{base}/{s:06d}.warc.gz")
                    except OSError:
                        f = None
                data = None
                if f:
                    f.seek(min(o, f.size()))
                    data = f.read(n)
                whole = data is not None and len(data) == n
                out.append((s, q, hashlib.sha256(data).hexdigest() if whole else None, *(whole and payload(data) or (None, None))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()))], [x.split()[0] for x in _LEAVES.split(", ")])

    return index.select("shard", "seq", "offset", "length").mapInArrow(run, _LEAVES)


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level above: one node for each range of ``fanout`` nodes in order."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("hash", F.lit("-")).alias("hash"))))
    return nodes.groupBy("shard", F.floor(F.col("seq") / fanout).cast("long").alias("seq")).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["hash"]), ""), 256).alias("hash"))


def tails(index: DataFrame, folder: str) -> DataFrame:
    """(shard, seq, hash, n_bytes) of what a replica's files hold after their last record; no row where there is nothing."""
    ship(index.sparkSession)

    def run(batches):
        fs, base = filesystem(folder)
        for b in batches:
            for r in b.to_pylist():
                try:
                    f = fs.open_input_file(f"{base}/{r['shard']:06d}.warc.gz")
                except OSError:
                    continue
                with f:
                    size = f.size() - r["end"]
                    if size <= 0:
                        continue
                    f.seek(r["end"])
                    digest = hashlib.sha256()
                    while part := f.read(4 << 20):
                        digest.update(part)
                yield pa.RecordBatch.from_arrays([pa.array([r["shard"]], pa.int32()), pa.array([r["n"]], pa.int64()), pa.array([digest.hexdigest()]), pa.array([size], pa.int64())], ["shard", "seq", "hash", "n_bytes"])

    ends = index.groupBy("shard").agg(F.max(F.col("offset") + F.col("length")).alias("end"), F.max(F.col("seq") + 1).alias("n"))
    return ends.mapInArrow(run, "shard int, seq long, hash string, n_bytes long")


def mismatches(a: DataFrame, b: DataFrame, longest: int, fanout: int = 16) -> DataFrame:
    """(shard, seq) of records that differ between two replicas' leaves.

    ``longest`` is the largest number of records in a file; it sets the height of
    the trees.  Records that only one side has differ too, and so do records that
    neither can give.
    """
    space = Workspace(a.sparkSession)
    a, b = (x.select("shard", "seq", F.coalesce("hash", F.lit(side)).alias("hash")) for x, side in ((a, "none in a"), (b, "none in b")))
    levels, n = [(a, b)], longest
    while n > 1:
        levels.append(tuple(space.write(parents(x, fanout), "level") for x in levels[-1]))
        n = -(-n // fanout)
    found = None
    for x, y in reversed(levels):
        if found is not None:
            under = found.select("shard", F.explode(F.sequence(F.col("seq") * fanout, F.col("seq") * fanout + fanout - 1)).alias("seq"))
            x, y = (z.join(under, ["shard", "seq"], "left_semi") for z in (x, y))
        both = x.select("shard", "seq", F.coalesce("hash", F.lit("-")).alias("_a")).join(y.select("shard", "seq", F.coalesce("hash", F.lit("-")).alias("_b")), ["shard", "seq"], "full")
        found = both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("shard", "seq")
    return found


def audit(index: DataFrame, replica_a: str, replica_b: str, fanout: int = 16) -> DataFrame:
    """Index rows with ``status``: 'ok', or 'mismatch' where the replicas differ.

    A record that a replica lacks or cannot give counts as different, also if both
    do; so does one whose body is not what the index says.  n_bytes and
    payload_sha256 are those of the record read back, from the second replica where
    the first does not give it, and null where neither does.  Bytes that a file of
    either replica holds after its last record are one more 'mismatch' row of that
    shard, with the place after the last, n_bytes of them and the other columns null.
    An empty index gives an empty result; keys may be null or repeat, since records go
    by shard and place.
    """
    a, b = (written(leaves(index, r), "leaves") for r in (replica_a, replica_b))
    longest = index.agg(F.max("seq")).first()[0]
    bad = mismatches(a, b, (longest or 0) + 1, fanout)
    second = bad.join(b, ["shard", "seq"], "left").select("shard", "seq", F.lit(True).alias("_bad"), F.col("n_bytes").alias("_n_b"), F.col("payload_sha256").alias("_p_b"))
    first = a.select("shard", "seq", F.col("n_bytes").alias("_n_a"), F.col("payload_sha256").alias("_p_a"))
    n, p = F.coalesce("_n_a", "_n_b"), F.coalesce("_p_a", "_p_b")
    same = n.eqNullSafe(F.col("n_bytes")) & p.eqNullSafe(F.col("payload_sha256"))
    status = F.when(F.col("_bad").isNull() & same, "ok").otherwise("mismatch")
    read = {"n_bytes": n, "payload_sha256": p}
    out = index.join(first, ["shard", "seq"], "left").join(second, ["shard", "seq"], "left")
    out = out.select(*[read.get(c, F.col(c)).alias(c) for c in index.columns], status.alias("status"))
    extra = tails(index, replica_a).unionByName(tails(index, replica_b)).groupBy("shard", "seq").agg(F.max("n_bytes").alias("n_bytes"))
    shown = {"shard": F.col("shard"), "seq": F.col("seq"), "n_bytes": F.col("n_bytes")}
    return out.unionByName(extra.select(*[shown.get(c, F.lit(None).cast(index.schema[c].dataType)).alias(c) for c in index.columns], F.lit("mismatch").alias("status")))
