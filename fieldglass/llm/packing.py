"""Sum-of-squares online packing of tokenized documents into fixed windows.

The state of a packer is a level array: counts[h] is the number of windows
filled to h tokens, 0 < h < window.  An item of s tokens goes to the level (or a
new window) for which the sum of the squared counts grows least, so no level
piles up and most levels keep partners for what comes next.  Documents longer
than a window give off full windows first; only their rest is placed.

Each partition packs its own stream in one pass.  Windows leave as soon as they are
full.  Windows that find no partners (say, where all pieces are a little over half a
window) would grow without end: once open windows hold more than ``most_bytes`` of
ids, two windows of the fullest level (that with most windows) are laid end to end,
cut where the first is full, and the rest takes its own level, again and again until
they hold less.  The bound is far above what windows that find partners need, so it
decides nothing but how much a task may hold.  At the end of the partition the open
windows are laid end to end in the same way, which leaves one short window, so a
partition pads less than a window whatever the lengths are.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .grams import slices
from .tokens import encoder

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Levels:
    """The level array: which level an item goes to."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)

    def place(self, size: int) -> int:
        """The level to put ``size`` tokens on (0: a new window); the array follows.

        Ties go to the fullest level, and to a new window last.
        """
        c, w = self.counts, self.window
        best, least = 0, 2 * c[size] + 1 if size < w else 0
        levels = np.flatnonzero(c[1 : w - size + 1]) + 1
        if len(levels):
            after = 2 * c[levels + size] + 1
            after[levels + size == w] = 0
            cost = after - 2 * c[levels] + 1
            at = len(cost) - 1 - int(cost[::-1].argmin())
            if cost[at] <= least:
                best = int(levels[at])
        if best:
            c[best] -= 1
        if best + size < w:
            c[best + size] += 1
        return best


class Packer:
    """Packs one stream; ``rows`` gathers (doc, start, crc, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, most_bytes: int, first_sequence: int):
        self.window, self.most, self.held = window, most_bytes // 4, 0
        self.levels = Levels(window)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.next = first_sequence
        self.rows: list[tuple] = []

    def _emit(self, items: list) -> None:
        offset = 0
        for doc, start, ids, total in items:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, w = len(ids), self.window
        full = total // w * w
        for a in range(0, full, w):
            self._emit([(doc, a, ids[a : a + w], total)])
        if full == total:
            return
        size = total - full
        level = self.levels.place(size)
        items = self.open[level].pop() if level else []
        items.append((doc, full, ids[full:].copy(), total))
        self.held += size
        if level + size == w:
            self.held -= w
            self._emit(items)
        else:
            self.open[level + size].append(items)
            while self.held > self.most and self._settle():
                pass

    def _settle(self) -> bool:
        """Join two windows of the fullest level; False where no level holds two."""
        level = int(self.levels.counts[1 : self.window].argmax()) + 1
        if self.levels.counts[level] < 2:
            return False
        room = self.window - level
        row, rest = self.open[level].pop(), []
        for doc, start, ids, total in self.open[level].pop():
            part, ids = ids[:room], ids[room:]
            room -= len(part)
            if len(part):
                row.append((doc, start, part, total))
            if len(ids):
                rest.append((doc, start + len(part), ids, total))
        self.levels.counts[level] -= 2
        size = min(2 * level, self.window)
        if size == self.window:
            self.held -= size
            self._emit(row)
        for at, items in ((size, row), (2 * level - size, rest)):
            if 0 < at < self.window:
                self.open[at].append(items)
                self.levels.counts[at] += 1
        return True

    def flush(self) -> None:
        """Cut and join all open windows, the emptiest first."""
        left: list = []
        for level in range(1, self.window):
            for items in self.open[level]:
                left += items
            self.open[level] = []
        self.levels.counts[:] = 0
        self.held = 0
        row, room = [], self.window
        for doc, start, ids, total in left:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                row.append((doc, start, part, total))
                start += len(part)
                room -= len(part)
                if not room:
                    self._emit(row)
                    row, room = [], self.window
        if row:
            self._emit(row)


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, most_bytes: int = 64 << 20) -> DataFrame:
    """One row per piece of a document; see the module for the method.

    A null or empty text is its end id alone.  A null doc_id stays null, rows
    that repeat a doc_id are packed each, other columns are not looked at, and an
    empty table gives no rows.  A sequence is all rows with one sequence_id, laid
    at their offsets without gaps; what is missing to ``window`` is padding.
    """
    ship(docs.sparkSession)

    def run(batches):
        enc = encoder(tokenizer)
        packer = Packer(window, most_bytes, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], "<u4").tobytes()

        def batch():
            cols = list(zip(*packer.rows))
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [x.split()[0] for x in _PIECES.split(", ")])

        for b in batches:
            for i, j in slices(b.column("text"), 2 << 20):
                part = b.slice(i, j - i)
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.ids(part.column("text").to_pylist())):
                    packer.add(doc, np.frombuffer(ids + end, "<u4"))
                if packer.rows:
                    yield batch()
        packer.flush()
        if packer.rows:
            yield batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECES)
