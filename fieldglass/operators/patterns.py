"""Many patterns looked for in one pass over a text."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .stored import settled


class Automaton:
    """States of a trie over all patterns, with a way back to the longest suffix that is a state too.

    ``best[s]`` is the least place of a pattern that ends in state s, its own or one
    that ends in a suffix, so a text's first pattern in order needs one look a
    character.  Patterns are (place, text); of equal texts the least place counts.
    """

    def __init__(self, patterns):
        self.step: list[dict[str, int]] = [{}]
        self.best: list[int | None] = [None]
        for place, text in patterns:
            at = 0
            for c in text:
                to = self.step[at].get(c)
                if to is None:
                    to = self.step[at][c] = len(self.step)
                    self.step.append({})
                    self.best.append(None)
                at = to
            if self.best[at] is None or place < self.best[at]:
                self.best[at] = place
        self.back = [0] * len(self.step)
        todo = deque(self.step[0].values())
        while todo:
            at = todo.popleft()
            for c, to in self.step[at].items():
                todo.append(to)
                s = self.back[at]
                while s and c not in self.step[s]:
                    s = self.back[s]
                s = self.step[s].get(c, 0)
                self.back[to] = s
                if self.best[s] is not None and (self.best[to] is None or self.best[s] < self.best[to]):
                    self.best[to] = self.best[s]

    def first(self, text: str) -> int | None:
        """The least place of a pattern that ``text`` contains."""
        step, back, best = self.step, self.back, self.best
        found, s = best[0], 0
        for c in text:
            while s and c not in step[s]:
                s = back[s]
            s = step[s].get(c, 0)
            b = best[s]
            if b is not None and (found is None or b < found):
                found = b
        return found


def first_in_group(texts: DataFrame, key: str, text: str, patterns: DataFrame, place: str, pattern: str, group: str) -> DataFrame:
    """(key, place): of each text, the least place of a pattern of its own group that it contains; texts without one are left out.

    ``group`` is a column of both sides.  Each group's patterns stand before its
    texts in one sorted stream, so a task holds one group's automaton and a batch of
    texts.  NULL texts, patterns and groups match nothing; an empty pattern is in
    every text.  Places are whole numbers.
    """
    ship(texts.sparkSession)
    kind = texts.schema[key].dataType
    own = patterns.where(F.col(group).isNotNull() & F.col(pattern).isNotNull() & F.col(place).isNotNull()).select(F.col(group).alias("g"), F.lit(0).alias("turn"), F.col(place).cast("long").alias("place"), F.col(pattern).alias("t"), F.lit(None).cast(kind).alias("key"))
    asked = texts.where(F.col(group).isNotNull() & F.col(text).isNotNull()).select(F.col(group).alias("g"), F.lit(1).alias("turn"), F.lit(None).cast("long").alias("place"), F.col(text).alias("t"), F.col(key).alias("key"))

    def run(batches):
        group_now, machine, held = object(), None, []
        for b in batches:
            keys, places = [], []
            for g, turn, at, t, k in zip(*(b.column(c).to_pylist() for c in ("g", "turn", "place", "t", "key"))):
                if g != group_now:
                    group_now, machine, held = g, None, []
                if not turn:
                    held.append((at, t))
                elif held:
                    machine = machine or Automaton(held)
                    found = machine.first(t)
                    if found is not None:
                        keys.append(k)
                        places.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.column("key").type), pa.array(places, pa.int64())], [key, "place"])

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    both = own.unionByName(asked).repartition(n, "g").sortWithinPartitions("g", "turn")
    return both.select("g", "turn", "place", "t", "key").mapInArrow(run, f"`{key}` {kind.simpleString()}, place long")


class Anchors(Automaton):
    """Texts (place or None if only a beginning, text, sizes of the patterns that begin so) and where a text has beginnings."""

    def __init__(self, anchors):
        anchors = list(anchors)
        super().__init__([(i, t) for i, (_, t, _) in enumerate(anchors)])
        self.place, self.size = [p for p, _, _ in anchors], [len(t) for _, t, _ in anchors]
        self.sizes = [s or () for _, _, s in anchors]
        own = {t: i for i, (_, t, _) in enumerate(anchors)}
        self.here: list[tuple[int, ...]] = [()] * len(self.step)
        todo = deque([(0, "")])
        order = []
        while todo:
            at, t = todo.popleft()
            order.append(at)
            self.here[at] = (own[t],) if t in own else ()
            todo.extend((to, t + c) for c, to in self.step[at].items())
        for at in order[1:]:  # shorter ones are whole by now
            self.here[at] += self.here[self.back[at]]

    def look(self, text: str) -> tuple[int | None, set[str]]:
        """The least place of an anchor that is a pattern, and the parts of ``text`` that may be longer ones."""
        step, back, here = self.step, self.back, self.here
        least, parts, s = None, set(), 0
        for i in here[0]:
            least = self.place[i]
        for at, c in enumerate(text, 1):
            while s and c not in step[s]:
                s = back[s]
            s = step[s].get(c, 0)
            for i in here[s]:
                p = self.place[i]
                if p is not None and (least is None or p < least):
                    least = p
                for n in self.sizes[i]:
                    end = at - self.size[i] + n
                    if end <= len(text):
                        parts.add(text[end - n : end])
        return least, parts


def first_of_all(texts: DataFrame, key: str, text: str, patterns: DataFrame, place: str, pattern: str, most: int = 100_000, most_chars: int = 1_000_000) -> DataFrame:
    """(key, place): of each text, the least place of a pattern that it contains; texts without one are left out.

    Up to ``most`` patterns and ``most_chars`` characters are one automaton.  Of more,
    the automaton holds their beginnings, as long as fit, and a text goes once through
    it: where one begins, the parts of the text as long as the patterns that begin so
    are looked up by an equality join.  NULL texts and patterns match nothing.  Keys
    need not be unique: each row is a text of its own, but if beginnings are looked
    up, rows of one key are one text.
    """
    spark = texts.sparkSession
    ship(spark)
    kind = texts.schema[key].dataType
    own = patterns.where(F.col(pattern).isNotNull() & F.col(place).isNotNull()).groupBy(F.col(pattern).alias("t")).agg(F.min(F.col(place).cast("long")).alias("place"))
    sums = [F.count("*").alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("chars")]
    size = own.agg(*sums).first()
    fits = lambda x: x.n <= most and x.chars <= most_chars
    asked = texts.select(F.col(key).alias("key"), F.col(text).alias("t"))
    if fits(size):
        part = own.select("place", "t").toArrow()
        sent = spark.sparkContext.broadcast((part.column("place").to_pylist(), part.column("t").to_pylist()))

        def run(batches):
            machine = Automaton(zip(*sent.value))
            for b in batches:
                at = [None if t is None else machine.first(t) for t in b.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(at, pa.int64())], [key, "place"])

        return asked.mapInArrow(run, f"`{key}` {kind.simpleString()}, place long").where("place is not null")

    for n in (16, 12, 8, 6, 5, 4, 3, 2, 1):
        begin = own.groupBy(F.substring("t", 1, n).alias("a")).agg(F.min(F.when(F.length("t") <= n, F.col("place"))).alias("place"), F.collect_set(F.when(F.length("t") > n, F.length("t"))).alias("sizes"))
        if n == 1 or fits(begin.agg(F.count("*").alias("n"), F.sum(F.length("a")).alias("chars")).first()):
            break
    part = begin.toArrow()  # of bounded size
    sent = spark.sparkContext.broadcast(tuple(part.column(c).to_pylist() for c in ("place", "a", "sizes")))

    def look(batches):
        machine = Anchors(zip(*sent.value))
        for b in batches:
            at, places, parts = [], [], []
            for i, t in enumerate(b.column("t").to_pylist()):
                least, found = (None, ()) if t is None else machine.look(t)
                for p, x in ((least, None),) * (least is not None) + tuple((None, x) for x in found):
                    at.append(i)
                    places.append(p)
                    parts.append(x)
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(at, pa.int32())), pa.array(places, pa.int64()), pa.array(parts, pa.string())], [key, "place", "t"])

    seen = settled(asked.mapInArrow(look, f"`{key}` {kind.simpleString()}, place long, t string"))
    longer = seen.where("t is not null").select(key, "t").join(own, "t").select(key, "place")
    return seen.where("place is not null").select(key, "place").unionByName(longer).groupBy(key).agg(F.min("place").alias("place"))
