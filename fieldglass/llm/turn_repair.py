"""Repair of the turn order of conversations by a retained-subsequence DP.

A repair chooses the turns to retain, each kept as it is or given another role; the
rest is deleted, and empty turns are inserted where two retained roles do not follow
one another.  Cost: rerole 1, delete 2, insert 5, and 5 for a truncated turn that is
retained; blank and repeated turns must go.  The roles left must read
``(s?(ua)+)?`` by their initials.

The state of the DP is the role retained last (none, s, u, a).  From the last turn to
the first it holds, for each role, the least price of retaining some later turn with
that role: the prefix sum of deletions up to that turn plus all that follows it.  The
price of a gap is then that running minimum less the prefix sum here, plus the inserts
that the pair of roles asks for.  Costs to go settle the ties: from the first turn on,
the least letter (D, I, K, R) that still reaches the least cost is the audit's next.

A conversation of any length is cut into stretches of ``stretch`` turns.  A stretch is
a 4 x 4 table of costs from each state to each, so costs to go at the cuts come from a
pass over such tables; with these every stretch finds its audit for each state it may
start in, and a pass from the front picks the ones that follow one another.  Turns
seen in an earlier stretch are found by a grouping of digests.  Only the digest of the
repaired text is taken turn after turn, as SHA-256 must be, from a stream and not from
a conversation in memory.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, partitions, ship
from .ordered import numbered

_SPACE = " \t\n\v\f\r"
_FAR = 1 << 60
_STATES = " sua"
_ROLE = {"u": "user", "a": "assistant"}
#: Inserts between the role retained last and the next one (s, u, a), and after the last one.
_BETWEEN = {(p, r): 0 for p, r in ((0, 1), (0, 2), (1, 2), (3, 2), (2, 3))} | {(p, r): 1 for p, r in ((0, 3), (1, 3), (3, 3), (2, 2))}
_AFTER = (0, 2, 1, 0)
_OPTIONS = [[(r, 5 * n) for (q, r), n in _BETWEEN.items() if q == p] for p in range(4)]
_END = tuple(5 * n for n in _AFTER)


def fault(role: str, text: str, seen: set) -> int:
    """0 none, 1 blank, 2 repeated, 3 truncated; the turn is added to ``seen``."""
    key = (role, text)
    again = key in seen
    seen.add(key)
    solid = text.rstrip(_SPACE)
    return 1 if not solid else 2 if again else 3 if solid[-1] not in ".!?" else 0


def price(initial: str, flaw: int, role: int) -> int:
    """What it costs to retain a turn in a role (1 s, 2 u, 3 a)."""
    if flaw in (1, 2):
        return _FAR
    return 5 * (flaw == 3) + (0 if initial == _STATES[role] else 1 if role > 1 else _FAR)


def costs_to_go(initials: str, flaws: str, end=_END) -> list[tuple]:
    """By turn and state (and after the last turn), the least cost of the rest, given that at the end."""
    n = len(initials)
    out = [end] * (n + 1)
    deleted = 2 * n  # prefix sum of deletions before turn i
    least = [_FAR] * 4  # by role: the least of prefix sum, price and rest over the turns from i on
    for i in range(n - 1, -1, -1):
        after = out[i + 1]
        deleted -= 2
        flaw, initial = int(flaws[i]), initials[i]
        for r in (1, 2, 3):
            x = deleted + price(initial, flaw, r) + after[r]
            if x < least[r]:
                least[r] = x
        out[i] = tuple(min(_FAR, end[p] + 2 * n - deleted, *(inserts + least[r] - deleted for r, inserts in _OPTIONS[p] if least[r] < _FAR)) for p in range(4))
    return out


def audit(initials: str, flaws: str, rest: list[tuple], state: int) -> tuple[str, int]:
    """(letters, state after the last turn): the ASCII-least of the cheapest edits from ``state``."""
    out = []
    for i, initial in enumerate(initials):
        here, after = rest[i][state], rest[i + 1]
        if here == 2 + after[state]:
            out.append("D")
            continue
        flaw = int(flaws[i])
        letters, state = min(("I" * (n // 5) + ("K" if initial == _STATES[r] else "R"), r) for r, n in _OPTIONS[state] if n + price(initial, flaw, r) + after[r] == here)
        out.append(letters)
    return "".join(out), state


def repaired(rows, letters: str, state: int):
    """(lines of the repaired turns, state): rows are (role, text), ``letters`` their audit."""
    rows = iter(rows)
    for x in letters:
        if x == "D":
            next(rows)
        elif x == "K":
            role, text = next(rows)
            state = _STATES.index(role[0])
            yield f"{role}:{text}", state
        else:
            state = 3 if state == 2 else 2
            text = next(rows)[1] if x == "R" else ""
            yield f"{_ROLE[_STATES[state]]}:{text}", state


class Tally:
    """Counts over turns in order: gaps, faults, pairs of roles out of order."""

    __slots__ = ("low", "high", "turns", "last", "faults", "illegal", "first_role", "role", "first_turn")

    def __init__(self):
        self.low = self.high = self.last = self.role = self.first_role = self.first_turn = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn, initial: str, flaw: int) -> None:
        if turn is not None:
            if self.low is None:
                self.low = self.first_turn = turn
            self.turns += turn != self.last
            self.high = self.last = turn
        if self.role is None:
            self.first_role = initial
        else:
            self.illegal += self.role + initial not in ("su", "ua", "au")
        self.role = initial
        self.faults[flaw] += 1

    def join(self, other: Tally) -> None:
        """Add what follows."""
        if other.role is None:
            return
        if other.low is not None:
            self.turns += other.turns - (other.first_turn == self.last)
            self.low = other.low if self.low is None else self.low
            self.high = self.last = other.high
        self.illegal += other.illegal
        if self.role is None:
            self.first_role = other.first_role
        else:
            self.illegal += self.role + other.first_role not in ("su", "ua", "au")
        self.role = other.role
        self.faults = [a + b for a, b in zip(self.faults, other.faults)]

    def row(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal)"""
        return (0 if self.low is None else self.high - self.low + 1 - self.turns, *self.faults[1:], self.illegal)

    def state(self) -> list:
        return [getattr(self, k) for k in self.__slots__]

    @classmethod
    def of(cls, state) -> Tally:
        out = cls()
        for k, v in zip(cls.__slots__, state):
            setattr(out, k, v)
        return out


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = [x.rsplit(" ", 1) for x in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])


def _stream(batches, *names):
    """Rows of batches as tuples."""
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in names))


def _chunked(rows, schema: str, size: int = 2000):
    while part := list(itertools.islice(rows, size)):
        yield _batch(part, schema)


def settle(turns) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of (turn, role, text) in order."""
    tally, seen, initials, flaws = Tally(), set(), [], []
    for turn, role, text in turns:
        flaw = fault(role, text, seen)
        tally.add(turn, role[:1], flaw)
        initials.append(role[:1] or " ")
        flaws.append(str(flaw))
    rest = costs_to_go("".join(initials), "".join(flaws))
    letters, state = audit("".join(initials), "".join(flaws), rest, 0)
    letters += "I" * _AFTER[state]
    text = "\n".join(x for x, _ in repaired(((r, t) for _, r, t in turns), letters, 0))
    return (*tally.row(), rest[0][0], letters, hashlib.sha256(text.encode()).hexdigest())


def _short(rows: DataFrame) -> DataFrame:
    """Conversations of one stretch, each settled where it lies."""

    def run(batches):
        def each():
            for conv, part in itertools.groupby(_stream(batches, "conv_id", "turn", "role", "text", "there"), key=lambda x: x[0]):
                yield (conv, *settle([x[1:4] for x in part if x[4]]))

        yield from _chunked(each(), _RESULT)

    n = partitions(rows.sparkSession)
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "pos", "copy").select("conv_id", "turn", "role", "text", "there").mapInArrow(run, _RESULT)


def _long(rows: DataFrame, space: Workspace) -> DataFrame:
    """Conversations of several stretches."""
    spark = rows.sparkSession
    n = partitions(spark)
    own = rows.withColumn("digest", F.sha2(F.concat(F.octet_length("role"), F.lit(":"), "role", "text"), 256))
    seen = own.where("there").select("conv_id", "seg", "digest").distinct()
    first = seen.groupBy("conv_id", "digest").agg(F.min("seg").alias("first")).withColumnsRenamed({"conv_id": "c", "digest": "d"})
    again = seen.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")) & (F.col("seg") > F.col("first"))).groupBy("conv_id", "seg").agg(F.collect_list("digest").alias("again"))
    lead = again.select("conv_id", "seg", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("copy"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("there"), F.lit(None).cast("string").alias("digest"), "again")
    columns = ["conv_id", "seg", "pos", "copy", "turn", "role", "text", "there", "digest", "again"]
    marked = own.withColumn("again", F.lit(None).cast("array<string>")).select(columns).unionByName(lead)

    parts = "conv_id long, seg long, tally string, initials string, flaws string, costs array<long>"

    def summaries(batches):
        import json

        def each():
            for (conv, seg), part in itertools.groupby(_stream(batches, "conv_id", "seg", "turn", "role", "text", "there", "digest", "again"), key=lambda x: x[:2]):
                tally, met, initials, flaws = Tally(), set(), [], []
                for _, _, turn, role, text, there, key, before in part:
                    if before is not None:
                        met.update(before)
                    if there:
                        flaw = fault(role, text, set())
                        flaw = 2 if key in met and flaw != 1 else flaw
                        met.add(key)
                        tally.add(turn, role[:1], flaw)
                        initials.append(role[:1] or " ")
                        flaws.append(str(flaw))
                i, f = "".join(initials), "".join(flaws)
                ends = [costs_to_go(i, f, tuple(0 if q == r else _FAR for q in range(4)))[0] for r in range(4)]
                yield conv, seg, json.dumps(tally.state()), i, f, [ends[r][p] for p in range(4) for r in range(4)]

        yield from _chunked(each(), parts, 50)

    cut = space.write(marked.repartition(n, "conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos", "copy").mapInArrow(summaries, parts), "stretches")

    def from_the_end(batches):
        def each():
            for conv, part in itertools.groupby(_stream(batches, "conv_id", "seg", "costs"), key=lambda x: x[0]):
                end = _END
                for _, seg, costs in part:
                    yield conv, seg, list(end)
                    end = tuple(min(min(costs[4 * p + r] + end[r] for r in range(4)), _FAR) for p in range(4))

        yield from _chunked(each(), "conv_id long, seg long, end array<long>")

    ends = cut.select("conv_id", "seg", "costs").repartition(n, "conv_id").sortWithinPartitions("conv_id", F.desc("seg")).mapInArrow(from_the_end, "conv_id long, seg long, end array<long>").withColumnsRenamed({"conv_id": "c", "seg": "s"})
    ways = "conv_id long, seg long, tally string, cost long, letters array<string>, exits array<long>"

    def audits(batches):
        def each():
            for conv, seg, tally, i, f, end in _stream(batches, "conv_id", "seg", "tally", "initials", "flaws", "end"):
                rest = costs_to_go(i, f, tuple(end))
                found = [audit(i, f, rest, p) if rest[0][p] < _FAR else ("", 0) for p in range(4)]
                yield conv, seg, tally, rest[0][0], [x for x, _ in found], [x for _, x in found]

        yield from _chunked(each(), ways, 50)

    met = cut.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))).select("conv_id", "seg", "tally", "initials", "flaws", "end").mapInArrow(audits, ways)
    picked = "conv_id long, seg long, letters string, state long, tally string, cost long, last boolean"

    def from_the_front(batches):
        import json

        def each():
            for conv, part in itertools.groupby(_stream(batches, "conv_id", "seg", "tally", "cost", "letters", "exits"), key=lambda x: x[0]):
                state, total, cost, held = 0, Tally(), 0, None
                for _, seg, tally, own, letters, exits in part:
                    if held:
                        yield (*held, None, None, False)
                    cost = own if held is None else cost
                    total.join(Tally.of(json.loads(tally)))
                    held = [conv, seg, letters[state], state]
                    state = exits[state]
                held[2] += "I" * _AFTER[state]
                yield (*held, json.dumps(total.state()), cost, True)

        yield from _chunked(each(), picked, 50)

    chosen = space.write(met.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(from_the_front, picked), "chosen")
    lead = chosen.select("conv_id", "seg", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("copy"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "letters", "state", "tally", "cost", "last")
    turns = rows.where("there").select("conv_id", "seg", "pos", "copy", "role", "text", *[F.lit(None).cast(k).alias(c) for c, k in (("letters", "string"), ("state", "long"), ("tally", "string"), ("cost", "long"), ("last", "boolean"))])
    lines = "conv_id long, seg long, k long, line string, letters string, tally string, cost long"

    def written_out(batches):
        def each():
            for (conv, seg), part in itertools.groupby(_stream(batches, "conv_id", "seg", "role", "text", "letters", "state", "tally", "cost"), key=lambda x: x[:2]):
                _, _, _, _, letters, state, tally, cost = next(part)
                yield conv, seg, -1, None, letters, tally, cost
                for k, (line, _) in enumerate(repaired((x[2:4] for x in part), letters, state)):
                    yield conv, seg, k, line, None, None, None

        yield from _chunked(each(), lines)

    out = turns.unionByName(lead).repartition(n, "conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos", "copy").mapInArrow(written_out, lines)

    def digests(batches):
        import json

        def each():
            for conv, part in itertools.groupby(_stream(batches, "conv_id", "k", "line", "letters", "tally", "cost"), key=lambda x: x[0]):
                sha, letters, tally, cost, first = hashlib.sha256(), [], None, 0, True
                for _, k, line, some, tallied, price_ in part:
                    if k < 0:
                        letters.append(some)
                        tally, cost = (tallied, price_) if tallied else (tally, cost)
                        continue
                    sha.update((line if first else "\n" + line).encode())
                    first = False
                yield (conv, *Tally.of(json.loads(tally)).row(), cost, "".join(letters), sha.hexdigest())

        yield from _chunked(each(), _RESULT, 20)

    return out.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg", "k").mapInArrow(digests, _RESULT)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the damage that crc32 of ``conv_id:turn`` names, copy (0, 1) and there (not dropped)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate(F.col("text"), ".!?", "")).otherwise(F.col("text"))
    out = rows.withColumn("_code", code).withColumn("text", text).withColumn("role", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("copy", F.explode(copies)).withColumn("there", F.col("_code") != 0).drop("_code")


def repair(conversations: DataFrame, damage=damaged, stretch: int = 4096) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, one row per conv_id.

    A null role or text counts as one space; rows stand by turn, null first, then
    role and the digest of the text (both before damage).  A null conv_id is a
    conversation of its own.  ``damage`` gets and returns rows with conv_id, turn,
    role, text and adds copy (their order where a row stands several times) and
    there (false for dropped rows); None repairs the rows as they are.  Other columns
    are not looked at; rows that repeat are turns each, the later ones duplicates; an
    empty table gives no rows.  A task holds ``stretch`` turns of a conversation, and
    the whole of it only if it has no more.
    """
    ship(conversations.sparkSession)
    space = Workspace(conversations.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))
    laid = numbered(rows.withColumn("tie", F.sha2("text", 256)), "conv_id", ["turn", "role", "tie"], space).drop("tie")
    laid = laid.withColumn("seg", F.floor(F.col("pos") / stretch))
    done = damage(laid) if damage else laid.withColumn("copy", F.lit(0)).withColumn("there", F.lit(True))
    return _short(done.where(F.col("of") <= stretch)).unionByName(_long(done.where(F.col("of") > stretch), space))


def brute_force(turns) -> tuple:
    """The result for (turn, role, text) of one conversation in order by the definitions alone, for tests: edits are tried in the order of cost and letters."""
    import re

    seen, flaws = set(), []
    for _, role, text in turns:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        flaws.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
        seen.add((role, text))
    todo, met = [(0, "", 0, ())], set()  # cost, letters, rows used, turns left: the cheapest first, then the ASCII-least
    while True:
        cost, letters, i, kept = heapq.heappop(todo)
        pattern = "".join(r[:1] or " " for r, _ in kept)
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", pattern):
            best = cost, letters, "\n".join(f"{r}:{t}" for r, t in kept)
            break
        if (i, pattern[-1:]) in met or not re.fullmatch("(s?(ua)*u?)?", pattern):
            continue
        met.add((i, pattern[-1:]))
        if i < len(turns):
            _, role, text = turns[i]
            heapq.heappush(todo, (cost + 2, letters + "D", i + 1, kept))
            if flaws[i] not in (1, 2):
                more = cost + 5 * (flaws[i] == 3)
                heapq.heappush(todo, (more, letters + "K", i + 1, (*kept, (role, text))))
                for r in ("user", "assistant"):
                    heapq.heappush(todo, (more + 1, letters + "R", i + 1, (*kept, (r, text))))
        for r in ("user", "assistant"):
            heapq.heappush(todo, (cost + 5, letters + "I", i, (*kept, (r, ""))))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    roles = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return (gaps, *(flaws.count(k) for k in (1, 2, 3)), illegal, best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def oracle() -> str:
    """The rows of the query over ``conversations``: a fold that holds, by state, the cheapest edits so far and their ASCII-least letters."""
    big = 1000000000
    s = lambda c, a: f"{{'c': {c}, 'a': {a}}}"
    st = lambda p: f"g.st[{p + 1}]"
    delete = lambda q: s(f"{st(q)}.c + 2", f"{st(q)}.a || 'D'")

    def take(p, q, ins):
        price = f"CASE WHEN r.flaw IN (1, 2) THEN {big} ELSE CASE WHEN r.flaw = 3 THEN 5 ELSE 0 END + CASE WHEN r.ini = '{' sua'[q]}' THEN 0 ELSE {1 if q > 1 else big} END END"
        return s(f"{st(p)}.c + {5 * ins} + {price}", f"{st(p)}.a || '{'I' * ins}' || CASE WHEN r.ini = '{' sua'[q]}' THEN 'K' ELSE 'R' END")

    ways = {1: [(0, 0)], 2: [(0, 0), (1, 0), (3, 0), (2, 1)], 3: [(2, 0), (0, 1), (1, 1), (3, 1)]}
    new = [delete(0)] + [f"list_min([{', '.join([delete(q)] + [take(p, q, i) for p, i in ways[q]])}])" for q in (1, 2, 3)]
    start = "[" + ", ".join(s(f"{0 if p == 0 else big}::BIGINT", "''") for p in range(4)) + "]"
    end = "list_min([" + ", ".join(s(f"z.st[{p + 1}].c + {5 * n}", f"z.st[{p + 1}].a || '{'I' * n}'") for p, n in enumerate((0, 2, 1, 0))) + "])"
    return f"""
        WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t),
        k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT) AS b FROM conversations),
        h AS (SELECT *, xor(list_reduce([4294967295::UBIGINT] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 20 AS code FROM k, crc),
        e AS (SELECT conv_id, turn, role AS was, sha256(text) AS tie, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
        m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, was, tie, copy) AS i, substr(role, 1, 1) AS ini FROM e),
        n AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS flaw, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM m),
        a AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (flaw = 1) AS blank, count(*) FILTER (flaw = 2) AS duplicate, count(*) FILTER (flaw = 3) AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
            list({{'st': {start}, 'ini': ini, 'flaw': flaw}} ORDER BY i) AS rs FROM n GROUP BY conv_id),
        y AS (SELECT *, list_reduce([{{'st': {start}, 'ini': '', 'flaw': 0}}] || rs, lambda g, r: {{'st': [{', '.join(new)}], 'ini': '', 'flaw': 0}}) AS z FROM a),
        w AS (SELECT *, {end} AS best FROM y),
        l AS (SELECT conv_id, unnest(string_split(best.a, '')) AS x, generate_subscripts(string_split(best.a, ''), 1) AS j FROM w WHERE best.a <> ''),
        p AS (SELECT *, sum((x <> 'I')::INT) OVER v AS i, sum((x <> 'D')::INT) OVER v - 1 AS o FROM l WINDOW v AS (PARTITION BY conv_id ORDER BY j)),
        q AS (SELECT p.*, role, text, max((o = 0 AND x = 'K' AND ini = 's')::INT) OVER (PARTITION BY p.conv_id) AS s FROM p LEFT JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id AND p.i = n.i),
        u AS (SELECT conv_id, string_agg(CASE WHEN x = 'K' THEN role WHEN (o - s) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS t FROM q WHERE x <> 'D' GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN w ON c.conv_id IS NOT DISTINCT FROM w.conv_id LEFT JOIN u ON c.conv_id IS NOT DISTINCT FROM u.conv_id"""
