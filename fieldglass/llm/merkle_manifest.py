"""Merkle manifest of a dataset: a digest for every row, source and the whole, with a proof for each row.

Rows are leaves; the leaves of a source stand in the order of their ids and sixteen
consecutive nodes become one, level by level, until one is left (the subroot).  The
subroots, by source, become the root in the same way.

A tree is cut into blocks of 16**height consecutive nodes.  A block is walked in
postorder by recursion: a call returns the digest of its subtree, and while it
returns, the siblings it met are appended to the leaves below it.  The roots of
aligned blocks are the nodes of a next distributed round, until every tree is one
node.  Going back down, each round's walk hands the siblings above a block to its
leaves, so a proof is complete where its leaf is.  No tree, source or proof is ever
gathered: a task holds one block, and the rounds are the logarithm of the rows to
the base 4,096.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, ship
from .ordered import numbered

ARITY = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ABOVE = "path array<struct<before: string, after: string>>, top string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as a manifest takes it: ``-`` if null, else its UTF-8 bytes counted and given."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def walk(nodes: list[str], height: int, low: int, high: int, steps: list[list] | None) -> str:
    """The digest over nodes[low:high], ``height`` levels up; each node's siblings are appended to its ``steps``, lowest first."""
    if not height:
        return nodes[low]
    size = ARITY ** (height - 1)
    parts = [(a, min(a + size, high)) for a in range(low, high, size)]
    below = [walk(nodes, height - 1, a, b, steps) for a, b in parts]
    if steps is not None:
        for i, (a, b) in enumerate(parts):
            step = ("".join(below[:i]), "".join(below[i + 1 :]))
            for k in range(a, b):
                steps[k].append(step)
    return digest("".join(below))


def levels(of: int, height: int) -> int:
    """How far a block of a tree of ``of`` nodes goes up: to the tree's one node, or ``height`` levels."""
    up = 0
    while of > 1 and up < height:
        of, up = -(-of // ARITY), up + 1
    return up


def fold(x: str, steps) -> str:
    """The digest that a leaf and the siblings of its levels lead to."""
    for before, after in steps:
        x = digest(before + x + after)
    return x


def _rise(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, pos, of, digest) of the roots of all blocks of ``nodes`` (the same columns)."""
    size = ARITY**height

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        of, node = t.column("of")[0].as_py(), t.column("digest").to_pylist()
        root = walk(node, levels(of, height), 0, len(node), None)
        return pa.table({"grp": t.column("grp").slice(0, 1), "pos": t.column("block").slice(0, 1), "of": pa.array([-(-of // size)]), "digest": pa.array([root])})

    own = nodes.select("grp", "pos", "of", "digest", F.floor(F.col("pos") / size).alias("block"))
    return own.groupBy("grp", "block").applyInArrow(run, f"grp {nodes.schema['grp'].dataType.simpleString()}, pos long, of long, digest string")


def _rounds(nodes: DataFrame, height: int, space: Workspace) -> list[DataFrame]:
    """``nodes``, then the block roots round by round until each tree is one node."""
    out = [nodes]
    while (out[-1].agg(F.max("of")).first()[0] or 1) > 1:
        out.append(space.write(_rise(out[-1], height), "roots"))
    return out


def _descend(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(grp, pos, digest, path, top) of nodes, from (grp, block, path, top) of their blocks: siblings from the node to the top."""
    size = ARITY**height

    def run(t: pa.Table, up: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        node, over = t.column("digest").to_pylist(), [(s["before"], s["after"]) for s in up.column("path")[0].as_py()]
        steps: list[list] = [[] for _ in node]
        walk(node, levels(t.column("of")[0].as_py(), height), 0, len(node), steps)
        paths = [[{"before": b, "after": a} for b, a in s + over] for s in steps]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        top = pa.array([up.column("top")[0].as_py()] * len(node), pa.string())
        return pa.table({"grp": t.column("grp"), "pos": t.column("pos"), "digest": t.column("digest"), "path": pa.array(paths, kind), "top": top})

    kind = nodes.schema["grp"].dataType.simpleString()
    own = nodes.select("grp", "pos", "of", "digest", F.floor(F.col("pos") / size).alias("block"))
    return own.groupBy("grp", "block").cogroup(above.select("grp", "block", "path", "top").groupBy("grp", "block")).applyInArrow(run, f"grp {kind}, pos long, digest string, {_ABOVE}")


def _prove(leaves: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Proofs of leaves, from (grp, block, path, top, subroot) of their blocks."""

    def run(t: pa.Table, up: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        node, over = t.column("digest").to_pylist(), [(s["before"], s["after"]) for s in up.column("path")[0].as_py()]
        top, subroot = up.column("top")[0].as_py(), up.column("subroot")[0].as_py()
        steps: list[list] = [[] for _ in node]
        walk(node, levels(t.column("of")[0].as_py(), height), 0, len(node), steps)
        proof, folded = [], []
        for x, own, s in zip(t.column("tampered").to_pylist(), node, steps):
            s += over
            proof.append(digest("".join(b + a for b, a in s)))
            folded.append(fold(x or own, s))
        n = len(node)
        return pa.table({"doc_id": t.column("doc_id"), "leaf": t.column("digest"), "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([top] * n, pa.string()), "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == top for f in folded], pa.bool_())})

    size = ARITY**height
    own = leaves.select("grp", "pos", "of", "doc_id", F.lower(F.hex("leaf")).alias("digest"), F.lower(F.hex("tampered")).alias("tampered"), F.floor(F.col("pos") / size).alias("block"))
    return own.groupBy("grp", "block").cogroup(above.select("grp", "block", "path", "top", "subroot").groupBy("grp", "block")).applyInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = 3) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, one row per row of ``docs``.

    A leaf is the digest of doc_id, source, lang, n_chars and text (nulls too, see
    ``field``).  ``tampered`` gives the text that is checked against the manifest
    in place of the row's own, null where it is the row's own.  Rows of a source
    stand by doc_id, null first, then by leaf; a null source is a source of its own
    and the first one; empty texts are texts; rows that repeat are leaves each, and
    which of their proofs goes to which says nothing.  Other columns are not looked
    at; an empty table gives no rows.  A task holds 16**height leaves at most.
    """
    ship(docs.sparkSession)
    space = Workspace(docs.sparkSession)
    doc_id, source, lang, n_chars, text = F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang"), F.col("n_chars"), F.col("text").cast("string")
    other = F.lit(None).cast("string") if tampered is None else F.when(~tampered.eqNullSafe(text) & tampered.isNotNull(), tampered)
    rows = docs.select(source.alias("grp"), doc_id.alias("doc_id"), F.unhex(leaf_digest(doc_id, source, lang, n_chars, text)).alias("leaf"), F.unhex(F.when(other.isNotNull(), leaf_digest(doc_id, source, lang, n_chars, other))).alias("tampered"))
    digests = space.write(rows, "leaves")  # the text is read once; what follows moves digests only
    leaves = numbered(digests, "grp", ["doc_id", "leaf"], space)
    space.drop(digests)
    trees = _rounds(leaves.select("grp", "pos", "of", F.lower(F.hex("leaf")).alias("digest")), height, space)
    tops = trees[-1].select("grp", "digest") if len(trees) > 1 else leaves.select("grp", F.lower(F.hex("leaf")).alias("digest"))
    one = numbered(tops.select(F.lit(0).alias("whole"), F.col("grp").alias("source"), "digest"), "whole", ["source"], space)
    whole = _rounds(one.select(F.col("whole").alias("grp"), "pos", "of", "digest"), height, space)
    above = whole[-1].select("grp", F.lit(0).cast("long").alias("block"), F.expr("CAST(array() AS array<struct<before: string, after: string>>)").alias("path"), F.col("digest").alias("top"))
    for nodes in reversed(whole[:-1]):
        above = space.write(_descend(nodes, above, height).select("grp", F.col("pos").alias("block"), "path", "top"), "paths")
    subroots = one.select("source", F.col("pos").alias("block"), F.col("digest").alias("subroot")).join(above.select("block", "path", "top"), "block")
    above = subroots.select(F.col("source").alias("grp"), F.lit(0).cast("long").alias("block"), "path", "top", "subroot")
    named = above.select(F.col("grp").alias("_grp"), "subroot")
    for nodes in reversed(trees[1:-1]):
        down = _descend(nodes, above, height).select("grp", F.col("pos").alias("block"), "path", "top")
        above = space.write(down.join(named, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp"), "paths")
    return _prove(leaves, above, height)


def brute_force(rows, tamper) -> list[tuple]:
    """The rows of ``manifest`` by definition, for tests: rows are (doc_id, source, lang, n_chars, text)."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest("".join(map(part, r)))

    def tree(nodes):
        all_levels = [nodes]
        while len(all_levels[-1]) > 1:
            x = all_levels[-1]
            all_levels.append([digest("".join(x[i : i + 16])) for i in range(0, len(x), 16)])
        return all_levels

    def siblings(all_levels, i):
        out = []
        for x in all_levels[:-1]:
            a = i // 16 * 16
            out.append(("".join(x[a:i]), "".join(x[i + 1 : a + 16])))
            i //= 16
        return out

    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r) for r in sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for i, r in enumerate(sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            path = siblings(trees[s], i) + siblings(top, n)
            folded = fold(leaf((*r[:4], tamper(r))), path)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], digest("".join(b + a for b, a in path)), folded, folded == top[-1][0]))
    return out


#: The rows of the query over ``documents``, by recursion over lists of digests.
ORACLE = """
        WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t),
        f AS (SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
            text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT) AS digits FROM documents),
        d AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS other,
            coalesce(xor(list_reduce([4294967295::UBIGINT] || digits, lambda c, b: xor(c >> 8, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 5 = 0, FALSE) AS hit FROM f, crc),
        lv AS (SELECT source, 0 AS lev, list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS l FROM d GROUP BY source
            UNION ALL SELECT source, lev + 1, list_transform(range((len(l) + 15) // 16), lambda i: sha256(array_to_string(l[16 * i + 1 : 16 * i + 16], ''))) FROM lv WHERE len(l) > 1),
        sub AS (SELECT source, l[1] AS subroot, lev AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS q FROM lv WHERE len(l) = 1),
        top AS (SELECT 0 AS lev, list(subroot ORDER BY q) AS l FROM sub UNION ALL SELECT lev + 1, list_transform(range((len(l) + 15) // 16), lambda i: sha256(array_to_string(l[16 * i + 1 : 16 * i + 16], ''))) FROM top WHERE len(l) > 1),
        pos AS (SELECT d.*, subroot, height, q, row_number() OVER () AS r, row_number() OVER (PARTITION BY d.source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.source),
        way AS (SELECT r, lev AS k, p // (16 ** lev)::BIGINT AS i, l FROM pos JOIN lv ON pos.source IS NOT DISTINCT FROM lv.source AND len(l) > 1 UNION ALL SELECT r, height + lev, q // (16 ** lev)::BIGINT, l FROM pos, top WHERE len(l) > 1),
        step AS (SELECT r, list({'b': array_to_string(l[i // 16 * 16 + 1 : i], ''), 'a': array_to_string(l[i + 2 : i // 16 * 16 + 16], ''), 'x': ''} ORDER BY k) AS s FROM way GROUP BY r),
        done AS (SELECT pos.*, coalesce(s, []) AS s, (SELECT l[1] FROM top WHERE len(l) = 1) AS root FROM pos LEFT JOIN step USING (r)),
        said AS (SELECT *, sha256(array_to_string(list_transform(s, lambda y: y.b || y.a), '')) AS proof_sha256, list_reduce([{'b': '', 'a': '', 'x': CASE WHEN hit THEN other ELSE leaf END}] || s, lambda c, y: {'b': '', 'a': '', 'x': sha256(y.b || c.x || y.a)}).x AS folded_root FROM done)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM said"""
