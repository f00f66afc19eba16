"""Merkle manifest of a table, stored in blocks of van Emde Boas layout.

Rows are leaves of one tree for each value of a column; the trees' roots are leaves of one more tree.
``fan`` nodes in a row have one parent, the hash of their digests, as long as a level has several nodes.

A block is an aligned subtree of ``fan**height`` leaves.  Its digests lie in one array, recursively split at
half height: the upper half of the levels first, then each lower subtree, so that any walk from a
leaf to the root meets few places whatever the size of a cache line or page.  ``address`` finds a node's
place by arithmetic, for building as for reading siblings.  A block's root is a leaf of the blocks above,
built by the same function until each tree has one block; paths come down the same way.

Spark places the leaves: a range partitioning by tree and order, whose rows are counted for each partition and
tree, gives each leaf its position without a window over a whole tree.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweave.llm._shared import CRC_TABLE_SQL, crc_sql, remainder, sized, table, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCK_SQL = "tree string, block long, n long, top int, digest binary, store binary"
_BLOCK = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("top", pa.int32()), ("digest", pa.binary()), ("store", pa.binary())])
_PATH_SQL = "tree string, position long, path binary"
_PATH = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("path", pa.binary())])
_PROOF = pa.schema([("key", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root"))])
_PROOF_SQL = "key long, leaf string, subroot string, proof_sha256 string, folded_root string"


def nodes(levels: int, fan: int) -> int:
    """Nodes of a complete tree."""
    return (fan**levels - 1) // (fan - 1)


def address(depth: int, index: np.ndarray, levels: int, fan: int) -> np.ndarray:
    """Places, in the layout of a complete tree of ``levels`` levels, of the nodes ``index`` at ``depth`` (the root's is 0)."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(depth, index, upper, fan)
    below = fan ** (depth - upper)
    return nodes(upper, fan) + index // below * nodes(levels - upper, fan) + address(depth - upper, index % below, levels - upper, fan)


def parent(children: bytes) -> bytes:
    """Digest of the hex text of digests that lie one after another."""
    return hashlib.sha256(children.hex().encode()).digest()


class Block:
    """An aligned subtree, its digests in van Emde Boas layout."""

    def __init__(self, n: int, top: int, store: bytes, fan: int, height: int):
        self.n, self.top, self.store, self.fan, self.height = n, top, np.frombuffer(store, np.uint8).reshape(-1, 32), fan, height

    @classmethod
    def built(cls, leaves: bytes, alone: bool, fan: int, height: int) -> Block:
        """From the digests of its leaves; a block ``alone`` ends at its first level of one node, another at its full height."""
        n, depth, store = len(leaves) // 32, height, np.zeros((nodes(height + 1, fan), 32), np.uint8)
        level, used = leaves, 0
        while True:
            places = address(depth, np.arange(len(level) // 32), height + 1, fan)
            store[places] = np.frombuffer(level, np.uint8).reshape(-1, 32)
            used = max(used, int(places.max()) + 1)
            if depth == 0 or alone and len(level) == 32:
                return cls(n, depth, store[:used].tobytes(), fan, height)
            level = b"".join(parent(level[at : at + 32 * fan]) for at in range(0, len(level), 32 * fan))
            depth -= 1

    def width(self, depth: int) -> int:
        return -(-self.n // self.fan ** (self.height - depth))

    def level(self, depth: int) -> bytes:
        return self.store[address(depth, np.arange(self.width(depth)), self.height + 1, self.fan)].tobytes()

    @property
    def root(self) -> bytes:
        return self.level(self.top)

    def paths(self):
        """Of each leaf in order: for each level below the root the place in its run, the number of siblings and they themselves."""
        levels = [self.level(d) for d in range(self.height, self.top, -1)]
        for i in range(self.n):
            out = []
            for level in levels:
                start = i - i % self.fan
                run, at = level[32 * start : 32 * (start + self.fan)], 32 * (i - start)
                out.append(bytes((i - start, len(run) // 32 - 1)) + run[:at] + run[at + 32 :])
                i //= self.fan
            yield b"".join(out)


def steps(path: bytes):
    """(left siblings, right siblings) of each level of a path."""
    at = 0
    while at < len(path):
        left, end = at + 2 + 32 * path[at], at + 2 + 32 * path[at + 1]
        yield path[at + 2 : left], path[left:end]
        at = end


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest and the siblings of a path lead to."""
    for left, right in steps(path):
        digest = parent(left + digest + right)
    return digest


def _build(fan: int, height: int):
    def work(t):
        t = t.sort_by("position")
        tree, block = t.column("tree")[0].as_py(), t.column("block")[0].as_py()
        b = Block.built(b"".join(t.column("digest").to_pylist()), block == 0 and len(t) < fan**height, fan, height)
        return pa.table([[tree], [block], [b.n], [b.top], [b.root], [b.store.tobytes()]], schema=_BLOCK)

    return work


def _descend(fan: int, height: int):
    """Paths of a block's leaves, each continued by the path of the block's root."""

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                found = [p + r["path"] for p in Block(r["n"], r["top"], r["store"], fan, height).paths()]
                base = r["block"] * fan**height
                for at in range(0, len(found), 1024):
                    part = found[at : at + 1024]
                    yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * len(part)), pa.array(np.arange(len(part)) + base + at), pa.array(part, pa.binary())], schema=_PATH)

    return work


def _prove(fan: int, height: int):
    """Proofs of a block's leaves, and the roots that their claimed digests lead to."""

    def work(leaves, blocks):
        if not len(leaves):
            return _PROOF.empty_table()
        r = blocks.to_pylist()[0]
        own = list(Block(r["n"], r["top"], r["store"], fan, height).paths())
        above = b"".join(left + right for left, right in steps(r["path"])).hex()
        reached: dict[bytes, str] = {}
        rows = []
        for key, position, digest, claim in zip(*(leaves.column(c).to_pylist() for c in ("key", "position", "digest", "claim"))):
            path = own[position - r["block"] * fan**height]
            siblings = b"".join(left + right for left, right in steps(path)).hex() + above
            at = folded(claim, path)
            if at not in reached:
                reached[at] = folded(at, r["path"]).hex()
            rows.append((key, digest.hex(), r["subroot"].hex(), hashlib.sha256(siblings.encode()).hexdigest(), reached[at]))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), _PROOF.types)], schema=_PROOF)

    return work


def placed(rows: DataFrame, order: list[str], part_rows: int) -> DataFrame:
    """``rows`` (written; with ``tree``) with ``position``: 0, 1, 2, ... within each tree in the order of ``order``, nulls first.

    The counts by partition and tree have at most as many rows as there are partitions and trees together.
    """
    n = max(48, math.ceil(rows.count() / part_rows))
    keys = ["tree", *order]
    ranged = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    ranged = written(ranged, "ordered").withColumn("part", F.shiftright("row", 33))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    count = ranged.groupBy("part", "tree").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    count = count.select("part", "tree", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ranged.join(sized(written(count, "starts")), ["part", "tree"]).withColumn("position", F.col("row") + F.col("shift")).drop("part", "row", "shift")


def forest(leaves: DataFrame, fan: int, height: int) -> list[DataFrame]:
    """Stored blocks, level by level, of all trees; ``leaves`` has tree, position and digest.  In the last, each tree is one block."""
    stored = []
    while True:
        dealt = leaves.select("tree", "position", "digest", F.floor(F.col("position") / fan**height).alias("block"))
        stored.append(written(dealt.groupBy("tree", "block").applyInArrow(_build(fan, height), _BLOCK_SQL), "blocks"))
        if not stored[-1].where("block > 0").limit(1).count():
            return stored
        leaves = stored[-1].select("tree", F.col("block").alias("position"), "digest")


def block_paths(stored: list[DataFrame], above: DataFrame, fan: int, height: int) -> DataFrame:
    """The lowest blocks with the path from their root to the last root; ``above`` has the paths of the trees' roots."""
    paths = above.withColumn("position", F.lit(0).cast("long"))
    for blocks in reversed(stored[1:]):
        with_path = blocks.join(paths.withColumnRenamed("position", "block"), ["tree", "block"])
        paths = written(with_path.select("tree", "block", "n", "top", "store", "path").mapInArrow(_descend(fan, height), _PATH_SQL), "paths")
    return stored[0].join(paths.withColumnRenamed("position", "block"), ["tree", "block"])


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 of the values in turn: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


@dataclass
class Manifest:
    """A table's trees: ``leaves`` (key, tree, position, digest, claim), stored blocks of the trees and of the tree over them, the root."""

    leaves: DataFrame
    blocks: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame
    root: str | None
    fan: int
    height: int


def build_manifest(docs: DataFrame, fields: list[str], by: str, key: str = "doc_id", *, claims: Column | None = None, fan: int = 8, height: int = 4, part_rows: int = 500_000) -> Manifest:
    """Hash every row into a leaf and build the trees.

    A leaf is the hash of ``fields``; rows of one value of ``by`` (text) form a tree, in ascending order of the integer
    ``key``, nulls first, then of their digests.  The trees' roots, in bytewise order of ``by``, null first, form the last tree.
    ``claims`` is the digest (binary) that each row claims to have; its own if null or not given.  Other columns are
    ignored, so names can't clash.  An empty table has no root.
    """
    own = leaf_hash([F.col(c) for c in fields])
    tree = F.coalesce(F.concat(F.lit("1"), F.col(by).cast("string")), F.lit("0"))
    claim = own if claims is None else F.coalesce(claims, own)
    hashed = docs.select(F.col(key).cast("long").alias("key"), tree.alias("tree"), own.alias("digest"), claim.alias("claim"))
    leaves = written(placed(written(hashed, "leaves"), ["key", "digest"], part_rows), "leaves-placed")
    blocks = forest(leaves, fan, height)
    roots = blocks[-1].select("tree", "digest")
    top = forest(placed(written(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "roots"), ["name"], part_rows), fan, height)
    last = top[-1].select("digest").first()
    return Manifest(leaves, blocks, top, roots, bytes(last.digest).hex() if last else None, fan, height)


def prove_rows(m: Manifest) -> DataFrame:
    """Each row's proof: key, leaf, subroot, root, proof_sha256 (of its siblings from leaf to root), folded_root (from its claim) and verified."""
    start = m.roots.limit(0).select(F.lit("").alias("tree"), F.lit(b"").alias("path")) if m.root is None else m.top[-1].select("tree", F.lit(b"").alias("path"))
    top = block_paths(m.top, start, m.fan, m.height)
    named = placed(written(m.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "roots"), ["name"], 500_000)
    paths = top.select("tree", "block", "n", "top", "store", "path").mapInArrow(_descend(m.fan, m.height), _PATH_SQL)
    above = named.join(paths, ["tree", "position"]).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path")
    above = sized(written(above, "root-paths"))
    blocks = block_paths(m.blocks, above.select("tree", "path"), m.fan, m.height).join(above.select("tree", "subroot"), "tree")
    blocks = blocks.select("tree", "block", "n", "top", "store", "path", "subroot")
    dealt = m.leaves.withColumn("block", F.floor(F.col("position") / m.fan**m.height))
    proofs = dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(_prove(m.fan, m.height), _PROOF_SQL)
    root = F.lit(m.root).cast("string")
    return proofs.select("key", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Manifest of all ``documents``; a third of them claim the digest of their text in lower case."""
    docs = table(spark, sf_dir, "documents")
    lowered = leaf_hash([F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in _FIELDS])
    claims = F.when(remainder(F.col("doc_id"), 3) == 0, lowered)
    return prove_rows(build_manifest(docs, _FIELDS, "lang", claims=claims)).withColumnRenamed("key", "doc_id")


def _sql(levels: int = 7, tops: int = 3) -> str:
    """The same for DuckDB, level by level, for up to 8**levels leaves in a tree and 8**tops trees."""
    value = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = "sha256(" + " || ".join(map(value, _FIELDS)) + ")"
    lower = "sha256(" + " || ".join(value(f"translate(text, '{_UPPER}', '{_LOWER}')" if c == "text" else c) for c in _FIELDS) + ")"
    out = [f"crc AS ({CRC_TABLE_SQL})"]
    out.append(f"""d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('1' || lang, '0') AS tree, {leaf} AS leaf,
  CASE WHEN {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 3 = 0 THEN {lower} ELSE {leaf} END AS claim FROM documents, crc)""")
    out.append("p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)")
    out.append("n0 AS (SELECT tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS c FROM p)")

    def climb(name: str, count: int) -> None:
        for i in range(count):
            out.append(f"""{name}{i + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM (SELECT tree, pos // 8 AS pos,
  CASE WHEN any_value(c) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM {name}{i} AS x GROUP BY tree, pos // 8))""")
            out.append(f"""{name}s{i} AS (SELECT a.tree, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
  coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r FROM {name}{i} a JOIN {name}{i} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 WHERE a.c > 1 GROUP BY a.tree, a.pos)""")

    climb("n", levels)
    out.append(f"u0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS c, tree AS name FROM n{levels})")
    climb("u", tops)
    out.append("f0 AS (SELECT p.*, claim AS f, '' AS proof, u0.pos AS upos, u0.h AS subroot FROM p JOIN u0 ON p.tree = u0.name)")
    at = 0
    for name, count, tree, pos in (("n", levels, "f.tree", "f.pos"), ("u", tops, "''", "f.upos")):
        for i in range(count):
            out.append(f"""f{at + 1} AS (SELECT f.* REPLACE (CASE WHEN s.l IS NULL THEN f.f ELSE sha256(s.l || f.f || s.r) END AS f, f.proof || coalesce(s.l || s.r, '') AS proof)
  FROM f{at} f LEFT JOIN {name}s{i} s ON s.tree = {tree} AND s.pos = {pos} // {8**i})""")
            at += 1
    return "WITH " + ",\n".join(out) + f"\nSELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u.h AS verified FROM f{at}, (SELECT h FROM u{tops}) u"


OP13_SQL = _sql()
