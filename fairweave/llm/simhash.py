"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Each distinct fingerprint is a node.  Two fingerprints that differ in at most ``radius`` bits
agree in one of ``radius + 1`` blocks of bits, so each is listed once for each block, and only lists of
equal blocks are compared.  A list longer than ``list_rows`` is listed anew by blocks of its
other bits; each such step makes ``radius + 1`` rows of one and leaves fewer free bits, so a list
ends at a bounded length whatever the data.  No pair within the radius is left out.

Lists are sorted by population count and cut to tiles.  Tile pairs whose population
counts differ by more than the radius, or whose lists do not meet, are skipped; the others are
compared whole, with exclusive-or and bit counts over numpy arrays.  A task hands on the
edges of a spanning forest only, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import LOWER, U64, runs, text_buffer, word_pieces
from fairweave.llm._shared import frequent_join, table, written
from fairweave.llm.graph import components

_TEXT = 1 << 22
_TILE = 128
_LOWER = LOWER.tobytes()
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64())])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: bytes, width: int, seed: int, piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """XXH64 of all runs of ``width`` words, space-joined and lower-cased, one array for each piece of the text."""
    held: list[bytes] = []
    any_full = False
    for found in word_pieces(text, _LOWER, piece):
        held += found
        if len(held) >= width:
            any_full = True
            grams = map(b" ".join, zip(*(held[k:] for k in range(width))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), U64, len(held) - width + 1)
            held = held[len(held) - width + 1 :]
    if held and not any_full:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), seed)], U64)


def bit_counts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each run of ``sizes`` hashes: one row for each run.

    Eight bits at a time are counted in the bytes of one word, over at most 255 hashes.
    """
    steps = -(-sizes // 255)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    run = np.repeat(np.arange(len(sizes)), steps)
    within = np.arange(len(run)) - np.repeat(np.concatenate(([0], np.cumsum(steps)[:-1])), steps)
    starts = first[run] + 255 * within
    out = np.zeros((len(sizes), 64), np.int64)
    if not len(starts):
        return out
    for k in range(8):
        lanes = np.add.reduceat((hashes >> U64(k)) & U64(0x0101010101010101), starts)
        np.add.at(out[:, k::8], run, lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64))
    return out


def fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A bit of the fingerprint is 1 if it is set in over half of the hashes."""
    bits = 2 * bit_counts(hashes, sizes) > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(U64)


def _sketched(width: int, seed: int):
    def work(batches):
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in runs(offsets, _TEXT):
                found = [list(shingle_hashes(raw[offsets[k] : offsets[k + 1]].tobytes(), width, seed)) for k in range(i, j)]
                sizes = np.array([sum(map(len, f)) for f in found], np.int64)
                hashes = np.concatenate([np.zeros(0, U64), *(h for f in found for h in f)])
                node = fingerprints(hashes, sizes).view(np.int64)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(sizes), pa.array(node)], schema=_FINGERPRINTS)

    return work


def blocks(free: int, n: int) -> list[int]:
    """The bits of ``free`` dealt to ``n`` masks of nearly equal size."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def tile_links(value: np.ndarray, lists: np.ndarray, radius: int, tile: int = _TILE) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all values that differ in at most ``radius`` bits; ``lists`` numbers the list of each value.

    Both arrays are sorted by list, then population count.  Tiles cut the rows whatever their lists: what
    is found across lists in one tile pair is a link as well.
    """
    ones, n = np.bitwise_count(value).astype(np.int64), len(value)
    low = np.arange(0, n, tile)
    high = np.minimum(low + tile, n)
    left, right = [], []
    active, step = np.arange(len(low)), 0
    while len(active):
        for i in active:
            a, b = value[low[i] : high[i]], value[low[i + step] : high[i + step]]
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
            left.append(x + low[i])
            right.append(y + low[i + step])
        step += 1
        active = active[active + step < len(low)]
        last, first = high[active] - 1, low[active + step]
        # counts rise within a list, so a tile out of reach puts all later ones out of reach
        active = active[(lists[last] == lists[first]) & (ones[first] - ones[last] <= radius)]
    left, right = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
    apart = left < right
    return left[apart], right[apart]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member that links reach from each of ``n`` members."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(radius: int):
    def work(table):
        mask, value, node = (table.column(c).to_numpy() for c in ("mask", "value", "node"))
        bits = node.view(U64)
        order = np.lexsort((bits, np.bitwise_count(bits), value, mask))
        mask, value, bits = mask[order], value[order], bits[order]
        new = np.ones(len(bits), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        i, j = tile_links(bits, np.cumsum(new), radius)
        # one fingerprint may stand in several lists of this task
        member, of = np.unique(bits.view(np.int64), return_inverse=True)
        label = forest(len(member), of[i], of[j])
        moved = np.flatnonzero(label != np.arange(len(member)))
        return pa.table([pa.array(member[moved]), pa.array(member[label[moved]])], schema=_EDGES)

    return work


def _listed(nodes: DataFrame, radius: int, list_rows: int) -> tuple[DataFrame, int]:
    """(mask, value, node) for each list that a fingerprint stands in, and the number of rows."""
    every = (1 << 64) - 1

    def under(df: DataFrame, masks: list[int]) -> DataFrame:
        mask = F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")
        return df.select("node", mask).withColumn("value", F.col("node").bitwiseAND(F.col("mask")))

    masks = blocks(every, radius + 1)
    done, rest = None, written(under(nodes, masks), "lists")
    while True:
        long = rest.groupBy("mask", "value").count().where(F.col("count") > list_rows).drop("count")
        long = written(long, "long-lists")
        finer = {m: [m | b for b in blocks(every & ~m, radius + 1)] for m in masks if (every & ~m).bit_count() > radius + 1}
        split = [_signed(m) for m in finer]
        long = long.where(F.col("mask").isin(split)) if split else long.limit(0)
        if not long.limit(1).count():
            done = rest if done is None else done.unionByName(rest)
            return done, done.count()
        kept = rest.join(long, ["mask", "value"], "left_anti")
        done = kept if done is None else done.unionByName(kept)
        again = rest.join(long, ["mask", "value"], "left_semi")
        parts = [under(again.where(F.col("mask") == _signed(m)), below) for m, below in finer.items()]
        rest = parts[0]
        for p in parts[1:]:
            rest = rest.unionByName(p)
        rest, masks = written(rest, "lists"), [m for below in finer.values() for m in below]


def simhash_duplicates(docs: DataFrame, radius: int = 2, *, width: int = 3, seed: int = 42, list_rows: int = 65_536, cell_rows: int = 200_000) -> DataFrame:
    """Group documents whose fingerprints differ in at most ``radius`` bits, directly or over others.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  Words lie between
    ASCII spaces and controls 9 to 13, A to Z lower-cased; shingles are runs of ``width`` words, repeats
    included, joined by spaces; a text of fewer words is one shingle.  A fingerprint's bit is 1 if it is
    set in over half of the shingles' XXH64.

    Returns one row per input row: doc_id, n_shingles, fingerprint (16 lower-case hex digits) and
    component_id (least doc_id reachable, itself included).  A null, empty or wordless text has the
    fingerprint zero, which links like any other.  Repeated rows keep their rows and share a
    component; a null id gives way to any other, and where no id is known the component is null.  An
    empty table gives no rows.

    ``list_rows`` bounds the lists that are compared as they are, ``cell_rows`` the rows of a task.
    """
    if not 0 <= radius <= 15:
        raise ValueError("radius must be 0 to 15")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = written(source.mapInArrow(_sketched(width, seed), "doc_id long, n_shingles long, node long"), "fingerprints")
    nodes = written(sketched.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("times")), "nodes")
    listed, rows = _listed(nodes.select("node"), radius, list_rows)
    cells = max(48, math.ceil(2 * rows / cell_rows))
    cell = F.pmod(F.xxhash64("mask", "value"), F.lit(cells))
    edges = listed.groupBy(cell.alias("cell")).applyInArrow(_compared(radius), "a long, b long")
    labels = components(edges)
    of = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = written(of.join(least, "label").select("node", "times", "component_id"), "node-components")
    out = frequent_join(sketched, of, "node")
    return out.select("doc_id", "n_shingles", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")


def op11_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and their groups at two differing bits or fewer."""
    return simhash_duplicates(table(spark, sf_dir, "documents"))
