"""Exact removal of repeated byte substrings by distributed prefix doubling.

Names (ranks) of growing prefixes are built by doubling: the name of 2m bytes at a
position is the pair of the names of m bytes there and m bytes further on.  Spark
groups equal names over all chunks of the corpus, and a position takes part in the
next, longer round only while its name is not unique:

1. 32-byte names.  Of every window of a threshold-long string only the least name
   is asked about (it depends on the string alone, so equal strings ask for the same
   one).  A string whose least 32-byte name occurs once is unique.
2. Block names.  Consecutive positions that chose the same least name form a block;
   a block whose whole content occurred earlier is settled, all its strings repeat.
3. Threshold-long names (two overlapping 64-byte names), for the positions of blocks
   that are first of their content while others share their least name.

Each round is one exchange: chunks send sorted distinct names to buckets of name
space, a bucket sorts them and answers in the order asked.  No group of equal names
is collected as rows, and a chunk sends a name once, so hot passages cost one entry
for each chunk.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import U64, bucket_edges, byte_names, mix, pair, planes, runs, text_buffer, unplanes
from fairweave.llm._shared import range_chunk, table

GRAM = 32
_PIECE = 1 << 19
_TABLE = byte_names(0xA11CE)
_ROWS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int64()), ("blob", pa.binary())])
_ROWS_SQL = "chunk long, bucket long, kind long, blob binary"


def _doubled(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of 32 and of 64 bytes at every position where that many follow."""
    name, m = _TABLE[raw], 1
    short = None
    while m < 64:
        name = pair(name[:-m], name[m:]) if len(name) > m else name[:0]
        m *= 2
        if m == GRAM:
            short = name
    return short, name


def _blocks(raw, offsets, threshold):
    """(start, end, key, content name) of each block of string starts, and 64-byte names.

    ``end`` is exclusive and counts starts; the content reaches threshold - 1 bytes further.
    """
    short, wide = _doubled(raw)
    n = len(raw) - threshold + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, U64), np.zeros(0, U64), wide
    window = threshold - GRAM + 1
    bits = max(1, int(len(raw)).bit_length())
    packed = (short >> U64(bits) << U64(bits)) | np.arange(len(short), dtype=U64)
    least, m = packed, 1
    while 2 * m <= window:
        least = np.minimum(least[:-m], least[m:])
        m *= 2
    if m < window:
        least = np.minimum(least[: len(least) - (window - m)], least[window - m :])
    anchor = (least & U64((1 << bits) - 1)).astype(np.int64)[:n]
    first, last = offsets[:-1], offsets[1:] - threshold + 1
    some = last > first
    first, last = first[some], last[some]
    mark = np.zeros(n + 1, np.int8)
    np.add.at(mark, first, 1)
    np.add.at(mark, np.minimum(last, n), -1)
    valid = np.cumsum(mark[:n]).astype(bool)
    change = np.empty(n, bool)
    change[0], change[1:] = True, anchor[1:] != anchor[:-1]
    change[first] = True
    start = np.flatnonzero(valid & change)
    end = np.append(start[1:], n)
    end = np.minimum(end, last[np.searchsorted(first, start, "right") - 1])
    size = end - start + threshold - 1
    content = pair(pair(wide[start], wide[start + np.minimum(64, size - 64)]), wide[start + size - 64])
    content = pair(content, mix(size.astype(U64)))
    return start, end, mix(short[anchor[start]]), content, wide


class _Chunk:
    """The documents of one chunk in id order, with their blocks, rebuilt alike each time."""

    def __init__(self, table: pa.Table, threshold: int):
        table = table.select(["doc_id", "text"])
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.raw, self.offsets = text_buffer(self.table.column("text"))
        self.threshold = threshold
        starts, ends, keys, contents = [], [], [], []
        for i, j in runs(self.offsets, _PIECE):
            base = self.offsets[i]
            s, e, k, c, _ = _blocks(self.raw[base : self.offsets[j]], self.offsets[i : j + 1] - base, threshold)
            starts.append(s + base)
            ends.append(e + base)
            keys.append(k)
            contents.append(c)
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.start, self.end = cat(starts, np.int64), cat(ends, np.int64)
        keys, contents = cat(keys, U64), cat(contents, U64)
        order = np.lexsort((np.arange(len(keys)), contents, keys))
        k, c = keys[order], contents[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        #: positions, in block order, of the first block of each distinct content, sorted by name
        self.first = order[new]
        self.keys, self.contents = k[new], c[new]
        self.repeat = np.ones(len(keys), bool)
        self.repeat[self.first] = False

    def positions(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, name, 32 more bits of the name) of each threshold-long string in the wanted blocks."""
        where, names, more = [], [], []
        take = np.sort(wanted)
        for i, j in runs(self.offsets, _PIECE):
            base, stop = self.offsets[i], self.offsets[j]
            own = take[np.searchsorted(self.start[take], base) : np.searchsorted(self.start[take], stop)]
            if not len(own):
                continue
            size = self.end[own] - self.start[own]
            at = np.repeat(self.start[own] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            _, wide = _doubled(self.raw[base:stop])
            where.append(at)
            head, tail = wide[at - base], wide[at - base + self.threshold - 64]
            names.append(pair(head, mix(tail)))
            more.append((pair(tail, mix(head)) >> U64(32)).astype(np.uint32))
        if not where:
            return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.uint32)
        return np.concatenate(where), np.concatenate(names), np.concatenate(more)


def distinct_names(names: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct name (of both parts) comes first, in the order of names, and the number of each one's name."""
    order = np.lexsort((more, names))
    new = np.ones(len(order), bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (more[order][1:] != more[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _asked(chunk: int, kind: int, names: np.ndarray, buckets: int, extra: np.ndarray | None = None) -> pa.Table:
    edges = bucket_edges(names, buckets)
    parts = [planes(names[a:b]) + (planes(extra[a:b]) if extra is not None else b"") for a, b in zip(edges[:-1], edges[1:])]
    keep = [i for i, p in enumerate(parts) if p]
    return pa.table([pa.array([chunk] * len(keep), pa.int64()), pa.array(keep, pa.int64()), pa.array([kind] * len(keep), pa.int64()), pa.array([parts[i] for i in keep], pa.binary())], schema=_ROWS)


def _ask_blocks(threshold: int, buckets: int):
    def ask(key, table):
        c = _Chunk(table, threshold)
        return _asked(key[0].as_py(), 0, c.keys, buckets, c.contents)

    return ask


def _gathered(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
    table = table.sort_by("chunk")
    return table, table.column("blob").to_pylist()


def _answer_blocks(key, table):
    """0: no other content has this name; 1: an earlier chunk has the same block;
    2: first of its content, and other contents share the name."""
    table, blobs = _gathered(table)
    halves = [(unplanes(b[: len(b) // 2]), unplanes(b[len(b) // 2 :])) for b in blobs]
    keys, contents = np.concatenate([h[0] for h in halves]), np.concatenate([h[1] for h in halves])
    order = np.lexsort((contents, keys))  # stable: earlier chunks stay first
    k, c = keys[order], contents[order]
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new = new_key.copy()
    new[1:] |= c[1:] != c[:-1]
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
    answer = np.empty(len(k), np.uint8)
    answer[order] = np.where(~new, 1, np.where(kinds > 1, 2, 0))
    return _answers(table, answer, [len(h[0]) for h in halves])


def _answers(table: pa.Table, answer: np.ndarray, sizes: list[int]) -> pa.Table:
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    blobs = [answer[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table([table.column("chunk"), table.column("bucket"), table.column("kind"), pa.array(blobs, pa.binary())], schema=_ROWS)


def _joined(table: pa.Table, kind: int, n: int) -> np.ndarray:
    """The answers to a chunk's names, in the order asked."""
    table = table.filter(pa.compute.equal(table.column("kind"), kind)).sort_by("bucket")
    got = np.frombuffer(b"".join(table.column("blob").to_pylist()), np.uint8)
    assert len(got) == n, f"{len(got)} answers to {n} names"
    return got


def _ask_positions(threshold: int, buckets: int):
    def ask(key, docs, answers):
        if not len(docs):
            return _ROWS.empty_table()
        chunk = key[0].as_py()
        c = _Chunk(docs, threshold)
        got = _joined(answers, 0, len(c.keys))
        _, names, more = c.positions(c.first[got == 2])
        first, _ = distinct_names(names, more)
        settled = pa.table([[chunk], [-1 - chunk], [0], [got.tobytes()]], schema=_ROWS)
        return pa.concat_tables([settled, _asked(chunk, 1, names[first], buckets, more[first])])

    return ask


def _answer_positions(key, table):
    """1: an earlier chunk has the name.  Rows of round 1 pass through."""
    if key[0].as_py() < 0:
        return table.select(_ROWS.names)
    table, blobs = _gathered(table)
    sizes = [len(b) // 12 for b in blobs]
    names = np.concatenate([unplanes(b[: 8 * n]) for b, n in zip(blobs, sizes)])
    more = np.concatenate([unplanes(b[8 * n :], np.uint32) for b, n in zip(blobs, sizes)])
    first, _ = distinct_names(names, more)
    answer = np.ones(len(names), np.uint8)
    answer[first] = 0
    return _answers(table, answer, sizes)


def _removed(threshold: int, with_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + ([("kept", pa.binary())] if with_text else []))

    def finish(key, docs, answers):
        if not len(docs):
            return schema.empty_table()
        c = _Chunk(docs, threshold)
        got = _joined(answers, 0, len(c.keys))
        # starts of repeated strings, as ranges [from, to)
        gone = c.repeat.copy()
        gone[c.first[got == 1]] = True
        where, names, more = c.positions(c.first[got == 2])
        first, number = distinct_names(names, more)
        repeated = _joined(answers, 1, len(first)).astype(bool)[number] if len(names) else np.zeros(0, bool)
        if len(names):
            later = np.ones(len(names), bool)
            later[first] = False
            repeated |= later
        at = where[repeated]
        begin, stop = np.concatenate((c.start[gone], at)), np.concatenate((c.end[gone], at + 1)) + threshold - 1
        cover = np.zeros(len(c.raw) + 1, np.int32)
        np.add.at(cover, begin, 1)
        np.add.at(cover, stop, -1)
        cut = np.cumsum(cover[:-1]) > 0
        out = []
        for i, doc_id in enumerate(c.table.column("doc_id").to_pylist()):
            a, b = c.offsets[i], c.offsets[i + 1]
            m = cut[a:b]
            kept = c.raw[a:b][~m].tobytes()
            n_spans = int(m[:1].sum() + (m[1:] & ~m[:-1]).sum())
            out.append((doc_id, int(b - a), int(m.sum()), n_spans, hashlib.sha256(kept).hexdigest()) + ((kept,) if with_text else ()))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)

    return finish


def remove_repeated_substrings(docs: DataFrame, threshold: int = 100, *, with_text: bool = False, chunk_bytes: int = 8 << 20, bucket_names: int = 1 << 20) -> DataFrame:
    """Remove each byte that lies in a ``threshold``-long byte string which also starts earlier.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  "Earlier"
    means in a document with a smaller id, or earlier in the same document; overlapping
    occurrences count, matches never cross documents, and strings are judged on the input.

    Returns one row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``with_text``, the kept bytes.  A null text is empty: nothing is removed and the digest is
    that of no bytes.  Rows of the same id are taken in the order of their texts, as if the
    later ones had greater ids; rows of a null id come last, in the order of a hash of their texts, then
    their texts.  An empty table gives no rows.

    ``threshold`` is 96 to 128.  Blocks are told apart by 128 bits, strings by 96.  ``chunk_bytes``
    bounds what a task holds (but for rows of one id), ``bucket_names`` what a bucket sorts.  A chunk sends
    only to buckets for which it has a name, so messages never outnumber names.
    """
    if not 96 <= threshold <= 128:
        raise ValueError("threshold must be from 96 to 128")
    chunked, n_chunks = range_chunk(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chunk_bytes)
    # about one name for 36 bytes of text
    buckets = max(48, math.ceil(n_chunks * chunk_bytes / 36 / bucket_names))
    dealt = chunked.groupBy("chunk")
    asked = dealt.applyInArrow(_ask_blocks(threshold, buckets), _ROWS_SQL)
    settled = asked.groupBy("bucket").applyInArrow(_answer_blocks, _ROWS_SQL)
    again = dealt.cogroup(settled.groupBy("chunk")).applyInArrow(_ask_positions(threshold, buckets), _ROWS_SQL)
    answers = again.groupBy("bucket").applyInArrow(_answer_positions, _ROWS_SQL)
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return dealt.cogroup(answers.groupBy("chunk")).applyInArrow(_removed(threshold, with_text), out)


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings of all ``documents``."""
    return remove_repeated_substrings(table(spark, sf_dir, "documents"), 100)
