"""Bounded-space online packing of tokenized documents into fixed windows.

Each partition keeps a fixed number of open windows.  Whole windows of a long document
are emitted at once; its rest goes to the open window it fits best.  When none fits, the
fullest is emitted and a new one opened; if the fullest would be left with more padding
than ``slack``, the document is cut to fill it.  At the end of a partition the open
windows are compacted, and what remains (less than a window) is merged with the leftovers
of neighbouring partitions; a last part-filled window is cut at powers of two, which need
no padding.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import U64, mix
from fairweave.llm._shared import table, written

_PIECE = 1 << 19
_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("partition", pa.int64()), ("ids", pa.binary())])
_ROWS_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, partition long, ids binary"
_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
#: Code points with the Unicode property White_Space (fixed values).
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CACHE_WORDS = 150_000
#: How byte-level BPE splits texts (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _classes() -> np.ndarray:
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x10000)], np.uint8)
    out[_WHITE] = _SPACE
    return out


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, by its rule."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevelTokenizer:
    """Ids of a byte-level BPE tokenizer file, many texts at once.

    Texts are split into the tokenizer's words with array operations; each distinct word
    is tokenized once and remembered.  Texts with contractions ('s, 't ...) or characters
    above U+FFFF are split by the tokenizer's own pattern, so the ids are the tokenizer's
    in every case.  The file's added tokens (such as end markers) are matched inside texts, as
    the tokenizer does by default.  The file's merges must be in the order of its ids.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding

        file = json.loads(open(path, encoding="utf-8").read())
        model, added = file["model"], file.get("added_tokens") or []
        letters, vocabulary = _byte_letters(), model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if [vocabulary[a + b] for a, b in merges] != list(range(256, 256 + len(merges))):
            raise ValueError(f"{path}: merges are not in the order of ids")
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that depend on the text around them")
        self.added = {t["content"]: np.array([t["id"]], np.uint32) for t in added}
        self.marker = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(merges)}
        self.whole = Encoding("byte_level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = _classes()
        self.names = mix(np.arange(1, 0x10001, dtype=U64) * U64(0x9E3779B97F4A7C15))
        self.forget()

    def forget(self) -> None:
        self.number: dict[int, int] = {}
        self.at, self.ids, self.used = np.zeros(1, np.int64), np.zeros(1 << 16, np.uint32), 0

    def _learn(self, words: list[str], names: list[int]) -> None:
        piece, ids, at, base = self.whole._core_bpe.encode_single_piece, [], [], self.used
        self.number.update(zip(names, range(len(self.at) - 1, len(self.at) - 1 + len(names))))
        for word in words:
            ids += piece(word.encode())
            at.append(base + len(ids))
        self.at = np.concatenate((self.at, at))
        while base + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[base : base + len(ids)] = ids
        self.used = base + len(ids)

    def _simple(self, text: str, points: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts between ``cuts`` of ``text``."""
        kind = self.kind[points]
        first = np.zeros(len(points) + 1, bool)
        first[cuts] = True
        first = first[:-1]
        change = np.empty(len(points), bool)
        change[0], change[1:] = True, kind[1:] != kind[:-1]
        change |= first
        space = kind == _SPACE
        blank_before = np.zeros(len(points), bool)
        blank_before[1:] = points[:-1] == 0x20
        blank_before &= ~first
        start = change & (space | ~blank_before)
        # the last space before a word starts its own token, or the word's if it is a blank
        ahead = np.flatnonzero(change & ~space & ~first)
        ahead = ahead[space[ahead - 1]]
        start[ahead - 1] = True
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], len(points))
        size = end - begin
        # names of words: polynomial sums modulo 2**64
        up, down = _powers(len(points))
        total = np.zeros(len(points) + 1, U64)
        np.cumsum(self.names[points] * up, out=total[1:])
        name = mix((total[end] - total[begin]) * down[begin] + size.astype(U64))
        distinct, at, number = np.unique(name, return_index=True, return_inverse=True)
        if len(self.number) > _CACHE_WORDS:
            self.forget()
        keys = distinct.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.number]
        if new:
            self._learn([text[begin[at[i]] : end[at[i]]] for i in new], [keys[i] for i in new])
        entry = np.array([self.number[k] for k in keys], np.int64)
        low, count = self.at[entry], self.at[entry + 1] - self.at[entry]
        low, count = low[number], count[number]
        stop = np.cumsum(count)
        ids = self.ids[np.repeat(low - (stop - count), count) + np.arange(stop[-1])]
        text_ends = np.concatenate(([0], stop))[np.searchsorted(begin, cuts)]
        return np.split(ids, text_ends[1:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = [i for i, t in enumerate(texts) if any(c in t for c in self.added)]
        if not marked:
            return self._ordinary(texts)
        split = {i: self.marker.split(texts[i]) for i in marked}  # every second piece is an added token
        pieces = [p for i, t in enumerate(texts) for p in (split[i][::2] if i in split else [t])]
        ids, out = iter(self._ordinary(pieces)), []
        for i in range(len(texts)):
            parts = [next(ids)]
            for token in split.get(i, [])[1::2]:
                parts += [self.added[token], next(ids)]
            out.append(np.concatenate(parts) if len(parts) > 1 else parts[0])
        return out

    def _ordinary(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts in which no added token is matched."""
        out: list = [None] * len(texts)
        easy = [i for i, t in enumerate(texts) if t and not _contraction(t) and (t.isascii() or len(t.encode("utf-16-le")) == 2 * len(t))]
        if easy:
            text = "".join(texts[i] for i in easy)
            cuts = np.concatenate(([0], np.cumsum([len(texts[i]) for i in easy])))
            for i, ids in zip(easy, self._simple(text, np.frombuffer(text.encode("utf-32-le"), np.uint32), cuts)):
                out[i] = ids
        hard = [i for i, x in enumerate(out) if x is None]
        for i in hard:
            out[i] = np.array(self.whole.encode_ordinary(texts[i]), np.uint32)
        return out


def _contraction(text: str) -> bool:
    at = text.find("'")
    while at >= 0:
        if text.startswith(("s", "t", "re", "ve", "m", "ll", "d"), at + 1):
            return True
        at = text.find("'", at + 1)
    return False


_tables: list = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size, base = 1 << max(16, n.bit_length()), 0xD1342543DE82EF95
        up, down = np.full(size, U64(base)), np.full(size, U64(pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        _tables[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _tables[0][:n], _tables[1]


class _Packer:
    """The open windows of one partition."""

    def __init__(self, window: int, open_windows: int, slack: int, partition: int):
        self.window, self.most, self.slack, self.partition = window, open_windows, slack, partition
        self.open: list[tuple[int, int]] = []  # (free, number), sorted
        self.held: dict[int, list] = {}
        self.next, self.rows = 0, []

    def _emit(self, pieces: list, sequence: int, leftover: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            blob = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(blob), total, None if leftover else sequence, offset, self.partition, blob if leftover else None))
            offset += len(ids)

    def _sequence(self) -> int:
        self.next += 1
        return (self.partition << 32) + self.next - 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, start, window = len(ids), 0, self.window
        while total - start >= window:
            self._emit([(doc, start, ids[start : start + window], total)], self._sequence())
            start += window
        while start < total:
            need = total - start
            k = bisect_left(self.open, (need, -1))
            if k == len(self.open):
                if len(self.open) < self.most:
                    insort(self.open, (window, self.next_window()))
                    continue
                free, n = self.open.pop(0)
                if free > self.slack:
                    self.held[n].append((doc, start, ids[start : start + free], total))
                    start += free
                self._emit(self.held.pop(n), self._sequence())
                continue
            free, n = self.open.pop(k)
            self.held[n].append((doc, start, ids[start:], total))
            start = total
            if free == need:
                self._emit(self.held.pop(n), self._sequence())
            else:
                insort(self.open, (free - need, n))

    def next_window(self) -> int:
        n = max(self.held, default=-1) + 1
        self.held[n] = []
        return n

    def close(self) -> None:
        pieces = [p for _, n in self.open for p in self.held[n]]
        for full, part in refilled(pieces, self.window):
            self._emit(part, self._sequence() if full else -1, leftover=not full)


def refilled(pieces: list, window: int):
    """Cut pieces into full windows, in order; the last one may be part-filled.  Yields (full, pieces)."""
    part, free = [], window
    for doc, start, ids, total in pieces:
        while len(ids):
            part.append((doc, start, ids[:free], total))
            start, ids, free = start + len(part[-1][2]), ids[free:], free - len(part[-1][2])
            if not free:
                yield True, part
                part, free = [], window
    if part:
        yield False, part


def _table(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ROWS.types)], schema=_ROWS)


def _pack(path: str, end_id: int, window: int, open_windows: int, slack: int):
    def work(batches):
        tokenizer = ByteLevelTokenizer(path)
        packer = _Packer(window, open_windows, slack, TaskContext.get().partitionId())
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids, texts, i = batch.column("doc_id").to_pylist(), batch.column("text"), 0
            while i < len(ids):
                part, held = [], 0
                while i + len(part) < len(ids) and (not part or held < _PIECE):
                    part.append(texts[i + len(part)].as_py() or "")
                    held += len(part[-1])
                for doc, tokens in zip(ids[i : i + len(part)], tokenizer.encode(part)):
                    packer.add(doc, np.concatenate((tokens, end)))
                i += len(part)
                if packer.rows:
                    yield _table(packer.rows)
                    packer.rows = []
        packer.close()
        if packer.rows:
            yield _table(packer.rows)

    return work


def _merge(window: int):
    def work(key, table):
        table = table.sort_by([("partition", "ascending"), ("offset", "ascending")])
        pieces = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in table.to_pylist()]
        packer = _Packer(window, 1, 0, (1 << 30) + key[0].as_py())
        for full, part in refilled(pieces, window):
            rest = sum(len(p[2]) for p in part)
            while not full and rest:
                size = 1 << (rest.bit_length() - 1)
                groups = [g for _, g in refilled(part, size)]
                packer._emit(groups[0], packer._sequence())
                part = [p for g in groups[1:] for p in g]
                rest -= size
            if full:
                packer._emit(part, packer._sequence())
        return pa.Table.from_batches([_table(packer.rows)], schema=_ROWS)

    return work


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = 1, window: int = 2048, open_windows: int = 32, slack: int = 16, merged: int = 64) -> DataFrame:
    """Tokenize documents and pack them into windows of ``window`` tokens.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  ``tokenizer``
    is the path of a byte-level BPE file; every document ends with ``end_id``.  A null or empty
    text is that id alone.  Repeated rows are packed once each; a null id stays null.

    Returns one row per piece: doc_id, start (ids of its document before it), length, ids_crc32,
    doc_tokens, sequence_id and offset.  A sequence is padded to ``window`` unless its length is
    a power of two.  Results depend on how rows are dealt to partitions.  An empty table gives
    no rows.

    ``merged`` partitions share the merging of their leftovers (less than a window each).
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = written(source.mapInArrow(_pack(tokenizer, end_id, window, open_windows, slack), _ROWS_SQL), "packed")
    left = packed.where("sequence_id is null").groupBy((F.col("partition") / merged).cast("long").alias("block"))
    left = left.applyInArrow(_merge(window), _ROWS_SQL)
    return packed.where("sequence_id is not null").select(*_COLUMNS).unionByName(left.select(*_COLUMNS))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2048 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
