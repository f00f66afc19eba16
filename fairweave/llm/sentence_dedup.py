"""Removal of repeated text by sliding spans of consecutive sentences.

A sentence ends after a word that ends in a full stop, question or exclamation mark of any
script, closing quotes and brackets behind it included, and at a line break; marks of scripts
without blanks end a word too.  From every sentence a span runs over as many whole sentences,
two at least, as hold ``span_words`` words; where ``long_words`` is given, a sentence of so many
words or more is a span of its own.  With no ``span_words`` every two sentences in a row are a span: a longer run repeats
only if all its pairs do, so the pairs cover every repeated run of several sentences.  Where a
span starts and ends depends on its words alone, so equal passages give equal spans
wherever they stand.  Spans are compared by their words, ASCII letters lower-cased.

Chunks send their distinct span names to buckets of name space, where equal names of all
chunks meet; the answer tells a chunk which of its names an earlier chunk has.  All
sentences that lie in a span which is not the first of its name are removed.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import NOT_SPACE, U64, _power_tables, mix, runs, text_buffer, words
from fairweave.llm._shared import range_chunk, table
from fairweave.llm.substring_dedup import _ROWS_SQL, _answer_positions, _asked, _joined, distinct_names

_PIECE = 1 << 20
_OUT = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])
_OUT_SQL = "doc_id long, n_sentences long, n_removed long, n_spans long, kept_sha256 string, text string"
#: Marks that end a sentence; those that also end it inside a stretch without blanks; quotes and brackets
#: that may stand behind one; those of them that never open.
_STOPS, _INNER = ".!?。！？．｡…‼⁇⁈⁉؟۔।॥։።។။", "。！？｡।॥።។။"
_CLOSERS, _CLOSING = "\"')]}”’»›“‘«」』）】》〉〕］｝", ")]}”’»›」』）】》〉〕］｝"


def _codes(chars: str) -> np.ndarray:
    return np.array(sorted(int.from_bytes(c.encode(), "big") for c in chars), np.int64)


_STOP, _INNER_STOP, _CLOSER, _FOLLOWING = _codes(_STOPS), _codes(_INNER), _codes(_CLOSERS), _codes(_STOPS + _CLOSING)


def _code(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ``size`` (1 to 3) bytes from ``at`` on as a number."""
    code = raw[at].astype(np.int64)
    for k in (1, 2):
        code = np.where(size > k, code << 8 | raw[np.minimum(at + k, len(raw) - 1)], code)
    return code


def _stopped(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether words end in a stop, or in one with closers behind it."""
    out, end, at = np.zeros(len(start), bool), end.copy(), np.arange(len(start))
    while len(at):
        e, size = end[at], np.ones(len(at), np.int64)
        for _ in range(2):  # back to the first byte of a character
            size += (raw[e - size] & 0xC0 == 0x80) & (e - size > start[at])
        code = _code(raw, e - size, size)
        out[at[np.isin(code, _STOP)]] = True
        more = np.isin(code, _CLOSER)
        end[at[more]] -= size[more]
        at = at[more & (e - size > start[at])]
    return out


def _inner_ends(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where sentences end by a stop that needs no blank after it, further stops and closers included."""
    at = np.flatnonzero(raw >= 0xC2)
    size = np.where(raw[at] >= 0xE0, 3, 2)
    hit = np.isin(_code(raw, at, size), _INNER_STOP)
    out = at[hit] + size[hit]
    limit = offsets[np.searchsorted(offsets, at[hit], "right")]
    go = np.flatnonzero(out < limit)
    while len(go):
        lead = raw[out[go]]
        size = np.where(lead >= 0xE0, 3, np.where(lead >= 0xC2, 2, 1))
        more = np.isin(_code(raw, out[go], size), _FOLLOWING)
        out[go[more]] += size[more]
        go = go[more]
        go = go[out[go] < limit[go]]
    return out


def sentence_spans(raw: np.ndarray, offsets: np.ndarray, span_words: int, long_words: int):
    """Sentences as (text, first byte, end byte), and spans as (name, 32 more bits of it, first sentence, last sentence)."""
    doc, start, name = words(raw, offsets, cuts=_inner_ends(raw, offsets))
    none = np.zeros(0, np.int64)
    if not len(doc):
        return none, none, none, np.zeros(0, U64), np.zeros(0, np.uint32), none, none
    limit = np.append(start[1:], len(raw))
    limit = np.minimum(limit, offsets[doc + 1])  # where the next word, or the text's end, is
    gaps = np.concatenate(([0], np.cumsum(~NOT_SPACE[raw])))
    end = limit - (gaps[limit] - gaps[start])
    lines = np.concatenate(([0], np.cumsum(raw == 10)))
    stop = _stopped(raw, start, end) | (lines[limit] > lines[end])
    stop[:-1] |= doc[1:] != doc[:-1]
    stop[-1] = True
    last = np.flatnonzero(stop) + 1  # words, exclusive
    first = np.concatenate(([0], last[:-1]))
    owner = doc[first]
    from_byte = start[first]
    to_byte = np.append(from_byte[1:], len(raw))
    to_byte = np.minimum(to_byte, offsets[owner + 1])
    at = np.arange(len(first))
    until = np.searchsorted(last, first + span_words)
    long, until = (last - first >= long_words) & (long_words > 0), np.maximum(until, at + 1)
    if span_words:
        until = np.where(long, at, until)
    else:
        alone = np.flatnonzero(long)
        at, until = np.concatenate((at, alone)), np.concatenate((until, alone))
        order = np.argsort(at, kind="stable")
        at, until = at[order], until[order]
    ok = until < len(first)
    ok[ok] &= owner[until[ok]] == owner[at[ok]]
    at, until = at[ok], until[ok]
    up, down = _power_tables(len(name) + 1)
    a, b = first[at], last[until]

    def spans(of: np.ndarray) -> np.ndarray:
        total = np.zeros(len(of) + 1, U64)
        np.cumsum(of * up[: len(of)], out=total[1:])
        return mix((total[b] - total[a]) * down[a] + (b - a).astype(U64))

    return owner, from_byte, to_byte, spans(name), (spans(mix(name)) >> U64(32)).astype(np.uint32), at, until


class _Chunk:
    def __init__(self, table: pa.Table, span_words: int, long_words: int):
        self.table = table.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.raw, self.offsets = text_buffer(self.table.column("text"))
        parts, sentences = [], 0
        for i, j in runs(self.offsets, _PIECE):
            base = self.offsets[i]
            owner, a, b, span, more, s, e = sentence_spans(self.raw[base : self.offsets[j]], self.offsets[i : j + 1] - base, span_words, long_words)
            parts.append((owner + i, a + base, b + base, span, more, s + sentences, e + sentences))
            sentences += len(owner)
        self.owner, self.begin, self.end, self.span, self.more, self.first, self.last = (np.concatenate(p) for p in zip(*parts))
        self.where, self.number = distinct_names(self.span, self.more)


def _ask(span_words: int, long_words: int, buckets: int):
    def ask(key, table):
        c = _Chunk(table, span_words, long_words)
        return _asked(key[0].as_py(), 1, c.span[c.where], buckets, c.more[c.where])

    return ask


def _finish(span_words: int, long_words: int):
    def finish(key, docs, answers):
        if not len(docs):
            return _OUT.empty_table()
        c = _Chunk(docs, span_words, long_words)
        repeated = _joined(answers, 1, len(c.where)).astype(bool)[c.number]
        later = np.ones(len(c.span), bool)
        later[c.where] = False
        repeated |= later
        cover = np.zeros(len(c.owner) + 1, np.int64)
        np.add.at(cover, c.first[repeated], 1)
        np.add.at(cover, c.last[repeated] + 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        n = len(c.table)
        spans = np.bincount(c.owner[c.first[repeated]], minlength=n)
        bounds = np.searchsorted(c.owner, np.arange(n + 1))
        rows = []
        for i, doc_id in enumerate(c.table.column("doc_id").to_pylist()):
            a, b = bounds[i], bounds[i + 1]
            data, at, kept = c.raw, int(c.offsets[i]), []
            for k in np.flatnonzero(gone[a:b]) + a:
                kept.append(data[at : c.begin[k]].tobytes())
                at = int(c.end[k])
            kept = b"".join([*kept, data[at : c.offsets[i + 1]].tobytes()])
            rows.append((doc_id, int(b - a), int(gone[a:b].sum()), int(spans[i]), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), _OUT.types)], schema=_OUT)

    return finish


def remove_repeated_sentences(docs: DataFrame, *, span_words: int = 20, long_words: int = 0, chunk_bytes: int = 8 << 20, bucket_names: int = 1 << 20) -> DataFrame:
    """Remove sentences that lie in a repeated span of consecutive sentences.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  A span repeats if
    the same words stand in a document of a smaller id, or earlier in the same document.  With a
    ``span_words`` of 0 every two sentences in a row are a span, so every repeated run of several is removed.
    A sentence alone is a span only where ``long_words`` is given and it has so many words.

    Returns one row per input row: doc_id, n_sentences, n_removed, n_spans (repeated spans), kept_sha256
    and text (what is left).  A null or empty text has no sentence and its kept text is empty.  Rows of
    the same id are taken in the order of their texts; rows of a null id come last, in the order of a hash of
    their texts, then their texts.  An empty table gives no rows.  Spans are told apart by 96-bit names.
    """
    chunked, n_chunks = range_chunk(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chunk_bytes)
    buckets = max(48, math.ceil(n_chunks * chunk_bytes / 60 / bucket_names))
    dealt = chunked.groupBy("chunk")
    answers = dealt.applyInArrow(_ask(span_words, long_words, buckets), _ROWS_SQL).groupBy("bucket").applyInArrow(_answer_positions, _ROWS_SQL)
    return dealt.cogroup(answers.groupBy("chunk")).applyInArrow(_finish(span_words, long_words), _OUT_SQL)


def op6_sentence_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated runs of two or more sentences of all ``documents``."""
    return remove_repeated_sentences(table(spark, sf_dir, "documents"), span_words=0)
