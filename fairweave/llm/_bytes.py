"""Vectorised work on the UTF-8 bytes of many texts at once (numpy only).

Texts of an Arrow column lie one after another in one buffer; the functions here
see that buffer and the offsets at which each text starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_M1, _M2, _M3 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``limit`` bytes, or one longer text each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_pieces(text: bytes, table: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, about ``piece`` bytes at a time; ``table`` translates bytes, then ASCII spaces part words."""
    cut = b""
    for at in range(0, len(text), piece):
        part = cut + text[at : at + piece].translate(table)
        found = part.split()
        cut = found.pop() if found and at + piece < len(text) and not part[-1:].isspace() else b""
        yield found


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name for an ordered pair of names."""
    x = (a ^ (a >> U64(29))) * _M2 + (b ^ (b >> U64(32))) * _M3
    return x ^ (x >> U64(31))


def byte_names(seed: int) -> np.ndarray:
    """A random 64-bit name for each byte value."""
    return mix(np.arange(1, 257, dtype=U64) * _M3 + U64(seed))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        base = 0xD1342543DE82EF95
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, U64(base)), np.full(size, U64(inverse))
        up[0] = down[0] = 1
        _powers.clear()
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A word byte is anything but a space or one of the controls 9 to 13.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_NAMES = byte_names(0x5EED)


def words(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = NOT_SPACE, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start byte, 64-bit name) of every word, ASCII letters lower-cased; words also end at ``cuts``."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    low = LOWER[raw]
    inside = word_byte[low]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets if cuts is None else np.concatenate((offsets, cuts))
    edges = edges[(edges > 0) & (edges < len(raw))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum(_NAMES[low] * up[: len(raw)], out=sums[1:])
    names = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * _M3)
    counts = np.diff(np.searchsorted(starts, offsets))
    return np.repeat(np.arange(len(offsets) - 1), counts), starts, names


def planes(keys: np.ndarray) -> bytes:
    """Bytes of sorted fixed-width keys, plane by plane: leading planes compress well."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(len(keys), keys.itemsize).T.tobytes()


def unplanes(blob: bytes, dtype=U64) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def bucket_edges(keys: np.ndarray, n: int) -> np.ndarray:
    """For sorted keys: where each of ``n`` equal ranges of key space starts, and the end."""
    marks = np.array([(i << 64) // n for i in range(1, n)], dtype=U64)
    return np.concatenate(([0], np.searchsorted(keys, marks), [len(keys)]))
