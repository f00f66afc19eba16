"""Media columns: payloads cut by content, stored once per distinct chunk, and verified.

A text's bytes become a payload of 8-bit samples.  A rolling gear hash cuts it into
chunks wherever the hash's top bits are zero, so equal stretches give equal chunks in
any payload.  Spark joins find, for each chunk digest, the one payload that owns it; the
store holds a payload's own chunks (compressed) and its ordered chunk list.  A payload
is read back by decoding its own chunks and joining the rest from their owners; every
chunk and the whole are checked against their digests.

The stored form of a payload is a container: a 20-byte header (magic, version, sample
bits, chunk count, payload length), for each chunk its length and SHA-256, then the samples.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import U64, byte_names, runs, text_buffer
from fairweave.llm._shared import sized, table, written

UNIT = 576
_PIECE = 1 << 19
_GEAR = byte_names(0x6EA2)
_LIST = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.binary()), ("n_bytes", pa.int64()), ("digests", pa.list_(pa.binary()))])
_LIST_SQL = "doc_id long, text_hash long, key binary, n_bytes long, digests array<binary>"
_STORE = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("digests", pa.list_(pa.binary())), ("lengths", pa.list_(pa.int32())), ("borrowed", pa.list_(pa.int32())), ("blob", pa.binary())])
_STORE_SQL = "doc_id long, key binary, digests array<binary>, lengths array<int>, borrowed array<int>, blob binary"
_LENT = pa.schema([("digest", pa.binary()), ("data", pa.binary())])
_FEATURES = pa.schema([("key", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
_FEATURES_SQL = "key binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _gear(raw: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum of the last 32 bytes' values, each shifted by its distance."""
    h, m = _GEAR[raw], 1
    while m < 32:
        out = h.copy()
        out[m:] += h[:-m] << U64(m)
        h, m = out, 2 * m
    return h


def cuts(payload: np.ndarray, bits: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of one payload."""
    marks = np.flatnonzero(_gear(payload) >> U64(64 - bits) == 0) + 1
    out, at, n = [], 0, len(payload)
    while n - at > least:
        i = int(np.searchsorted(marks, at + least))
        at = int(min(marks[i] if i < len(marks) else n, at + most, n))
        out.append(at)
    if at < n:
        out.append(n)
    return out


def _padded(raw: np.ndarray) -> np.ndarray:
    size = max(1, -(-len(raw) // UNIT)) * UNIT
    out = np.full(size, 255, np.uint8)
    out[: len(raw)] = raw
    return out


def _chunked(batch, bits, least, most):
    """(row, bytes of the text, payload, chunk list) of each row."""
    raw, offsets = text_buffer(batch.column("text"))
    for i in range(len(offsets) - 1):
        payload = _padded(raw[offsets[i] : offsets[i + 1]])
        data, ends = payload.tobytes(), cuts(payload, bits, least, most)
        yield i, int(offsets[i + 1] - offsets[i]), data, [data[a:b] for a, b in zip([0, *ends], ends)]


def _record(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema.types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _lists(bits, least, most):
    def work(batches):
        for batch in batches:
            ids, hashes, rows = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), []
            for i, n, data, chunks in _chunked(batch, bits, least, most):
                rows.append((ids[i], hashes[i], hashlib.sha256(data).digest(), n, [hashlib.sha256(c).digest() for c in chunks]))
            yield _record(rows, _LIST)

    return work


def _store(bits, least, most):
    def work(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, odd, rows, held = batch.column("doc_id").to_pylist(), batch.column("odd"), [], 0
            for i, _, data, chunks in _chunked(batch, bits, least, most):
                key = hashlib.sha256(data).digest()
                own = next((o for o in odd[i].as_py() or [] if o["key"] == key), None)
                if own and own["copy"]:
                    continue
                borrowed = sorted(own["borrowed"]) if own else []
                skip = set(borrowed)
                blob = squeeze.compress(b"".join(c for k, c in enumerate(chunks) if k not in skip))
                rows.append((ids[i], key, [hashlib.sha256(c).digest() for c in chunks], [len(c) for c in chunks], borrowed, blob))
                held += len(blob)
                if held > 4 << 20:
                    yield _record(rows, _STORE)
                    rows, held = [], 0
            yield _record(rows, _STORE)

    return work


def _own_chunks(row: dict) -> dict[int, bytes]:
    """A stored row's own chunks by place, checked."""
    data, at, out, borrowed = zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=sum(row["lengths"]) + 1), 0, {}, set(row["borrowed"])
    for k, n in enumerate(row["lengths"]):
        if k not in borrowed:
            out[k] = data[at : at + n]
            at += n
            if hashlib.sha256(out[k]).digest() != row["digests"][k]:
                raise ValueError(f"chunk {k} of a payload of document {row['doc_id']} is damaged")
    return out


def describe(samples: np.ndarray) -> str:
    """Features of 8-bit samples around 128: level, spread, sign changes, peak and entropy."""
    centred = samples.astype(np.float64) - 128.0
    changes = int(np.count_nonzero(np.diff(np.signbit(centred))))
    share = np.bincount(samples, minlength=256) / len(samples)
    share = share[share > 0]
    return f"mean={centred.mean():.4f};rms={np.sqrt((centred**2).mean()):.4f};crossings={changes};peak={int(np.abs(centred).max())};entropy={-(share * np.log2(share)).sum():.4f}"


def _features(row: dict, chunks: dict[int, bytes]) -> tuple:
    data = b"".join(chunks[k] for k in range(len(row["lengths"])))
    if hashlib.sha256(data).digest() != row["key"]:
        raise ValueError(f"the payload of document {row['doc_id']} is damaged")
    index = b"".join(struct.pack("<I", n) + d for n, d in zip(row["lengths"], row["digests"]))
    media = struct.pack("<4sHHIQ", b"FWMC", 1, 8, len(row["lengths"]), len(data)) + index + data
    return row["key"], len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(media), hashlib.sha256(media).hexdigest(), describe(np.frombuffer(data, np.uint8))


def _read_whole(batches):
    for batch in batches:
        for i in range(0, len(batch), 512):
            yield _record([_features(r, _own_chunks(r)) for r in batch.slice(i, 512).to_pylist()], _FEATURES)


def _lend(batches):
    for batch in batches:
        for row in batch.to_pylist():
            chunks, rows = _own_chunks(row), []
            for k in sorted(set(row["lent"])):
                if k in chunks:
                    rows.append((row["digests"][k], chunks[k]))
            yield _record(rows, _LENT)


def _read_mixed(key, stored, lent):
    if not len(stored):
        return _FEATURES.empty_table()
    row = stored.slice(0, 1).to_pylist()[0]
    chunks = _own_chunks(row)
    by = dict(zip(lent.column("digest").to_pylist(), lent.column("data").to_pylist()))
    for k in row["borrowed"]:
        chunks[k] = by[row["digests"][k]]
        if hashlib.sha256(chunks[k]).digest() != row["digests"][k]:
            raise ValueError("a borrowed chunk is damaged")
    return pa.Table.from_batches([_record([_features(row, chunks)], _FEATURES)])


def store_media(docs: DataFrame, *, bits: int = 11, least: int = 512, most: int = 8192) -> DataFrame:
    """Store every text's payload in content-defined chunks, read it back and describe it.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  The payload is the
    text's UTF-8 bytes, with bytes 255 up to a positive multiple of 576.  Chunks have about
    ``least + 2**bits`` bytes, at most ``most``.

    Returns one row per input row: doc_id, n_bytes (without padding), payload_bytes,
    payload_sha256, tail_crc32 (last 32 bytes), media_bytes, media_sha256 (of the container) and
    feature; all but n_bytes come from the bytes read back.  Equal payloads are stored once.  A null
    text is empty: 576 bytes of padding.  Repeated rows and null ids keep their rows.  An empty
    table gives no rows.  Damaged bytes raise an error.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    lists = written(source.mapInArrow(_lists(bits, least, most), _LIST_SQL), "chunk-lists")
    # of equal payloads the least id's is stored; of equal chunks the first in the least id's payload
    payload = lists.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.any_value("text_hash").alias("text_hash"), F.any_value("digests").alias("digests"))
    place = payload.select("keeper", "key", "text_hash", F.posexplode("digests").alias("k", "digest"))
    owner = place.groupBy("digest").agg(F.min(F.struct("keeper", "key", "k")).alias("owner"), F.count("*").alias("times")).where("times > 1")
    shared = written(place.join(owner.select("digest", "owner"), "digest"), "shared-chunks")
    borrowed = shared.where(~F.struct("keeper", "key", "k").eqNullSafe(F.col("owner"))).select("keeper", "key", "text_hash", "k", "digest", "owner")
    odd = borrowed.groupBy("keeper", "key", "text_hash").agg(F.sort_array(F.collect_list("k")).alias("borrowed"))
    # a row is a copy if another id keeps its payload; rows that repeat under one id are stored alike
    kept = lists.select("doc_id", "text_hash", "key").join(payload.select("key", "keeper"), "key")
    copies = kept.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "text_hash", "key").distinct()
    odd = odd.select(F.col("keeper").alias("doc_id"), "text_hash", "key", F.lit(False).alias("copy"), "borrowed").unionByName(copies.withColumns({"copy": F.lit(True), "borrowed": F.array().cast("array<int>")}))
    # by id and text, as many rows may share an id or have none; the list holds more than one payload only if hashes collide
    odd = written(odd.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("key", "copy", "borrowed")).alias("odd")), "odd-payloads")
    small = sized(odd)
    stored = source.join(small, source["doc_id"].eqNullSafe(small["doc_id"]) & (source["text_hash"] == small["text_hash"]), "left").select(source["doc_id"], "text", "odd")
    stored = written(stored.mapInArrow(_store(bits, least, most), _STORE_SQL), "store")

    whole = stored.where("size(borrowed) = 0").mapInArrow(_read_whole, _FEATURES_SQL)
    lenders = borrowed.groupBy(F.col("owner.keeper").alias("lender"), F.col("owner.key").alias("lender_key")).agg(F.collect_set("owner.k").alias("lent"))
    lenders = sized(written(lenders, "lenders"))
    lent = stored.join(lenders, (F.col("key") == F.col("lender_key")) & F.col("doc_id").eqNullSafe(F.col("lender"))).drop("lender", "lender_key")
    lent = lent.mapInArrow(_lend, "digest binary, data binary").dropDuplicates(["digest"])
    wanted = borrowed.select("key", "digest").distinct().join(lent, "digest")
    mixed = stored.where("size(borrowed) > 0").groupBy("key").cogroup(wanted.groupBy("key")).applyInArrow(_read_mixed, _FEATURES_SQL)
    described = whole.unionByName(mixed).dropDuplicates(["key"])
    return lists.select("doc_id", "n_bytes", "key").join(described, "key").drop("key")


def op7_media_columns(spark, sf_dir: str) -> DataFrame:
    """The payloads of all ``documents``."""
    return store_media(table(spark, sf_dir, "documents"))
