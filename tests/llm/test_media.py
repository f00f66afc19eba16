import hashlib
import zlib

import numpy as np
import pytest

from fairweave.llm.media import _own_chunks, cuts, describe, store_media

from .corpus import frame, rows


def payload(text):
    b = (text or "").encode()
    return b, b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))


def test_against_the_texts(spark):
    got = store_media(frame(spark), bits=6, least=64, most=512).collect()
    want = []
    for doc_id, text, *_ in rows():
        b, p = payload(text)
        want.append((doc_id, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), describe(np.frombuffer(p, np.uint8))))
    assert sorted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.feature) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.payload_sha256, set()).add((r.media_bytes, r.media_sha256))
    assert all(len(v) == 1 for v in by.values())


def test_empty_table_and_null_id(spark):
    assert store_media(frame(spark, [])).collect() == []
    (r,) = store_media(frame(spark, [(None, None, *[None] * 7)])).collect()
    assert (r.doc_id, r.n_bytes, r.payload_bytes) == (None, 0, 576)


def test_cuts_follow_the_content():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 60_000).astype(np.uint8)
    a = cuts(data, 9, 100, 4000)
    assert a[-1] == len(data)
    assert all(100 <= y - x <= 4000 for x, y in zip([0, *a], a[:-1]))
    moved = np.concatenate((np.arange(77, dtype=np.uint8), data))
    b = cuts(moved, 9, 100, 4000)
    shared = {bytes(data[x:y]) for x, y in zip([0, *a], a)} & {bytes(moved[x:y]) for x, y in zip([0, *b], b)}
    assert len(shared) > 0.8 * len(a)


def test_damage_is_found():
    import zstandard

    row = {"doc_id": 1, "blob": zstandard.ZstdCompressor().compress(b"abcX"), "lengths": [4], "borrowed": [], "digests": [hashlib.sha256(b"abcd").digest()]}
    with pytest.raises(ValueError):
        _own_chunks(row)


def test_rows_that_repeat_under_one_id(spark):
    """Equal and different texts of one id and of none, with stretches in common."""
    part = "".join(f"line {i} of a shared stretch; " for i in range(120))
    texts = [(1, part), (1, part), (1, "head " + part), (None, part + " tail"), (None, part + " tail"), (2, "head " + part), (None, ""), (3, "x" * 3000)]
    got = store_media(frame(spark, [(*t, *[None] * 7) for t in texts]), bits=6, least=64, most=512).collect()
    want = sorted((repr(i), len(payload(t)[0]), hashlib.sha256(payload(t)[1]).hexdigest()) for i, t in texts)
    assert sorted((repr(r.doc_id), r.n_bytes, r.payload_sha256) for r in got) == want


def test_rows_without_an_id_are_looked_up_by_text(spark):
    """Many texts that share a stretch and have no id: no row meets the chunk lists of all others."""
    from glob import glob

    from fairweave.llm._shared import shared_folder

    part = "".join(f"line {i} of a shared stretch; " for i in range(60))
    texts = [f"{i} {part} {i}" for i in range(1000)]
    before = set(glob(f"{shared_folder(spark)}/tables/odd-payloads-*"))
    got = store_media(frame(spark, [(None, t, *[None] * 7) for t in texts]), bits=6, least=64, most=512).collect()
    assert sorted(r.payload_sha256 for r in got) == sorted(hashlib.sha256(payload(t)[1]).hexdigest() for t in texts)
    (table,) = set(glob(f"{shared_folder(spark)}/tables/odd-payloads-*")) - before
    assert spark.read.parquet(table).selectExpr("count(*) > 900", "max(size(odd)) = 1").first()[:] == (True, True)
