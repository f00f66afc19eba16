import numpy as np
import pytest
import xxhash

from fairweave.llm import simhash
from tests.llm.corpus import SCHEMA, frame, prose, rows


def hashes(text, width=3):
    ws = (text or "").encode().lower().split()
    grams = [b" ".join(ws[i : i + width]) for i in range(len(ws) - width + 1)] if len(ws) >= width else [b" ".join(ws)] * bool(ws)
    return [xxhash.xxh64_intdigest(g, 42) for g in grams]


def naive(data, radius=2):
    prints = []
    for _, text, *_ in data:
        hs = hashes(text)
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    group = list(range(len(data)))
    for _ in data:
        for i in range(len(data)):
            for j in range(len(data)):
                if (prints[i] ^ prints[j]).bit_count() <= radius:
                    group[i] = min(group[i], group[j])
    ids = {}
    for i, g in enumerate(group):
        if data[i][0] is not None:
            ids[g] = min(data[i][0], ids.get(g, data[i][0]))
    return sorted((repr(data[i][0]), f"{prints[i]:016x}", repr(ids.get(group[i]))) for i in range(len(data)))


def result(df):
    return sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in df.collect())


def test_odd_rows_against_brute_force(spark):
    data = rows() + [(None, rows()[12][1], *[None] * 7), (None, "text of its own without an id", *[None] * 7), (901, None, *[None] * 7)]
    assert result(simhash.simhash_duplicates(frame(spark, data))) == naive(data)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_near_copies_at_other_radii(spark, radius):
    import random

    rng = random.Random(radius)
    base = prose(rng, 60).split(" ")
    data = []
    for i in range(60):
        ws = list(base)
        for _ in range(rng.randrange(4)):
            ws[rng.randrange(len(ws))] = "w" + str(rng.randrange(9))
        data.append((i, " ".join(ws), *[None] * 7))
    assert result(simhash.simhash_duplicates(frame(spark, data), radius)) == naive(data, radius)


def test_long_lists_are_listed_anew(spark):
    """With lists of two rows at most, fingerprints still meet, whatever block they differ in."""
    data = rows(3)
    assert result(simhash.simhash_duplicates(frame(spark, data), list_rows=2, cell_rows=16)) == naive(data)


def test_empty_table(spark):
    got = simhash.simhash_duplicates(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "n_shingles", "fingerprint", "component_id"] and not got.count()


def test_all_pairs_of_tiles():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    value = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 63, 40).astype(np.uint64)) for _ in range(12))]))
    value = value[np.argsort(np.bitwise_count(value), kind="stable")]
    i, j = simhash.tile_links(value, np.zeros(len(value), int), 2, tile=16)
    want = {(a, b) for a in range(len(value)) for b in range(a + 1, len(value)) if (int(value[a]) ^ int(value[b])).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_texts_in_pieces(piece):
    for text in ("a", " one  two ", "One two three four\nfive ", "x" * 300 + " y " + "z" * 90 + " w v", "é ß\x0bq \x1c r"):
        got = [int(h) for part in simhash.shingle_hashes(text.encode(), 3, 42, piece) for h in part]
        assert got == hashes(text)


def test_counts_of_long_runs():
    rng = np.random.default_rng(2)
    sizes = np.array([0, 1, 254, 255, 256, 1000, 0])
    h = rng.integers(0, 1 << 64, sizes.sum(), dtype=np.uint64, endpoint=False)
    got, at = simhash.bit_counts(h, sizes), 0
    for k, n in enumerate(sizes):
        assert got[k].tolist() == [int(((h[at : at + n] >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
        at += n
