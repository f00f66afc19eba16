import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairweave.llm import manifest
from tests.llm.corpus import SCHEMA, frame, rows

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(level, fan):
    """All levels from the leaves to the root."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fan])) for i in range(0, len(out[-1]), fan)])
    return out


def siblings(levels, i, fan):
    for level in levels[:-1]:
        start = i - i % fan
        yield level[start:i], level[i + 1 : start + fan]
        i //= fan


def naive(data, fan=8):
    trees = {}
    for row in data:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    held = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        held[lang] = climb([leaf(r) for r in trees[lang]], fan)
    top = climb([held[lang][-1][0] for lang in order], fan) if order else None
    out = []
    for t, lang in enumerate(order):
        for i, row in enumerate(trees[lang]):
            path = [*siblings(held[lang], i, fan), *siblings(top, t, fan)]
            tamper = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 3 == 0
            at = leaf(row, tamper)
            for left, right in path:
                at = sha("".join(left) + at + "".join(right))
            proof = sha("".join(h for left, right in path for h in left + right))
            out.append((row[0], leaf(row), held[lang][-1][0], top[-1][0], proof, at, at == top[-1][0]))
    return sorted(map(repr, out))


def result(docs, **options):
    lower = manifest.leaf_hash([F.translate("text", manifest._UPPER, manifest._LOWER) if c == "text" else F.col(c) for c in FIELDS])
    claims = F.when(manifest.remainder(F.col("doc_id"), 3) == 0, lower)
    got = manifest.prove_rows(manifest.build_manifest(docs, FIELDS, "lang", claims=claims, **options))
    return sorted(repr(tuple(r)) for r in got.select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize("options", [{}, {"height": 1}, {"height": 2, "part_rows": 5}, {"fan": 3, "height": 2}])
def test_odd_rows_against_brute_force(spark, options):
    data = rows() + [(None, "Without an id", None, None, *[None] * 5), (None, None, "en", "Ä", 9, *[None] * 4), *[(55, "Same Row", "de", "s", 1, *[None] * 4)] * 9]
    assert result(frame(spark, data), **options) == naive(data, options.get("fan", 8))


@pytest.mark.parametrize("sizes", [[1], [8], [64, 9], [65, 1, 8, 63, 2, 7, 9, 1, 1]])
def test_sizes_at_the_edges_of_blocks(spark, sizes):
    data = [(100 * t + i, f"Text {i}", f"l{t}", "s", i, *[None] * 4) for t, n in enumerate(sizes) for i in range(n)]
    assert result(frame(spark, data), height=1, part_rows=20) == naive(data)
    assert result(frame(spark, data), height=2, part_rows=20) == naive(data)


def test_empty_table(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("fan,levels", [(2, 1), (2, 6), (3, 4), (8, 5)])
def test_layout(fan, levels):
    """Every node has a place of its own; each subtree that the recursion splits off lies together."""
    place = {(d, i): int(a) for d in range(levels) for i, a in enumerate(manifest.address(d, np.arange(fan**d), levels, fan))}
    assert sorted(place.values()) == list(range(manifest.nodes(levels, fan)))

    def check(depth, index, height, start):
        own = [place[depth + d, index * fan**d + k] for d in range(height) for k in range(fan**d)]
        assert sorted(own) == list(range(start, start + len(own)))
        if height > 1:
            upper = height // 2
            check(depth, index, upper, start)
            for k in range(fan**upper):
                check(depth + upper, index * fan**upper + k, height - upper, start + manifest.nodes(upper, fan) + k * manifest.nodes(height - upper, fan))

    check(0, 0, levels, 0)


def test_a_block_is_read_back_as_built():
    for n in (1, 7, 8, 9, 63, 64):
        leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        for alone in {n < 64, False}:
            b = manifest.Block.built(b"".join(leaves), alone, 8, 2)
            again = manifest.Block(b.n, b.top, b.store.tobytes(), 8, 2)
            assert again.level(2) == b"".join(leaves)
            assert all(manifest.folded(d, p) == again.root for d, p in zip(leaves, again.paths()))
