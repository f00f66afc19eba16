import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from fairweave.llm import resampling
from tests.llm.corpus import SCHEMA, frame, prose, rows

TARGET = ["One two three one", None, "the harvest of words", "日本語 a"]


def feats(text, most=1):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return ws, [zlib.crc32(" ".join(ws[i : i + n]).encode()) % 10000 for n in range(1, most + 1) for i in range(len(ws) - n + 1)]


def naive(data, target, per_cent=10, most=1):
    s, t = [0] * 10000, [0] * 10000
    for text, into in [*((d[1], s) for d in data), *((x, t) for x in target)]:
        for f in feats(text, most)[1]:
            into[f] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text, *_ in data:
        ws, fs = feats(text, most)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in fs)
        out.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ws)])
    some = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(some[: per_cent * len(some) // 100]):
        r[4] = k + 1
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


def result(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("per_cent,most", [(10, 1), (100, 1), (60, 3), (0, 1)])
def test_odd_rows_against_brute_force(spark, per_cent, most):
    data = rows() + [(None, rows()[12][1], *[None] * 7), (None, None, *[None] * 7)]
    target = spark.createDataFrame([(x, 1) for x in TARGET], "text string, doc_id int")
    got = resampling.resample(frame(spark, data), target, per_cent=per_cent, most=most)
    assert result(got) == naive(data, TARGET, per_cent, most)


def test_many_runs_and_segments(spark):
    rng = random.Random(4)
    data = [(i % 300, prose(rng, rng.choice([5, 25, 40])), *[None] * 7) for i in range(400)]
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    got = resampling.resample(frame(spark, data).repartition(5), target, per_cent=70, run_rows=16, segment_rows=4)
    assert result(got) == naive(data, TARGET, 70)


def test_rows_that_tie_are_split(spark):
    """Half of the rows are the same row: they are dealt to several segments, and ranks have no gaps."""
    data = [(7, "one two three " * 10, *[None] * 7)] * 200 + [(i, "other words " * 15 + str(i), *[None] * 7) for i in range(200)]
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    got = resampling.resample(frame(spark, data).repartition(3), target, per_cent=100, segment_rows=10)
    assert result(got) == naive(data, TARGET, 100)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), frame(spark)
    assert not resampling.resample(none, some).count()
    assert result(resampling.resample(some, none)) == naive(rows(), [])


@pytest.mark.parametrize("piece", [1, 9, 64])
def test_features_of_texts_in_pieces(piece):
    for text in ("", "a", "One-two  three\n4 é" * 9, "x" * 200 + " y"):
        for most in (1, 2, 4):
            found = list(resampling.features(text.encode(), most, 10000, piece))
            assert sorted(np.concatenate([np.zeros(0, int), *(f for _, f in found)]).tolist()) == sorted(feats(text, most)[1])
            assert sum(n for n, _ in found) == len(feats(text)[0])
