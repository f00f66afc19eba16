import re

import numpy as np

from fairweave.llm._bytes import mix
from fairweave.llm.graph import components
from fairweave.llm.near_dedup import near_duplicates, sketch

from .corpus import frame, prose, rows


def shingles(text, width=5):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(data, per_cent):
    sets = [(r[0], shingles(r[1])) for r in data]
    label = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= per_cent * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {x: min(sets[i][0] for i in range(len(sets)) if label[i] == x) for x in label}
    return sorted((d, len(s), least[label[i]] if s else d) for i, (d, s) in enumerate(sets))


def check(spark, data, **small):
    got = near_duplicates(frame(spark, data), 85, **small).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(data, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_against_brute_force(spark):
    check(spark, rows())


def test_large_groups_are_split_without_losing_links(spark):
    """A chain of near copies, and many at the threshold, over many small cells."""
    import random

    rng = random.Random(3)
    base, data = prose(rng, 120).split(), []
    for i in range(40):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            text[rng.randrange(len(text))] = f"w{rng.randrange(10**6)}"
        data.append((i, " ".join(text), "en", "s", None, "", "", "", ""))
        if i % 5 == 4:
            base[i] = f"drift{i}"
    check(spark, data, cell_sets=7, cell_shingles=900)


def test_null_ids_and_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    data = [(None, "a b c d e f", *[None] * 7), (3, "a b c d e f", *[None] * 7), (None, "q r s", *[None] * 7)]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame(spark, data)).collect()}
    assert got == {(3, 3, True), (None, 3, False), (None, None, True)}


def test_every_coordinate_fills_and_agrees_as_often_as_sets():
    rng = np.random.default_rng(0)
    same, t = 0, 140
    for trial in range(20):
        x = mix(rng.integers(0, 2**63, 230).astype(np.uint64))
        a, b = np.sort(x[:200]), np.sort(x[30:])
        s = sketch(np.repeat([0, 1], [200, 200]), np.concatenate((a, b)), 2, t)
        assert (s != np.uint64(2**64 - 1)).all()
        same += (s[0] == s[1]).sum()
    assert abs(same / (20 * t) - 170 / 230) < 0.04
    one = sketch(np.zeros(1, int), mix(np.array([5], np.uint64)), 1, t)
    assert (one != np.uint64(2**64 - 1)).all()


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (103, 101), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, 103: 100}


def test_verified_edges_grow_with_the_group_not_its_square(spark, monkeypatch):
    """One group of m near copies: candidate edges are 28 a document at most, verified ones a few."""
    import random

    from fairweave.llm import near_dedup

    made = {}

    def counted(edges):
        made.setdefault(m, []).append(edges.count())
        return components(edges)

    monkeypatch.setattr(near_dedup, "components", counted)
    for m in (250, 1000):
        rng = random.Random(m)
        base, data = prose(rng, 80).split(), []
        for i in range(m):
            text = list(base)
            text[rng.randrange(len(text))] = f"w{rng.randrange(10**6)}"
            data.append((i, " ".join(text), "en", "s", None, "", "", "", ""))
        got = near_duplicates(frame(spark, data), 85, cell_sets=64).collect()
        assert {r.component_id for r in got} == {0}
        candidates, *verified = made[m]
        assert candidates <= 28 * m and sum(verified) <= 4 * m


def test_labels_that_meet_across_parts(spark):
    """Chains and clusters at the threshold in cells of a few sets: the second round finds what the first left."""
    import random

    rng = random.Random(5)
    data, i = [], 0
    for family in range(3):
        base = prose(rng, 100).split()
        for _ in range(30):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
                text[rng.randrange(len(text))] = f"w{rng.randrange(10**6)}"
            data.append((i, " ".join(text), "en", "s", None, "", "", "", ""))
            i += 1
            if rng.random() < 0.3:
                base[rng.randrange(100)] = f"drift{i}"
    check(spark, data, cell_sets=3, cell_shingles=300)
