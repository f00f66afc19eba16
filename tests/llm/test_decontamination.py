import hashlib
import math
import random
import re

import pytest

from fairweave.llm import _shared
from fairweave.llm.decontamination import find_contamination

from .corpus import frame, rows


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, width=13, near=0.9):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found, held = words(text), set(), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
                    held.add(tuple(w[i : i + n]))
        close = 0
        for window in set(windows) - held:
            own, stretch = set(window), len(window) + 3
            close += any(len(own & set(w[i : i + stretch])) >= math.ceil(near * len(own)) for i in range(len(w)))
        ids = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w), close))
    return sorted(out, key=repr)


ITEMS = "item_id long, text string, words string, term string"


def test_against_brute_force(spark):
    texts = [r[1] or "" for r in rows()]
    items = [(1, texts[10]), (2, " ".join(texts[10].upper().split()[5:25])), (3, "One, two"), (4, None), (5, "!!"), (6, texts[13]), (12, texts[13]), (7, "日本語 テキスト"), (8, "never seen anywhere"), (1, "a"), (9, "spam spam")]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    got = find_contamination(frame(spark), table).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows(), items)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    docs = [item, item.replace("zeta eta", "eta zeta"), "alpha and nothing like the rest of it", item.replace("kappa", "other"), item.replace("kappa", "other").replace("mu ", ""), item.replace("zeta", "zeta x y z"), item.replace("zeta", "zeta v x y z"), "w " * 40 + item.replace("alpha", "omega")]
    table = spark.createDataFrame([(1, item, "", "")], ITEMS)
    rows = [(i, t, *[None] * 7) for i, t in enumerate(docs)] + [(None, None, *[None] * 7)]
    got = {r.doc_id: (r.n_hit, r.contaminated, r.n_near) for r in find_contamination(frame(spark, rows), table).collect()}
    none = (0, False, 0)
    near = (0, False, 1)
    # the last words in order: all but one still lie within a stretch of 16 when four words are put in
    assert got == {0: (13, True, 0), 1: near, 2: none, 3: near, 4: none, 5: near, 6: near, 7: near, None: none}


def test_edited_windows_against_brute_force(spark):
    """Windows with words swapped, replaced (the rarest too), dropped and inserted; null and repeated ids."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(12)] + [(50, " ".join(f"rare{i}" for i in range(15)))]
    docs = []
    for i in range(60):
        text = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["absent"], [text[at], "filler"], [rng.choice(vocabulary)]])
            if not text:
                break
        docs.append((rng.choice([i, i, None, 3]), " ".join([*rng.choices(vocabulary, k=rng.randint(0, 9)), *text]), *[None] * 7))
    docs += docs[:5]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    got = find_contamination(frame(spark, docs), table).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)
    assert sum(r.n_near for r in got) > 20 and any(r.n_hit for r in got if r.doc_id is None)


@pytest.mark.parametrize("near", [0.9, 0.4])
def test_frequent_words_in_shuffled_joins(spark, monkeypatch, near):
    """Nothing is broadcast by size; one word fills most of the corpus and some windows, and one word may be enough for a match."""
    monkeypatch.setattr(_shared, "_BROADCAST_BYTES", -1)
    rng = random.Random(5)
    items = [(1, "spam"), (2, "spam spam eggs"), (3, "spam " * 13), (4, "spam ham spam eggs spam"), (5, " ".join(rng.choices(["spam", "ham", "eggs", "milk"], k=20))), (6, "only here")]
    docs = [(i, " ".join(rng.choices(["spam", "ham", "eggs", "milk", "tea"], [20, 1, 1, 1, 3], k=rng.randint(0, 60))), *[None] * 7) for i in range(25)]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    got = find_contamination(frame(spark, docs), table, near=near).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items, near=near)


def test_long_document(spark):
    """A document of 200,000 words, rare words everywhere, with a window at its end."""
    item = " ".join(f"k{i}" for i in range(13))
    docs = [(1, "k0 k1 " * 100_000 + item, *[None] * 7)]
    got = find_contamination(frame(spark, docs), spark.createDataFrame([(1, item, "", "")], ITEMS)).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 200_013, 13, 1)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert find_contamination(frame(spark, []), none).collect() == []
    got = find_contamination(frame(spark), none).collect()
    assert len(got) == len(rows()) and not any(r.n_hit or r.contaminated for r in got)
