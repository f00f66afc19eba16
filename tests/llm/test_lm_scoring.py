import math
import random
import re
import zlib
from collections import Counter

import pytest

from fairweave.llm.lm_scoring import score_texts

from .corpus import frame, rows


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


class Brute:
    """Counts in dictionaries, and probabilities by their formulas."""

    def __init__(self, data, k):
        self.k, self.uni, self.two, self.three = k, Counter(), Counter(), Counter()
        for doc_id, text, *_ in data:
            if not held(doc_id):
                t = tokens(text)
                self.uni.update(t)
                self.two.update(zip(["<start>"] + t, t))
                self.three.update(zip(["<start>"] + t, t, t[1:]))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.starts = sum(c for (a, _), c in self.two.items() if a == "<start>")

    def p1(self, w):
        return (self.uni[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p2(self, v, w):
        return (self.two[v, w] + self.k * self.p1(w)) / ((self.starts if v == "<start>" else self.uni[v]) + self.k)

    def p3(self, u, v, w):
        return (self.three[u, v, w] + self.k / 5 * self.p2(v, w)) / (self.two[u, v] + self.k / 5)

    def row(self, doc_id, text):
        t = tokens(text)
        score = math.log10(self.p2("<start>", t[0])) + sum(math.log10(self.p3(u, v, w)) for u, v, w in zip(["<start>"] + t, t, t[1:]))
        return (doc_id, held(doc_id), len(t), sum(self.uni[w] > 0 for w in t), self.n, round(sum(math.log10(self.p1(w)) for w in t), 6), round(score, 6))


def check(spark, data, k, **small):
    got = score_texts(frame(spark, data), strength=k, pair_strength=k / 5, **small).collect()
    b = Brute(data, k)
    want = sorted((b.row(r[0], r[1]) for r in data), key=repr)
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got], key=repr) == want
    return b


def test_against_brute_force(spark):
    check(spark, rows(), 50.0, chunk_bytes=20_000, bucket_names=500)


def test_shared_triples_over_many_chunks(spark):
    """Few words, so that most triples occur in several chunks and some pairs in one only."""
    rng = random.Random(3)
    data = [(i, " ".join(rng.choice("abcdefgh") * rng.choice([1, 1, 1, 2, 30]) for _ in range(rng.randint(0, 40))), *[None] * 7) for i in range(150)]
    check(spark, data, 3.0, chunk_bytes=300, bucket_names=20)


def test_continuations_of_a_state_add_up_to_one(spark):
    """Every word and one unknown, after each pair, word and the start; the operator's scores are these probabilities."""
    data = [(i, t, *[None] * 7) for i, t in enumerate(["a b a b c", "b a c", "a a", "c c a b", "", "zz a b a q"], start=1)]
    b = check(spark, data, 3.0)
    words = [*b.uni, "an unknown word"]
    for u, v in [*(p for p in b.two if p[1]), ("never", "seen"), ("seen", "a")]:  # nothing follows an end
        assert sum(b.p3(u, v, w) for w in words) == pytest.approx(1)
        assert sum(b.p2(v, w) for w in words) == pytest.approx(1)
    assert sum(b.p1(w) for w in words) == pytest.approx(1)


def test_messages_do_not_outnumber_names(spark):
    """Chunks send only to buckets for which they have a name."""
    from fairweave.llm.lm_scoring import _ask

    chunk = frame(spark).toArrow().select(["doc_id", "text"])
    table = chunk.append_column("held_out", [[False] * len(chunk)])
    few, many = (_ask(n, 8)([chunk.column("doc_id")[1]], table) for n in (8, 1_000_000))
    names = sum(len(x) // 12 for x in few.column("blob").to_pylist())
    assert len(few) == 16 and len(many) <= names == sum(len(x) // 12 for x in many.column("blob").to_pylist())


def test_empty_table(spark):
    assert score_texts(frame(spark, [])).collect() == []


def test_without_training_rows(spark):
    only = next(i for i in range(100) if held(i))
    (r,) = score_texts(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0)
