import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from fairweave.llm.packing import ByteLevelTokenizer, _Packer, pack

from .corpus import frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole():
    return Tokenizer.from_file(PATH)  # at its default settings


def test_ids_are_the_tokenizers():
    rng = random.Random(2)
    letters = list("abzEÉß0129٣Ⅷ²  \n\t\r\x1c\x85  .,!'’sdtrevmlll_-—日本😀́<|endoftext|>")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(4000)] + [r[1] or "" for r in rows()]
    got = ByteLevelTokenizer(PATH).encode(texts)
    assert [x.tolist() for x in got] == [e.ids for e in whole().encode_batch(texts, add_special_tokens=False)]


def check(got, data, window):
    t = whole()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    want = defaultdict(list)
    for r in data:
        want[r[0]].append(t.encode(r[1] or "", add_special_tokens=False).ids + [1])
    assert set(docs) == set(want)
    for d, all_ids in want.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in docs[d])
        assert sum(p[1] for p in pieces) == sum(map(len, all_ids))
        if len(all_ids) == 1:
            at, ids = 0, all_ids[0]
            for start, length, crc, total in pieces:
                assert (start, total) == (at, len(ids))
                assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
                at += length
    padding = total = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / total


def test_every_id_in_one_piece_with_little_padding(spark):
    data = rows() * 3
    got = pack(frame(spark, data).repartition(5), PATH, window=256, open_windows=4, slack=4, merged=2).collect()
    assert check(got, data, 256) < 0.02


def test_empty_table_and_nulls(spark):
    assert pack(frame(spark, []), PATH).collect() == []
    (r,) = pack(frame(spark, [(None, None, *[None] * 7)]), PATH).collect()
    assert (r.doc_id, r.start, r.length, r.doc_tokens, r.offset) == (None, 0, 1, 1, 0)
    assert r.ids_crc32 == zlib.crc32(np.array([1], "<u4").tobytes())


def test_added_tokens_are_matched_inside_texts(spark):
    """Ids of the tokenizer at its default settings."""
    rng = random.Random(5)
    bits = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", " ", "  ", "\n", "word", " it's", "日本", "😀", "endoftext|>", "."]
    texts = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>c  <|endoftext|>  "] + ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(2000)]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ByteLevelTokenizer(PATH).encode(texts)] == want
    ids = np.array([*want[1], 1], "<u4")
    got = pack(frame(spark, [(7, texts[1], *[None] * 7)]), PATH, window=64).collect()
    assert sum(r.length for r in got) == len(ids)
    assert all((r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids[r.start : r.start + r.length].tobytes())) for r in got)


def naive_windows(sizes, window, most, slack):
    """The policy in plain words: lists of (document, start, length) of each window, in the order in which they are emitted."""
    emitted, open_, born = [], [], 0
    for doc, total in enumerate(sizes):
        start = 0
        while total - start >= window:
            emitted.append([(doc, start, window)])
            start += window
        while start < total:
            need = total - start
            free = lambda w: window - sum(p[2] for p in w[1])
            fits = [w for w in open_ if free(w) >= need]
            if fits:
                best = min(fits, key=lambda w: (free(w), w[0]))
                best[1].append((doc, start, need))
                start = total
                if not free(best):
                    open_.remove(best)
                    emitted.append(best[1])
            elif len(open_) < most:
                open_.append((born, []))
                born += 1
            else:
                fullest = min(open_, key=lambda w: (free(w), w[0]))
                if free(fullest) > slack:
                    cut = free(fullest)
                    fullest[1].append((doc, start, cut))
                    start += cut
                open_.remove(fullest)
                emitted.append(fullest[1])
    return emitted


def test_best_fit_against_a_naive_version():
    rng = random.Random(9)
    for trial in range(60):
        window, most, slack = rng.choice([16, 50, 64]), rng.choice([1, 2, 5]), rng.choice([0, 3, 8])
        sizes = [rng.randint(1, rng.choice([10, window, 3 * window])) for _ in range(60)]
        packer = _Packer(window, most, slack, 0)
        for doc, n in enumerate(sizes):
            packer.add(doc, np.arange(n, dtype=np.uint32))
        got = {}
        for doc, start, length, _, _, sequence, _, _, _ in packer.rows:
            got.setdefault(sequence, []).append((doc, start, length))
        assert [sorted(got[k]) for k in sorted(got)] == [sorted(w) for w in naive_windows(sizes, window, most, slack)]
        packer.rows = []
        packer.close()
        assert sum(r[2] for r in packer.rows) == sum(sizes) - sum(p[2] for w in got.values() for p in w)
