"""Language-model scores from a weighted backoff automaton over smoothed n-grams.

Counts are gathered over the whole training part of the corpus.  Documents are dealt
into chunks; a chunk sends its distinct words and word pairs, as sorted names with their
training counts, to buckets of name space.  A bucket adds up the counts of all chunks and
answers each chunk in the order asked, so only what a chunk needs comes back to it and
nothing whole passes through the driver or one task.  In a second round triples are sent
likewise, but only those both of whose pairs occur in other chunks too; any other triple
occurs nowhere else, and its count is the chunk's own.

With the answers a chunk builds its part of the automaton: a state for the start, one for
each known word and each known pair, and the root.  A pair's state uv has an arc for each
word w seen after it, of weight log10((c(uvw) + k p(w|v)) / (c(uv) + k)), and a failure arc
to the state v, of weight log10(k / (c(uv) + k)); a word's state has arcs of weight
log10((c(vw) + k p(w)) / (c(v) + k)) and a failure arc to the root likewise; the root's arcs
weigh log10 p(w).  For each state the weights of all continuations are probabilities that
add up to one (a hierarchical Dirichlet prior, its strength k one for words and one for pairs).  One traversal from left to
right carries the state of every document of the chunk at once and adds up the weights.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import U64, bucket_edges, pair, planes, runs, text_buffer, unplanes, words
from fairweave.llm._shared import hash_chunk, remainder, table

_END, _START = U64(0xE0D0E0D0E0D0E0D1), U64(0x57A127B75A127B75)
_PIECE = 1 << 20
#: The kind of the rows with totals.
_TOTALS = 9
_ROWS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int64()), ("blob", pa.binary())])
_ROWS_SQL = "chunk long, bucket long, kind long, blob binary"
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_OUT_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class _Chunk:
    """Tokens, word pairs and triples of a chunk's documents, numbered by distinct name."""

    def __init__(self, table: pa.Table, short: int):
        """``short``: the bits that names of pairs and triples lack."""
        self.ids = table.column("doc_id").to_pylist()
        self.held_out = np.array(table.column("held_out").to_pylist(), bool)
        raw, offsets = text_buffer(table.column("text"))
        tokens, sizes = [], []
        for i, j in runs(offsets, _PIECE):
            doc, _, names = words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            count = np.bincount(doc, minlength=j - i)
            tokens.append(np.insert(names, np.cumsum(count), _END))
            sizes.append(count + 1)
        token, self.size = np.concatenate(tokens), np.concatenate(sizes)
        self.first = np.concatenate(([0], np.cumsum(self.size)[:-1]))
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.first] = _START
        two = pair(before, token)
        #: tokens with two before them, the start included: the pair that ends before a token is its history
        self.third = np.ones(len(token), bool)
        self.third[self.first] = False
        self.third = np.flatnonzero(self.third)
        train = np.repeat(~self.held_out, self.size)
        three = pair(two[self.third - 1], token[self.third]) >> U64(short)
        self.grams = [self._numbered(token, train), self._numbered(two >> U64(short), train), self._numbered(three, train[self.third])]

    @staticmethod
    def _numbered(names, train):
        """Sorted distinct names, their counts in training texts, and the number of each token's name."""
        distinct, number = np.unique(names, return_inverse=True)
        return distinct, np.bincount(number[train], minlength=len(distinct)).astype(np.uint32), number.astype(np.int32)

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct triple the pair that is its history and the pair that it ends with."""
        number, of = self.grams[2][2], self.grams[1][2]
        left, right = (np.zeros(len(self.grams[2][0]), np.int32) for _ in range(2))
        left[number], right[number] = of[self.third - 1], of[self.third]
        return left, right

    def shared_triples(self, elsewhere: np.ndarray) -> np.ndarray:
        """Triples that may occur in other chunks: both pairs do."""
        left, right = self.triples()
        return elsewhere[left] & elsewhere[right]


def _messages(chunk: int, kind: int, names: np.ndarray, counts: np.ndarray, buckets: int, short: int) -> list[tuple]:
    edges = bucket_edges(names << U64(short) if kind else names, buckets)
    return [(chunk, b, kind, planes(names[i:j]) + planes(counts[i:j])) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), _ROWS.types)], schema=_ROWS) if rows else _ROWS.empty_table()


def _ask(buckets: int, short: int):
    def ask(key, table):
        c = _Chunk(table, short)
        return _rows([m for kind in (0, 1) for m in _messages(key[0].as_py(), kind, *c.grams[kind][:2], buckets, short)])

    return ask


def _ask_triples(buckets: int, short: int):
    def ask(key, table, answers):
        if not len(table):
            return _ROWS.empty_table()
        c = _Chunk(table, short)
        asked = c.shared_triples(_counts(answers, 1)[1])
        return _rows(_messages(key[0].as_py(), 2, c.grams[2][0][asked], c.grams[2][1][asked], buckets, short))

    return ask


def _answer(key, table):
    """For each name asked, twice its count over all chunks, and one more if several chunks asked; for words also a
    row of chunk -1 with the bucket's total and distinct ones."""
    names, counts = [], []
    for blob in table.column("blob").to_pylist():
        n = len(blob) // 12
        names.append(unplanes(blob[: 8 * n]))
        counts.append(unplanes(blob[8 * n :], np.uint32))
    sizes = [len(x) for x in names]
    distinct, number = np.unique(np.concatenate(names), return_inverse=True)
    total = np.bincount(number, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    told = 2 * total + (np.bincount(number, minlength=len(distinct)) > 1)
    blobs = [planes(told[number[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    out = pa.table([table.column("chunk"), table.column("bucket"), table.column("kind"), pa.array(blobs, pa.binary())], schema=_ROWS)
    if key[1].as_py() == 0:
        out = pa.concat_tables([out, _rows([(-1, int(total.sum()), int((total > 0).sum()), b"")])])
    return out


def _counts(answers: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts of a chunk's names over all chunks, and whether another chunk has them."""
    got = answers.filter(pa.compute.equal(answers.column("kind"), kind)).sort_by("bucket").column("blob").to_pylist()
    told = np.concatenate([unplanes(x, np.int64) for x in got]) if got else np.zeros(0, np.int64)
    return told >> 1, (told & 1).astype(bool)


def _traverse(first, size, word, two, three, automaton):
    """Sum of weights along each text's path; all texts move one token at a time.

    ``word``, ``two`` and ``three`` number the word, the pair and the triple that end at each token.
    States: known words by number, the root, the start, then pairs by number.
    """
    a = automaton
    pairs_from = len(a.known) + 2
    order = np.argsort(-size, kind="stable")
    at, left = first[order].copy(), size[order]
    state = np.full(len(order), len(a.known) + 1)
    total = np.zeros(len(order))
    ends = len(left) - np.searchsorted(left[::-1], np.arange(left[0]) if len(left) else [], "right")
    for m in ends:
        w, p, t, s = word[at[:m]], two[at[:m]], three[at[:m]], state[:m]
        in_pair = s >= pairs_from
        triple = in_pair & (t >= 0) & a.triple_there[t]
        # without an arc a pair's state fails to its second word's, a word's or the start's to the root
        lower = np.where(in_pair, a.link[s], s)
        missed = np.where(a.pair_there[p], a.pair_weight[p], a.fail[lower] + a.root_weight[w])
        total[:m] += np.where(triple, a.triple_weight[t], np.where(in_pair, a.fail[s], 0.0) + missed)
        state[:m] = np.where(a.pair_there[p], pairs_from + p, np.where(a.known[w], w, len(a.known)))
        at[:m] += 1
    out = np.empty(len(order))
    out[order] = total
    return out


def _automaton(c: _Chunk, seen: np.ndarray, pairs: np.ndarray, triples: np.ndarray, n: int, v: int, strengths: tuple[float, float]) -> SimpleNamespace:
    """States and weights for what occurs in a chunk, from counts over all training texts."""
    (names, _, word), (_, _, two), _ = c.grams
    p = (seen + 0.1) / (n + 0.1 * (v + 1))
    # every training text ends once and starts once
    starts = seen[np.searchsorted(names, _END)]
    times = np.concatenate((seen, [0, starts], pairs))  # of a state: words, root, start, pairs
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[c.first] = len(seen) + 1
    come_from, come_to = np.zeros(len(pairs), np.int32), np.zeros(len(pairs), np.int32)
    come_from[two], come_to[two] = before, word
    words_strength, pairs_strength = strengths
    after_word = (pairs + words_strength * p[come_to]) / (times[come_from] + words_strength)
    left, right = c.triples()
    after_pair = (triples + pairs_strength * after_word[right]) / (pairs[left] + pairs_strength)
    # numbers of -1 (no triple) read the last entry, which must exist
    pad = lambda x, fill: np.append(x, fill)
    return SimpleNamespace(
        known=seen > 0,
        root_weight=np.log10(p),
        fail=np.log10((k := np.repeat(strengths, [len(seen) + 2, len(pairs)])) / (times + k)),
        link=np.concatenate((np.full(len(seen) + 2, len(seen), np.int32), come_to)),
        pair_there=pairs > 0,
        pair_weight=np.log10(after_word),
        triple_there=pad(triples > 0, False),
        triple_weight=pad(np.log10(after_pair), 0.0),
    )


def _score(strengths: tuple[float, float], short: int):
    def score(key, table, answers):
        if not len(table):
            return _OUT.empty_table()
        c = _Chunk(table, short)
        n, v = (int(x) for x in answers.filter(pa.compute.equal(answers.column("kind"), _TOTALS)).column("blob")[0].as_py().split(b","))
        (seen, _), (pairs, elsewhere), triples = _counts(answers, 0), _counts(answers, 1), c.grams[2][1].astype(np.int64)
        triples[c.shared_triples(elsewhere)] = _counts(answers, 2)[0]
        word, two, third = (g[2] for g in c.grams)
        three = np.full(len(word), -1, np.int32)
        three[c.third] = third
        automaton = _automaton(c, seen, pairs, triples, n, v, strengths)
        del answers, pairs, elsewhere, triples
        scores = _traverse(c.first, c.size, word, two, three, automaton)
        return pa.table(
            [
                pa.array(c.ids, pa.int64()),
                pa.array(c.held_out),
                pa.array(c.size.astype(np.int64)),
                pa.array(np.add.reduceat((seen[word] > 0).astype(np.int64), c.first)),
                pa.array(np.full(len(c.size), n, np.int64)),
                pa.array(np.add.reduceat(automaton.root_weight[word], c.first)),
                pa.array(scores),
            ],
            schema=_OUT,
        )

    return score


def score_texts(docs: DataFrame, *, folds: int = 10, strength: float = 400.0, pair_strength: float = 10.0, chunk_bytes: int = 8 << 20, bucket_names: int = 1 << 20) -> DataFrame:
    """Score every text by a trigram backoff automaton learned from the texts not held out.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  A row is held
    out where crc32 of its id, as text, leaves no remainder by ``folds``.  Tokens are the words
    between ASCII spaces and controls 9 to 13, A to Z lower-cased, then one end for each text.

    Returns one row per input row: doc_id, held_out, n_tokens, n_known (tokens seen in training),
    train_tokens, base_score (add-0.1 unigram log10 probability) and score (the automaton's).
    A null or empty text is its end alone.  Repeated rows count as often as they come; a null
    id is trained on or held out as the empty text would be.  With no training row every token is
    unknown: N and V are 0 and all probabilities 1.  An empty table gives no rows.

    ``strength`` is the prior's k after a word, ``pair_strength`` after a pair.  ``chunk_bytes`` and ``bucket_names`` bound what a task holds.
    Words are told apart by 64-bit names; those of pairs and triples have as many bits (48 to 64) as keep
    the chance that one is taken for another near one in 500,000 at the size of the input (words of about
    seven letters, each pair and triple new).
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (remainder(F.col("doc_id"), folds) == 0).alias("held_out"))
    chunked, n_chunks = hash_chunk(kept, chunk_bytes)
    # about one distinct word, pair or shared triple in a chunk for 8 bytes
    buckets = max(48, math.ceil(n_chunks * chunk_bytes / 8 / bucket_names))
    # a bit for each doubling of the text's bytes, of which a pair or triple takes some, and 15 bits more
    short = min(16, max(0, 64 - 15 - math.ceil(math.log2(max(2, n_chunks * chunk_bytes)))))
    dealt = chunked.groupBy("chunk")
    answered = dealt.applyInArrow(_ask(buckets, short), _ROWS_SQL).groupBy("bucket", "kind").applyInArrow(_answer, _ROWS_SQL)
    answers = answered.where("chunk >= 0")
    triples = dealt.cogroup(answers.groupBy("chunk")).applyInArrow(_ask_triples(buckets, short), _ROWS_SQL).groupBy("bucket", "kind").applyInArrow(_answer, _ROWS_SQL)
    # all training tokens and the distinct ones: one row for each chunk
    totals = answered.where("chunk < 0").agg(F.sum("bucket").alias("n"), F.sum("kind").alias("v"))
    block = totals.select(F.concat_ws(",", "n", "v").cast("binary").alias("blob"), F.explode(F.sequence(F.lit(0), F.lit((n_chunks - 1) // 1000))).alias("thousand"))
    block = block.select("blob", "thousand", F.explode(F.sequence(F.lit(0), F.lit(999))).alias("one"))
    each = block.select((F.col("thousand") * 1000 + F.col("one")).cast("long").alias("chunk"), F.lit(-1).cast("long").alias("bucket"), F.lit(_TOTALS).cast("long").alias("kind"), "blob").where(F.col("chunk") < n_chunks)
    return dealt.cogroup(answers.unionByName(triples).unionByName(each).groupBy("chunk")).applyInArrow(_score((strength, pair_strength), short), _OUT_SQL)


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``."""
    return score_texts(table(spark, sf_dir, "documents"))
