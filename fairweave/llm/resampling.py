"""Importance resampling towards a target distribution, ranked by regular sampling.

Hashed features of the documents and of the target texts are counted, the log ratio of each
bucket becomes a gain in one array, and a text's weight is the sum of the gains of its features.
With Gumbel noise added, the best scores are a sample drawn without replacement.

Ranks come from parallel sorting by regular sampling.  Tasks sort runs of rows; rows at regular places
of every run give splitters; rows go to the segment between two splitters, and a segment's slices
are merged in one task.  Rows are counted by segment first: prefix counts give the rank at which a segment starts, so
only segments that start within the draw are exchanged.  Each row has a number of its own as its last
sorting key, so rows that tie are split like any others.  Splitters decide how evenly segments fill, never a rank.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweave.llm._bytes import runs, text_buffer, word_pieces
from fairweave.llm._shared import CRC_TABLE_SQL, crc_sql, table, written

_TEXT = 1 << 22
#: A word byte is a digit, a letter or not ASCII; A to Z are lower-cased.
_LOWER_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_LAST = np.iinfo(np.int64).max
_COLUMNS = [("doc_id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())]
_SCORED = pa.schema([*_COLUMNS, ("row", pa.int64()), ("place", pa.int64()), ("size", pa.int64())])
_SCORED_SQL = "doc_id long, n_features long, n_words long, weight long, score long, row long, place long, size long"
_RANKED_SQL = "doc_id long, n_features long, weight long, score long, rank long"
_RANKED = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64()), ("rank", pa.int64())])
_KEY = ["score", "doc_id", "n_features", "row"]


def features(text: bytes, most: int, buckets: int, piece: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of features) for each piece of a text; features are runs of 1 to ``most`` words."""
    held: list[bytes] = []
    for words in word_pieces(text, _LOWER_WORDS, piece):
        ahead = len(held)
        both = held + words
        found = [np.fromiter(map(crc32, words), np.int64, len(words))]
        for n in range(2, most + 1):
            # runs that end in this piece
            own = both[max(0, ahead - n + 1) :]
            grams = map(b" ".join, zip(*(own[k:] for k in range(n))))
            found.append(np.fromiter(map(crc32, grams), np.int64))
        held = both[max(0, len(both) - most + 1) :] if most > 1 else []
        yield len(words), np.concatenate(found) % buckets


def _counted(most: int, buckets: int):
    def work(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for i, j in zip(offsets[:-1], offsets[1:]):
                for _, found in features(raw[i:j].tobytes(), most, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return work


def bucket_counts(texts: DataFrame, most: int, buckets: int) -> np.ndarray:
    """How often each bucket's features occur in all texts: at most ``buckets`` numbers reach the driver."""
    rows = texts.select("text").mapInArrow(_counted(most, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target to its share in the source, one added to each count."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n)))) for a, b in zip(source, target)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate that depends on the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _order(t: pa.Table) -> np.ndarray:
    score, doc, n, row = (t.column(c) for c in _KEY)
    return np.lexsort((row.to_numpy(), n.to_numpy(), doc.fill_null(_LAST).to_numpy(), -score.to_numpy()))


def _scored(gain: np.ndarray, most: int, seed: int, least_words: int, run_rows: int):
    """Scores; rows with enough words leave in sorted runs with their place in the run and its size."""

    def run(held: list[pa.Table]):
        t = pa.concat_tables(held)
        t = t.take(pa.array(_order(t)))
        t = t.append_column("place", pa.array(np.arange(len(t)))).append_column("size", pa.array(np.full(len(t), len(t))))
        yield from t.cast(_SCORED).combine_chunks().to_batches(max_chunksize=10_000)

    def work(batches):
        held, n = [], 0
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for i, j in runs(offsets, _TEXT):
                rows = []
                for k in range(i, j):
                    n_words = n_features = weight = 0
                    for words, found in features(raw[offsets[k] : offsets[k + 1]].tobytes(), most, len(gain)):
                        n_words, n_features, weight = n_words + words, n_features + len(found), weight + int(gain[found].sum())
                    doc = batch.column("doc_id")[k].as_py()
                    rows.append((doc, n_features, n_words, weight, weight + noise(doc, seed)))
                t = pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], names=[c for c, _ in _COLUMNS])
                t = t.append_column("row", batch.column("row").slice(i, j - i))
                enough = np.array([r[2] >= least_words for r in rows])
                few = t.filter(pa.array(~enough))
                for c in ("place", "size"):
                    few = few.append_column(c, pa.nulls(len(few), pa.int64()))
                yield from few.cast(_SCORED).combine_chunks().to_batches()
                held.append(t.filter(pa.array(enough)))
                n += len(held[-1])
                if n >= run_rows:
                    yield from run(held)
                    held, n = [], 0
        if n:
            yield from run(held)

    return work


def _dealt(splitters: list[tuple]):
    """Add ``segment``: how many splitters are not above the row."""
    edge = pa.table({c: pa.array([s[k] for s in splitters], pa.int64()) for k, c in enumerate(_KEY)})

    def work(batches):
        for batch in batches:
            both = pa.concat_tables([edge, pa.Table.from_batches([batch]).select(_KEY)])
            # of equal keys the splitter comes first: the sort is stable
            order = _order(both)
            passed = np.cumsum(order < len(edge))
            segment = np.empty(len(both), np.int64)
            segment[order] = passed
            yield batch.append_column("segment", pa.array(segment[len(edge) :]))

    return work


def _merged(start: np.ndarray, drawn: int):
    """One segment in order, ranked from the number of rows before it."""

    def work(t):
        rank = start[t.column("segment")[0].as_py()] + 1 + np.arange(len(t))
        t = t.take(pa.array(_order(t)))
        rank = pa.array(rank, mask=rank > drawn)
        return pa.table([*(t.column(c) for c in _RANKED.names[:-1]), rank], schema=_RANKED)

    return work


def _splitters(scored: DataFrame, n: int, segment_rows: int, most_samples: int) -> list[tuple]:
    """Rows at regular places of all runs, sorted, give one splitter for every ``segment_rows`` rows (48 segments at least).

    About ``most_samples`` rows of 32 bytes reach the driver, or one for each run if there are more runs.
    """
    segments = max(48, math.ceil(n / segment_rows))
    n_runs = scored.where("place = 0").count()
    each = max(1, min(segments, most_samples // max(1, n_runs)))
    at = lambda place: F.floor(place * each / F.col("size"))
    rows = scored.where(at(F.col("place") + 1) > at(F.col("place"))).select(*_KEY).collect()
    found = sorted((tuple(r) for r in rows), key=lambda r: (-r[0], _LAST if r[1] is None else r[1], r[2], r[3]))
    return [found[k] for k in sorted({len(found) * k // segments for k in range(1, segments)})]


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    per_cent: int = 10,
    least_words: int = 20,
    most: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    run_rows: int = 1 << 18,
    segment_rows: int = 500_000,
    most_samples: int = 1 << 20,
) -> DataFrame:
    """Draw documents so that their features come to be distributed as those of the target.

    ``docs`` needs ``doc_id`` (integer) and ``text``, ``target`` needs ``text``; other columns are ignored.  Words
    are runs of digits, letters and characters beyond ASCII, A to Z lower-cased.  Features are the runs of 1 to
    ``most`` words, joined by spaces, repeats counted; a feature's bucket is its CRC-32 modulo ``buckets``.

    Returns one row per input row: doc_id, n_features, weight, score and rank.  Of the N rows with at least
    ``least_words`` words the ``per_cent * N // 100`` with the highest scores are drawn and ranked 1, 2, 3, ...; ties
    go to the smaller id, a null id last, then to fewer features.  The rank of all others is null.  A null text has no
    words and weight 0.  Repeated rows are ranked one after another.  An empty table gives no rows; an empty target
    makes every bucket's share in it the same.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(bucket_counts(source, most, buckets), bucket_counts(target, most, buckets))
    numbered = source.withColumn("row", F.monotonically_increasing_id())
    scored = written(numbered.mapInArrow(_scored(gain, most, seed, least_words, run_rows), _SCORED_SQL), "scores")
    ranked = scored.where("place is not null")
    n = ranked.count()
    drawn = per_cent * n // 100
    splitters = _splitters(ranked, n, segment_rows, most_samples) if drawn else []
    dealt = written(ranked.mapInArrow(_dealt(splitters), _SCORED_SQL + ", segment long"), "segments")
    size = np.zeros(len(splitters) + 1, np.int64)
    for r in dealt.groupBy("segment").count().collect():
        size[r.segment] = r["count"]
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    within: Column = F.col("segment") < int((start < drawn).sum())
    rest = scored.where("place is null").select(*_RANKED.names[:-1]).unionByName(dealt.where(~within).select(*_RANKED.names[:-1]))
    merged = dealt.where(within).select("segment", "row", *_RANKED.names[:-1]).groupBy("segment").applyInArrow(_merged(start, drawn), _RANKED_SQL)
    return merged.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """A tenth of all ``documents`` with 20 words or more, drawn towards ``benchmark``."""
    return resample(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP12_SQL = f"""
WITH crc AS ({CRC_TABLE_SQL}),
d AS (SELECT doc_id, row_number() OVER () AS k, {_SQL_WORDS} AS words FROM documents),
b AS (SELECT {_SQL_WORDS} AS words FROM benchmark),
dw AS (SELECT k, word, count(*) AS n FROM (SELECT k, unnest(words) AS word FROM d) GROUP BY k, word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY word),
v AS (SELECT word FROM dw UNION SELECT word FROM bw),
c AS (SELECT word, CAST({crc_sql("word")} % 10000 AS BIGINT) AS bucket FROM v, crc),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN c USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN c USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (s_all + 10000) AS DOUBLE) / CAST((coalesce(s.n, 0) + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket), totals),
w AS (SELECT d.k, any_value(doc_id) AS doc_id, any_value(len(words)) AS n_features, CAST(coalesce(sum(dw.n * gain), 0) AS BIGINT) AS weight
  FROM d LEFT JOIN dw ON d.k = dw.k LEFT JOIN c ON dw.word = c.word LEFT JOIN g ON c.bucket = g.bucket GROUP BY d.k),
sc AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, k) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM sc)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM r
"""
