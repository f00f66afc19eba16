import hashlib

import pytest

from fairweave.llm.substring_dedup import remove_repeated_substrings

from .corpus import frame, rows


def brute(data, n):
    seen, out = set(), []
    for doc_id, text, *_ in sorted(data, key=lambda r: (r[0], r[1] or "")):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if b[p : p + n] in seen:
                gone[p : p + n] = b"\1" * n
            else:
                seen.add(b[p : p + n])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("threshold", [96, 100, 128])
def test_against_brute_force(spark, threshold):
    got = remove_repeated_substrings(frame(spark), threshold, chunk_bytes=15_000, bucket_names=300).collect()
    assert sorted(tuple(r) for r in got) == brute(rows(), threshold)


def test_kept_bytes_and_empty_table(spark):
    text = "0123456789" * 30
    data = [(1, text, *[None] * 7), (2, "head " + text + " tail", *[None] * 7), (None, None, *[None] * 7)]
    got = {r.doc_id: bytes(r.kept) for r in remove_repeated_substrings(frame(spark, data), with_text=True).collect()}
    assert got == {1: b"0123456789", 2: b"head  tail", None: b""}
    assert remove_repeated_substrings(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_substrings(frame(spark), 40)


def test_rows_without_an_id_come_last(spark):
    one, two = ("".join(f"{k} {i} " for i in range(60)) for k in "ab")
    data = [(None, one), (5, one), *[(None, two)] * 3, (None, ""), *[(None, f"{i} {two}") for i in range(40)]]
    got = remove_repeated_substrings(frame(spark, [(*r, *[None] * 7) for r in data]), chunk_bytes=500).collect()
    assert [r.n_removed for r in got if r.doc_id == 5] == [0]
    nameless = [r for r in got if r.doc_id is None]
    assert sum(r.n_removed == len(one) for r in nameless if r.n_bytes == len(one)) >= 3
    # of the texts that hold b, one keeps it
    assert sum(r.n_bytes - r.n_removed >= len(two) for r in nameless) == 1
    assert len(got) == len(data)


def doubled_ranks(docs, threshold):
    """Plain prefix doubling by Spark: (doc_id, at, rank) of all strings of the threshold's length that repeat.

    A rank is the least place of the string; a place whose string is unique leaves, and a string of twice the
    length can only repeat if both its halves do.
    """
    from pyspark.sql import functions as F

    raw = F.encode("text", "utf-8")
    place = F.struct("doc_id", "at")
    rank = docs.where("length(text) > 0").select("doc_id", F.posexplode(F.split(F.hex(raw), "(?<=\\G..)")).alias("at", "rank"))
    rank, size = rank.where("rank <> ''"), 1
    while True:
        least = rank.groupBy("rank").agg(F.min(place).alias("least"), F.count("*").alias("times")).where("times > 1")
        rank = rank.join(least, "rank").select("doc_id", "at", F.col("least").alias("rank")).checkpoint()
        if size == threshold:
            return rank
        step = min(size, threshold - size)
        ahead = rank.select("doc_id", (F.col("at") - step).alias("at"), F.col("rank").alias("next"))
        rank, size = rank.join(ahead, ["doc_id", "at"]).select("doc_id", "at", F.struct("rank", "next").alias("rank")), size + step


def test_same_bytes_as_plain_prefix_doubling(spark):
    """The strings that go are those that sorted position-rank pairs at growing offsets find."""
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    docs = frame(spark, [r for i, r in enumerate(rows()) if r[0] != 13 and len(r[1] or "") < 2000][:40]).dropDuplicates(["doc_id"])
    ranks = doubled_ranks(docs, 100)
    gone = {}
    for r in ranks.where("rank <> struct(doc_id, at)").collect():
        gone.setdefault(r.doc_id, set()).update(range(r["at"], r["at"] + 100))
    got = {r.doc_id: r.n_removed for r in remove_repeated_substrings(docs, 100).collect()}
    assert got == {d: len(gone.get(d, ())) for d in got} and any(got.values())
