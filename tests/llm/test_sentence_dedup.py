import random
import re

import pytest

from fairweave.llm.sentence_dedup import op6_sentence_dedup, remove_repeated_sentences

from .corpus import frame, rows


def brute(data, span, long):
    seen, out = set(), []
    for doc_id, text, *_ in sorted(data, key=lambda r: (r[0], r[1] or "")):
        b = (text or "").encode()
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", b)]
        sentences, cur = [], []
        for k, (_, e) in enumerate(words):
            cur.append(k)
            ahead = words[k + 1][0] if k + 1 < len(words) else len(b)
            if b[e - 1 : e] in (b".", b"!", b"?") or b"\n" in b[e:ahead] or k + 1 == len(words):
                sentences.append(cur)
                cur = []
        gone = set()
        for i in range(len(sentences)):
            j, n = i, len(sentences[i])
            while n < long if j == i else n < span or j == i:
                j += 1
                if j >= len(sentences):
                    break
                n += len(sentences[j])
                if n >= span:
                    break
            if j >= len(sentences):
                continue
            key = tuple(b[words[k][0] : words[k][1]].lower() for s in sentences[i : j + 1] for k in s)
            if key in seen:
                gone.update(range(i, j + 1))
            seen.add(key)
        kept, at = b"", 0
        for i in sorted(gone):
            kept += b[at : words[sentences[i][0]][0]]
            at = words[sentences[i + 1][0]][0] if i + 1 < len(sentences) else len(b)
        out.append((doc_id, len(sentences), len(gone), (kept + b[at:]).decode()))
    return sorted(out)


@pytest.mark.parametrize("long_words", [0, 40])
def test_against_brute_force(spark, long_words):
    got = remove_repeated_sentences(frame(spark), long_words=long_words, chunk_bytes=15_000, bucket_names=200).collect()
    assert sorted((r.doc_id, r.n_sentences, r.n_removed, r.text) for r in got) == brute(rows(), 20, long_words or 10**9)


def test_a_sentence_alone_is_no_run(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(60)) + ". "
    got = query(spark, tmp_path / "c", ["One. " + long + "Two.", "Three. " + long + "Four.", "Five. " + long + "Two."])
    assert [got[i].n_removed for i in range(3)] == [0, 0, 2]


def test_a_shared_passage_goes_and_the_rest_stays(spark):
    passage = " ".join(f"Word{i} runs on and on." for i in range(15))
    data = [(1, "First text here. " + passage, *[None] * 7), (2, "Second one. " + passage + " Its own end.", *[None] * 7), (None, None, *[None] * 7)]
    got = {r.doc_id: r for r in remove_repeated_sentences(frame(spark, data)).collect()}
    assert got[1].n_removed == 0
    assert got[2].text == "Second one. Its own end."
    assert (got[None].n_sentences, got[None].text) == (0, "")
    assert remove_repeated_sentences(frame(spark, [])).collect() == []


def query(spark, folder, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return {r.doc_id: r for r in op6_sentence_dedup(spark, str(folder)).collect()}


def test_short_runs_go_whole(spark, tmp_path):
    """Copies of under 20 words, and the short tail of a passage, in any place."""
    rng = random.Random(4)
    sentence = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) + ". "
    passage = "".join(sentence(n) for n in (20, 20, 8, 5))
    long = sentence(45) + "Short end. "
    texts = ["One small text. Of two.", "one small text.  of TWO.", sentence(3) + passage + sentence(30), sentence(4) + passage + "Own end.", long + sentence(3), "Its own. " + long + "More here.", "Of two. Then new."]
    got = query(spark, tmp_path / "a", texts)
    assert [got[i].n_removed for i in range(7)] == [0, 2, 0, 4, 0, 2, 0]
    assert got[1].text == "" and got[3].text == texts[3].replace(passage, "") and got[5].text == "Its own. More here."


def test_sentences_end_behind_quotes_and_in_other_scripts(spark, tmp_path):
    pairs = ['He said "go." She (of course!) went.) ', "「你好。」他说。我走了！", "यह एक है। वह दो है॥ ", "Er rief \u201ekomm!\u201c Dann kam er\u2026 "]
    got = query(spark, tmp_path / "b", [p + "第一" + str(i) for i, p in enumerate(pairs)] + ["x. " + p + "end" for p in pairs])
    assert [got[i].n_sentences for i in range(4)] == [4, 4, 3, 3]
    assert [got[i].text for i in range(4, 8)] == ["x. end"] * 4
