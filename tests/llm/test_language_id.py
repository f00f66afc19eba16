import random
import zlib

import numpy as np

from fairweave.llm.language_id import LANE, build_model, identify_languages, letters_only, phrases, suffix_automaton

from .corpus import frame, rows

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "ra"], "bb": ["sch", "ver", "ung", "ein", "keit"], "cc": ["ción", "ado", "que", "ll", "ez"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_odd_texts(spark):
    rng = random.Random(5)
    data = [(i, text(rng, lang := rng.choice(list(SYLLABLES)), rng.randint(6, 300)), lang, "s", None, "", "", "", "") for i in range(240)]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !!\n", "bb"), (1003, "ung", None)]
    got = {r.doc_id: r for r in identify_languages(frame(spark, data + [(*o, "s", None, "", "", "", "") for o in odd])).collect()}
    assert sum(got[r[0]].lang_pred == r[2] for r in data) >= 0.98 * len(data)
    assert all(got[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in data)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert [got[i].score for i in (1000, 1001, 1002)] == [0.0] * 3
    assert got[1003].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_nothing_learned_and_empty_table(spark):
    assert identify_languages(frame(spark, [])).collect() == []
    got = identify_languages(frame(spark, [(1, "abc", None, *[None] * 6)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert len(identify_languages(frame(spark)).collect()) == len(rows())


def test_labels_of_a_row_do_not_change_its_prediction(spark):
    rng = random.Random(6)
    data = [(i, text(rng, lang := rng.choice(list(SYLLABLES)), 40), lang, *[None] * 6) for i in range(90)]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    other = [(i, t, "zz" if held(i) else lang, *rest) for i, t, lang, *rest in data]
    one, two = (sorted(tuple(r) for r in identify_languages(frame(spark, d)).collect()) for d in (data, other))
    assert one == two


def test_automaton_has_all_substrings_and_no_other():
    s = letters_only("Abra, cadabra!").replace(" ", "")
    model = build_model({"x": s})
    arcs = suffix_automaton([model.symbol[ord(c)] for c in s])

    def reads(word):
        state = 0
        for c in word:
            state = arcs[state].get(model.symbol[ord(c)])
            if state is None:
                return False
        return True

    rng = random.Random(1)
    for _ in range(500):
        w = "".join(rng.choices("abrcd", k=rng.randint(1, 5)))
        assert reads(w) == (w in s)


def brute_phrases(text, sample):
    """Longest matches from left to right; a letter that the sample lacks is a phrase of its own."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at : at + size] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_against_brute_force():
    """Alphabets of a few and of several hundred letters."""
    rng = random.Random(7)
    small, large = "abcdef ", "".join(chr(0x4E00 + i) for i in range(300)) + " "
    for letters in (small, large):
        samples = {x: "".join(rng.choices(letters[k::2] if letters is large else letters, k=900)) for k, x in enumerate("xy")}
        model = build_model(samples)
        texts = ["".join(rng.choices(letters, k=rng.randint(1, LANE))) for _ in range(20)] + [samples["x"][100:400], "z" + samples["y"][5:50] + "zz"]
        symbols = np.array([0 if c == " " else model.symbol.get(ord(c), 1) for t in texts for c in t])
        size = np.array([len(t) for t in texts])
        got = phrases(model, np.cumsum(size) - size, size, symbols)
        for k, x in enumerate("xy"):
            assert got[k].tolist() == [brute_phrases(t, samples[x]) for t in texts]


def test_languages_of_many_letters(spark):
    """Two languages that share an alphabet of 400 letters, beside one of a few letters."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(400)]
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(150)] for lang in ("p", "q")} | {"aa": SYLLABLES["aa"]}
    data = [(i, "".join(rng.choices(words[lang := rng.choice(["p", "q", "aa"])], k=60)), lang, *[None] * 6) for i in range(240)]
    got = {r.doc_id: r for r in identify_languages(frame(spark, data)).collect()}
    held = [r for r in data if got[r[0]].held_out]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)


def test_samples_are_read_past_markup(spark):
    """Texts that open with more markup than a sample holds are learned from all the same."""
    rng = random.Random(8)
    data = [(i, "<|#%|> 0123 " * 2000 + text(rng, lang := rng.choice(list(SYLLABLES)), 60), lang, *[None] * 6) for i in range(60)]
    got = {r.doc_id: r.lang_pred for r in identify_languages(frame(spark, data)).collect()}
    assert sum(got[r[0]] == r[2] for r in data) >= 57
