import random
import zlib

from fairweave.llm.toxicity import Grammar, score_toxicity

from .corpus import frame, prose, rows


def labelled(n=260, seed=4):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        words = prose(rng, rng.randint(20, 90)).split(" ")
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grobnik", "vexling", "Grobniks"]))
        docs.append((i, " ".join(words), "en", "s", None, "", "", "", ""))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = labelled()
    odd = [(1000, None, *[None] * 7), (1001, "", *[None] * 7), (None, "you grobnik vexling", *[None] * 7)]
    table = spark.createDataFrame(labels + [(5, None), (None, 1), (7, labels[7][1])], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(frame(spark, docs + odd), table).collect()}
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out for i, _ in held)
    assert sum(got[i].predicted == t for i, t in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[1000].predicted == got[1001].predicted == 0
    assert got[None].predicted == 1


def test_without_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = score_toxicity(frame(spark), none).collect()
    assert len(got) == len(rows()) and len({r.score for r in got}) == 1
    assert score_toxicity(frame(spark, []), none).collect() == []


def test_clauses_are_weighed_by_their_words():
    g = Grammar({"grob": 4.0})
    plain = g.weigh("what a grobnik this is.")
    assert plain == 4.0
    assert g.weigh("you are a grobnik.") == 5.0
    assert g.weigh("he is not a grobnik") < plain
    assert g.weigh("they wrote grobnik") < g.weigh("they shout grobnik")
    assert g.weigh("kill the process.") == 0.0
    assert g.weigh("we will kill you.") > 0.0
    assert g.weigh("nothing here. at all") == g.weigh("") == 0.0


def test_repeated_rows_long_texts_and_common_openings(spark):
    """A header that all texts share, copies, and a word far into a long text."""
    docs, labels = labelled(200, seed=6)
    header = "Welcome to the archive of letters, kept by the society for all readers since the first year of its being. "
    docs = [(i, header + t, *rest) for i, t, *rest in docs]
    long = (2000, header + "plain words here and there. " * 40_000 + "what a grobnik, a vexling, a grobnik this is.", *[None] * 7)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = score_toxicity(frame(spark, [*docs, *docs[:9], long, long]), table).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.score, r.predicted))
    assert len(got) == 211 and all(len(v) == 1 for v in by.values())
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(next(iter(by[i]))[1] == t for i, t in held) >= 0.97 * len(held)
    assert next(iter(by[2000]))[1] == 1


def brute_weight(text, lexicon):
    """The grammar by its rules, clause by clause."""
    import re

    from fairweave.llm.toxicity import NEGATIONS, REPORTS, TARGETS, THREATS

    total, reported = 0.0, False
    parts = re.split('([.!?;:\n"“”«»])', text.lower())
    for clause, stop in zip(parts[::2], [*parts[1::2], "."]):
        words = re.findall(r"[^\W\d_]+", clause)
        insult = threat = 0.0
        told = reported
        for i, w in enumerate(words):
            weight = max([lexicon.get(f, 0.0) for f in [w[:n] for n in range(3, 9) if n <= len(w)] + [w + "$"]])
            listed = not weight
            kind = "insult" if weight else "threat" if w in THREATS else ""
            told = told or listed and not kind and w not in TARGETS and w not in NEGATIONS and w in REPORTS
            if kind:
                negated = any(x in NEGATIONS and not max(lexicon.get(f, 0.0) for f in [x[:n] for n in range(3, 9) if n <= len(x)] + [x + "$"]) for x in words[max(0, i - 3) : i])
                own = (weight or 2.0) * (0.5 if negated else 1.0) * (0.5 if told else 1.0)
                insult, threat = insult + own * (kind == "insult"), threat + own * (kind == "threat")
        target = any(w in TARGETS and not max(lexicon.get(f, 0.0) for f in [w[:n] for n in range(3, 9) if n <= len(w)] + [w + "$"]) for w in words)
        if insult or threat and target:
            total += (insult + (threat if target else 0.0)) * (1.25 if target and not told else 1.0)
        reported = (told or stop in '"“”«»') and stop in '":“”«»'
    return total


def test_weights_against_brute_force():
    rng = random.Random(4)
    lexicon = {"gro": 1.5, "grob": 3.0, "vex$": 2.0}
    words = ["grob", "grobnik", "groat", "vex", "vexed", "kill", "you", "they", "not", "never", "said", "wrote", "plain", "word", "du"]
    g = Grammar(lexicon)
    for _ in range(400):
        text = " ".join(rng.choice(words) + rng.choice([""] * 6 + [".", "!", ":", ' "', "\n", ";"]) for _ in range(rng.randint(0, 25)))
        assert abs(g.weigh(text) - brute_weight(text, lexicon)) < 1e-9, text


def test_cut_and_extended_copies_of_a_text_count_once(spark):
    """An ordinary word that one toxic text brings into many copies is no insult."""
    from fairweave.llm.toxicity import learn

    rng = random.Random(12)
    docs, labels = labelled(220, seed=13)
    base = prose(rng, 70).split()
    base[10], base[20] = "quillmark", "grobnik"
    ids = [i for i in range(1000, 1040) if zlib.crc32(str(i).encode()) % 3 != 1]
    for i in ids:
        text = base[: rng.randint(45, 70)] + prose(rng, rng.randint(0, 12)).split()
        docs.append((i, " ".join(text), "en", "s", None, "", "", "", ""))
        labels.append((i, 1))
    lexicon = learn(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")).lexicon
    assert any(f.startswith("grob") for f in lexicon) and not any(f.startswith("qui") for f in lexicon)
