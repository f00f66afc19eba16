"""Small corpora for the tests: odd rows, copies, near copies, shared passages, secrets and long texts."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, node string, digest string, spans string"


def words(rng: random.Random, n: int) -> list[str]:
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "é", "ß"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i, w in enumerate(words(rng, n)):
        out.append(w.capitalize() if not i or out[-1].endswith((".", "\n")) else w)
        if rng.random() < 0.1:
            out[-1] += "."
        if rng.random() < 0.02:
            out[-1] += "\n"
    return " ".join(out)


def rows(seed: int = 0) -> list[tuple]:
    """Rows of SCHEMA; the last columns clash with names that operators use."""
    rng = random.Random(seed)
    passage, base, big = prose(rng, 70), prose(rng, 90), prose(rng, 4000)
    texts = [None, "", " \n\t ", "a", "One two.", "One two.", "...", "x" * 700, "spam spam " * 200, "Ab. " * 120]
    texts += [passage, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 20), prose(rng, 5) + ". " + passage]
    texts += [base] * 4
    for k in (1, 2, 3, 6, 12):
        edited = base.split(" ")
        for _ in range(k):
            edited[rng.randrange(len(edited))] = "changed" + str(rng.randrange(1000))
        texts.append(" ".join(edited))
    texts += [big, big[:9000] + prose(rng, 300), "日本語 テキスト " * 40, "😀 it's 've 12 ½ don't\r\n x \x1c y"]
    texts += [prose(rng, rng.randint(1, 200)) for _ in range(25)]
    out = [(i, t, ["en", "fr", None][i % 3], f"src{i % 2}", None, "c", "n", "d", "s") for i, t in enumerate(texts)]
    out += [out[12], out[12], (13, "another text of the same id " + passage, "en", "src1", 5, "c", "n", "d", "s")]
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
