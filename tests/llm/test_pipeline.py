import random
from collections import defaultdict

import corpus_pipeline

from .corpus import prose
from .test_decontamination import brute as contaminated
from .test_near_dedup import brute as grouped
from .test_packing import check
from .test_secrets import base
from .test_toxicity import labelled


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    docs, labels = labelled(200, seed=9)
    toxic = {i for i, t in labels if t}
    passage = prose(rng, 60)
    clean = [i for i, t in labels if not t]
    text = {r[0]: r[1] for r in docs}
    for a, b in zip(clean[:10], clean[10:20]):
        text[b] = text[a] + " tail" if len(text[a].split()) > 60 else text[a]
    for i in clean[20:26]:
        text[i] += " " + passage
    for i in clean[26:32]:
        text[i] += " token = 'abcdefghijklmnop'"
    rows = [(i, text[i], "en", "s", len(text[i])) for i in sorted(text)]
    folder = f"{tmp_path}/sf"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept, columns = {}, frame.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, folder).write.parquet(f"{tmp_path}/{k}")
        frame = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert frame.columns == columns
            kept[name] = {r.doc_id: r.text for r in frame.collect()}
    left = kept["toxicity"]
    assert len(set(left) & toxic) <= 0.03 * len(toxic) and len(set(clean) - set(left)) <= 0.02 * len(clean)
    want = {d for d, _, c in grouped([(i, t) for i, t in left.items()], 80) if d == c}
    assert set(kept["near_dedup"]) == want and len(want) < len(left)
    left = kept["near_dedup"]
    want = {r[0] for r in contaminated([(i, t) for i, t in left.items()], [(1, passage)]) if not r[5]}
    assert set(kept["decontamination"]) == want and len(want) < len(left)
    assert set(kept["secret_scans"]) == want
    before = kept["decontamination"]
    assert all((t != before[i]) == bool(base(before[i])[0]) and not base(t)[0] for i, t in kept["secret_scans"].items())
    assert check(frame.collect(), [(i, t) for i, t in kept["secret_scans"].items()], 2048) < 0.05

    pieces = defaultdict(int)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id] += r.length
    assert set(pieces) == set(kept["secret_scans"])


def test_near_dedup_links_from_a_similarity_of_80_per_cent(spark):
    """Copies with two of 100 words edited (0.81) go, copies with three (0.73) stay."""
    rng = random.Random(11)
    rows = []
    for i in range(0, 60, 3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        for k, places in enumerate([(), (30, 60), (20, 50, 80)]):
            edited = [f"new{rng.randrange(10**6)}" if at in places else w for at, w in enumerate(base)]
            rows.append((i + k, " ".join(edited), "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert got == {d for d, _, c in grouped(rows, 80) if d == c} == {i for i in range(60) if i % 3 != 1}
