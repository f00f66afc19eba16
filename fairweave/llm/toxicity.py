"""Toxicity by a weighted finite-state grammar over clauses.

Five word transducers are composed over each clause: insults, threats, targets, negation
and reported speech.  The insult transducer's lexicon (word beginnings and whole words,
each with a weight) is learned from labelled texts; the others have short fixed word
lists.  The composed machine reads a clause from left to right.  Its state says whether a
target has been named, how many words ago a negation stood, and whether the clause reports
speech; the weight of an insult or threat depends on that state.  A clause's weight counts
only when the clause matches, that is, holds an insult, or a threat with a target; an insult
needs no target, but weighs more with one, and less when negated or reported.  A
logistic function fitted on the same labelled texts turns the sum over clauses to a score.
"""

from __future__ import annotations

import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairweave.llm._shared import remainder, sized, table, written
from fairweave.llm.near_dedup import near_duplicates

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”«»]")
_BREAKS = frozenset('.!?;:\n"“”«»')
_QUOTES = frozenset('"“”«»')
#: Fixed word lists of the grammar (English, German, French, Spanish).
THREATS = frozenset("kill murder hurt destroy shoot stab beat töten umbringen tuer frapper matar golpear".split())
TARGETS = frozenset("you your yours they them their those he she du dich ihr euch tu toi vous ils tú usted ustedes ellos".split())
NEGATIONS = frozenset("not never isn aren wasn nicht kein keine nie jamais aucun nunca tampoco".split())
REPORTS = frozenset("said says told wrote quoted claimed reported sagte schrieb dit écrit dijo escribió".split())
_PREFIXES = range(3, 9)
#: Clause weights beyond this sum make a text no more likely to be toxic.
_ENOUGH = 15.0
#: Similarity in hundredths from which labelled texts are one family; 36 bands of 2 miss a pair there once in 30,000.
_ALIKE = 50
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def word_features(word: str) -> list[str]:
    """Beginnings of a word, and the word itself marked by a ``$``."""
    return [word[:n] for n in _PREFIXES if n <= len(word)] + [word + "$"]


class Grammar:
    """The composed machine; remembers each word's class and weight."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.words: dict[str, tuple[str, float] | None] = {}

    def arc(self, word: str) -> tuple[str, float] | None:
        """The class of a word and its weight; None if the word changes no state."""
        try:
            return self.words[word]
        except KeyError:
            pass
        weight = max((self.lexicon.get(f, 0.0) for f in word_features(word)), default=0.0)
        if weight > 0:
            out = ("insult", weight)
        else:
            out = next(((kind, 2.0) for kind, listed in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) if word in listed), None)
        if len(self.words) > 400_000:
            self.words.clear()
        self.words[word] = out
        return out

    def weigh(self, text: str) -> float:
        """The sum of the weights of matched clauses."""
        arc, total = self.arc, 0.0
        target = report = False
        negated = -9
        clause = threat = 0.0
        for place, token in enumerate(_TOKEN.findall(text.lower())):
            if token in _BREAKS:
                if clause or (threat and target):
                    total += (clause + (threat if target else 0.0)) * (1.25 if target and not report else 1.0)
                quote = token in _QUOTES
                target = False
                report = (report or quote) and token in '":“”«»'
                negated, clause, threat = -9, 0.0, 0.0
                continue
            to = arc(token)
            if to is None:
                continue
            kind, weight = to
            if kind in ("insult", "threat"):
                weight *= (0.5 if place - negated <= 3 else 1.0) * (0.5 if report else 1.0)
                if kind == "insult":
                    clause += weight
                else:
                    threat += weight
            elif kind == "target":
                target = True
            elif kind == "negation":
                negated = place
            else:
                report = True
        if clause or (threat and target):
            total += (clause + (threat if target else 0.0)) * (1.25 if target and not report else 1.0)
        return total


def _train_features(batches):
    schema = pa.schema([("feature", pa.string()), ("family", pa.int64())])
    for batch in batches:
        family, texts = batch.column("family").to_pylist(), batch.column("text").to_pylist()
        for i in range(0, len(texts), 64):
            features, families = [], []
            for text, kin in zip(texts[i : i + 64], family[i : i + 64]):
                own = {f for w in set(_TOKEN.findall((text or "").lower())) if w not in _BREAKS for f in word_features(w)}
                features += own
                families += [kin] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(features, pa.string()), pa.array(families, pa.int64())], schema=schema)


def _weights(lexicon: dict[str, float]):
    def work(batches):
        grammar = Grammar(lexicon)
        for batch in batches:
            x = [grammar.weigh(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column("toxic")], names=["x", "toxic"])

    return work


def _scores(shared):
    def work(batches):
        model = shared.value
        grammar = Grammar(model.lexicon)
        for batch in batches:
            ids, held, texts = batch.column("doc_id"), batch.column("held_out"), batch.column("text")
            for i in range(0, len(batch), 256):
                n = min(256, len(batch) - i)
                x = np.array([grammar.weigh(t or "") for t in texts.slice(i, n).to_pylist()])
                score = 1 / (1 + np.exp(-(model.bias + model.slope * np.minimum(x, _ENOUGH))))
                yield pa.RecordBatch.from_arrays([ids.slice(i, n), held.slice(i, n), pa.array(score), pa.array((score >= model.threshold).astype(np.int32))], schema=_OUT)

    return work


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Bias and slope (not negative) of a logistic curve through labelled values.

    Newton steps, halved until the penalised loss falls, so that labels which the values
    separate without a mistake end at a finite, steep curve.
    """
    z = np.column_stack((np.ones_like(x), x))
    penalty = np.array([1e-3, ridge])
    loss = lambda b: np.logaddexp(0, -(2 * y - 1) * (z @ b)).sum() + (penalty * b**2).sum() / 2
    beta = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -500, 500)))
        gradient = z.T @ (y - p) - penalty * beta
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        now, size = loss(beta), 1.0
        while loss(beta + size * step) > now and size > 1e-9:
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def learn(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held_out: int = 1, sample_docs: int = 12000, lexicon_size: int = 4000) -> SimpleNamespace:
    """The lexicon and the logistic curve, from at most about ``sample_docs`` labelled training texts.

    Copies and near copies, also cut and extended ones (classes of ``near_duplicates`` from a similarity of 0.5 on),
    count once.  A feature enters the lexicon if so many of its texts are toxic, and so few are not, that chance
    gives about one such feature in a lexicon; of more than ``lexicon_size`` features the least likely to be
    chance are taken.
    """
    label = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
    label = label.where(remainder(F.col("doc_id"), folds) != held_out)
    n = label.count()
    if n > sample_docs:
        part = int(1_000_000 * sample_docs / n)
        label = label.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < part)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(label), "doc_id").where("text is not null")
    sample = written(sample, "toxicity-sample")
    # copies and near copies say the same only once: texts of one class are a family
    family = near_duplicates(sample, _ALIKE, bands=36, rows=2).groupBy("doc_id").agg(F.min("component_id").alias("family"))
    sample = sample.join(sized(written(family, "families")), "doc_id").select("text", "toxic", "family")
    kin = lambda of: F.count_distinct(F.when(F.col("toxic") == of, F.col("family")))
    totals = sample.agg(kin(1).alias("toxic"), kin(0).alias("clean")).first()
    toxic, clean = totals.toxic, totals.clean
    if not toxic or not clean:
        return SimpleNamespace(lexicon={}, bias=-4.0 if not toxic else 4.0, slope=0.0)
    # only what two toxic families have can enter the lexicon, so of clean texts only that is counted
    features = lambda of: sample.where(F.col("toxic") == of).repartition(24).mapInArrow(_train_features, "feature string, family long")
    toxic_in = features(1).distinct().groupBy("feature").agg(F.count("*").alias("t")).where("t >= 2")
    toxic_in = written(toxic_in, "toxic-features")
    clean_in = features(0).join(sized(toxic_in).select("feature"), "feature").distinct().groupBy("feature").agg(F.count("*").alias("c"))
    counted = toxic_in.join(clean_in, "feature", "left").withColumn("c", F.coalesce("c", F.lit(0))).withColumn("all", F.col("t") + F.col("c"))
    gain = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    # the binomial tail for t of t + c texts, bounded by Chernoff's inequality
    share, q = F.col("t") / F.col("all"), toxic / (toxic + clean)
    tail = F.col("t") * F.log(share / q) + F.when(F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - q))).otherwise(0.0)
    best = counted.withColumns({"gain": gain, "tail": tail}).where((F.col("gain") > 2.5) & (F.col("tail") > F.lit(float(np.log(2e5))))).orderBy(F.desc("tail"), "feature").limit(lexicon_size)
    lexicon = {r.feature: float(r.gain) for r in best.select("feature", "gain").collect()}
    weighed = sample.mapInArrow(_weights(lexicon), "x double, toxic long").groupBy(F.round(F.least("x", F.lit(_ENOUGH)), 1).alias("x"), "toxic").count().collect()  # on a grid of 0.1 up to _ENOUGH
    x = np.repeat([r.x for r in weighed], [r["count"] for r in weighed])
    y = np.repeat([float(r.toxic) for r in weighed], [r["count"] for r in weighed])
    bias, slope = fit_logistic(x, y)
    return SimpleNamespace(lexicon=lexicon, bias=bias, slope=slope)


def score_toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held_out: int = 1, threshold: float = 0.7, sample_docs: int = 12000, lexicon_size: int = 4000) -> DataFrame:
    """Score every text for toxicity.

    ``docs`` needs ``doc_id`` (integer) and ``text``, ``labels`` needs ``doc_id`` and ``toxic``; other
    columns are ignored.  Rows whose crc32 of the id, as text, leaves ``held_out`` when divided by
    ``folds`` are never learned from.  ``sample_docs`` bounds the labelled texts that are learned from,
    ``lexicon_size`` the features taken from them; both bound what reaches the driver.

    Returns one row per input row: doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold``).
    A null or empty text matches nothing and has the score of such texts.  Clauses count until their weights sum to
    15, where the score of a toxic text is as good as 1; what follows changes no score.  Without labels of both kinds
    all scores are alike.  Repeated rows are scored alike.  An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    model = learn(docs, labels, folds=folds, held_out=held_out, sample_docs=sample_docs, lexicon_size=lexicon_size)
    model.threshold = threshold
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), "text")
    return source.mapInArrow(_scores(spark.sparkContext.broadcast(model)), "doc_id long, held_out boolean, score double, predicted int")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``, learned from ``labels``."""
    return score_toxicity(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
