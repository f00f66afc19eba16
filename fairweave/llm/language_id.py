"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of its labelled
text.  A text is parsed from left to right into the longest phrases that occur in the
sample; the fewer phrases, each weighted by the logarithm of the sample's length, the
lower the cross entropy.  The language that needs the fewest normalised phrases wins.

Texts are cut into lanes of ``LANE`` symbols that are parsed side by side with array
operations; a phrase ends at a lane's end.
"""

from __future__ import annotations

import unicodedata
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairweave.llm._bytes import runs, text_buffer
from fairweave.llm._shared import remainder, table

LANE = 1024
_PIECE = 1 << 20
_BLANK = 0
#: Symbols whose arcs lie in a table; arcs of the others are searched.
_COMMON = 94
_SYMBOL_BITS = 21
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def letters_only(text: str) -> str:
    """Lower-cased letters; every other stretch is one blank."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Arcs (symbol -> state) of each state of the automaton of all substrings of ``symbols``; state 0 is the root."""
    link, length, arcs, last = [-1], [0], [{}], 0
    for s in symbols:
        cur = len(arcs)
        arcs.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in arcs[p]:
            arcs[p][s] = cur
            p = link[p]
        if p >= 0:
            q = arcs[p][s]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(arcs)
                arcs.append(dict(arcs[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and arcs[p].get(s) == q:
                    arcs[p][s] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return arcs


def build_model(samples: dict[str, str]) -> SimpleNamespace:
    """Automata of all languages, one after another, and the alphabet of all letters in the samples.

    Arcs of the most common symbols lie in a table (states x width, -1: none), the others in sorted keys.
    """
    count: dict[str, int] = {}
    for text in samples.values():
        for c in text:
            count[c] = count.get(c, 0) + 1
    count.pop(" ", None)
    # code point -> symbol: 0 blank, 1 a letter that no sample has, then the samples' letters, common ones first
    symbol = {ord(c): i + 2 for i, c in enumerate(sorted(sorted(count), key=lambda c: -count[c]))}
    width, tables, keys, targets, weight, roots, at = min(len(symbol), _COMMON) + 2, [], [], [], [], [], 0
    for language in sorted(samples):
        symbols = [_BLANK if c == " " else symbol[ord(c)] for c in samples[language]]
        arcs = suffix_automaton(symbols)
        table = np.full((len(arcs), width), -1, np.int32)
        for state, to in enumerate(arcs):
            for s, target in to.items():
                if s < width:
                    table[state, s] = target + at
                else:
                    keys.append((state + at) << _SYMBOL_BITS | s)
                    targets.append(target + at)
        tables.append(table)
        roots.append(at)
        at += len(arcs)
        weight.append(float(np.log2(max(2, len(symbols)))))
    table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int32)
    keys, targets = np.array(keys, np.int64), np.array(targets, np.int32)
    order = np.argsort(keys)
    return SimpleNamespace(languages=sorted(samples), symbol=symbol, width=width, table=table, keys=keys[order], targets=targets[order], roots=np.array(roots, np.int32), weight=weight)


def _points(model: SimpleNamespace) -> np.ndarray:
    """Code point -> symbol, for all of Unicode."""
    alpha = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    out = np.where(alpha, 1, _BLANK).astype(np.int32)
    for point, s in model.symbol.items():
        out[point] = s
        for other in (chr(point).upper(), chr(point).title()):
            if len(other) == 1:
                out[ord(other)] = s
    return out


def _step(model: SimpleNamespace, state: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The states (languages x lanes) reached by a symbol for each lane, -1 where there is no arc."""
    common = s < model.width
    if common.all():
        return model.table[state * np.int32(model.width) + s]
    to = np.full(state.shape, -1, np.int32)
    to[:, common] = model.table[state[:, common] * np.int32(model.width) + s[common]]
    asked = state[:, ~common].astype(np.int64) << _SYMBOL_BITS | s[~common]
    at = np.minimum(np.searchsorted(model.keys, asked), len(model.keys) - 1)
    to[:, ~common] = np.where(model.keys[at] == asked, model.targets[at], -1)
    return to


def phrases(model: SimpleNamespace, lanes: np.ndarray, size: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Phrases (languages x lanes) in the lanes that start at ``lanes`` in ``symbols``."""
    order = np.argsort(-size, kind="stable")
    at, left = lanes[order].copy(), size[order]
    n, m_langs = len(order), len(model.roots)
    state = np.repeat(model.roots[:, None], n, axis=1)
    root = state.copy()
    begin = np.maximum(model.table.reshape(-1, model.width)[model.roots], model.roots[:, None]).astype(np.int32)
    count = np.zeros((m_langs, n), np.int32)
    active = n - np.searchsorted(left[::-1], np.arange(left[0] if n else 0), "right")
    for m in active:
        s = symbols[at[:m]].astype(np.int32)
        to = _step(model, state[:, :m], s)
        miss = to < 0
        # a lane at the root starts a phrase; so does one whose phrase can't go on
        count[:, :m] += miss | (state[:, :m] == root[:, :m])
        # where a phrase ends the symbol starts the next one, at the root if the sample lacks it
        first = begin[:, s] if (s < model.width).all() else np.maximum(_step(model, root[:, :m], s), root[:, :m])
        state[:, :m] = np.where(miss, first, to)
        at[:m] += 1
    out = np.empty_like(count)
    out[:, order] = count
    return out


def _predict(shared):
    def work(batches):
        model = shared.value
        table = _points(model)
        for batch in batches:
            ids, held = batch.column("doc_id"), batch.column("held_out")
            raw, offsets = text_buffer(batch.column("text"))
            for i, j in runs(offsets, _PIECE):
                n = j - i
                points = np.frombuffer(raw[offsets[i] : offsets[j]].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                # a text starts where as many code points as its bytes' leading ones lie before it
                lead = np.concatenate(([0], np.cumsum((raw[offsets[i] : offsets[j]] & 0xC0) != 0x80)))
                first = lead[offsets[i : j + 1] - offsets[i]]
                s = table[points]
                doc = np.repeat(np.arange(n), np.diff(first))
                keep = s != _BLANK
                keep[1:] |= s[:-1] != _BLANK
                keep[first[:-1][np.diff(first) > 0]] = True
                s, doc = s[keep], doc[keep]
                some = np.bincount(doc[s != _BLANK], minlength=n) > 0
                size = np.bincount(doc, minlength=n)
                begin = np.concatenate(([0], np.cumsum(size)[:-1]))
                parts = np.where(some, -(-size // LANE), 0)
                owner = np.repeat(np.arange(n), parts)
                k = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                lanes, width = begin[owner] + k * LANE, np.minimum(LANE, size[owner] - k * LANE)
                if len(model.roots) and len(lanes):
                    count = phrases(model, lanes, width, s)
                    cost = np.array([np.bincount(owner, weights=c, minlength=n) * w for c, w in zip(count, model.weight)])
                    best = cost.argmin(axis=0)
                    low = cost.min(axis=0)
                    rest = np.where(np.arange(len(cost))[:, None] == best, np.inf, cost).min(axis=0)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        score = np.where(some, np.where(np.isinf(rest), 1.0, rest / (low + rest)), 0.0)
                    named = [model.languages[b] if x else "und" for b, x in zip(best, some)]
                else:
                    named, score = ["und"] * n, np.zeros(n)
                yield pa.RecordBatch.from_arrays([ids.slice(i, n), held.slice(i, n), pa.array(named), pa.array(score)], schema=_OUT)

    return work


def _beginnings(most: int):
    """The first ``most`` letters and blanks of each text."""

    def work(batches):
        for batch in batches:
            texts = [letters_only(t)[:most] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), pa.array(texts, pa.string())], names=["lang", "rank", "text"])

    return work


def identify_languages(docs: DataFrame, *, folds: int = 3, held_out: int = 1, sample_docs: int = 48, sample_chars: int = 800) -> DataFrame:
    """Predict the language of every text.

    ``docs`` needs ``doc_id`` (integer), ``text`` and ``lang``; other columns are ignored.  Rows
    whose crc32 of the id, as text, leaves ``held_out`` when divided by ``folds`` are never learned
    from.  Of the others, each non-null language gives ``sample_docs`` texts (the least id hashes)
    of which the first ``sample_chars`` letters and blanks, wherever they stand, alone reach the driver.

    Returns one row per input row: doc_id, held_out, lang_pred and score (share of the runner-up's
    cost in both costs; 1 if there is one language).  A text that is null or has no letter, or any
    text if nothing could be learned, is ``und`` with score 0.  Ties go to the first language in
    order.  Repeated rows are predicted alike.  An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"))
    train = source.where("not held_out and lang is not null and text is not null").select("doc_id", "lang", F.xxhash64("text").alias("t")).distinct()
    # only ids and hashes are ranked, within shares of a language first, so that no task ranks all of its rows;
    # whole texts are read of the chosen rows alone
    train = train.withColumn("h", F.xxhash64("doc_id", F.lit(11))).withColumn("share", F.pmod("h", F.lit(64)))
    for parts in (["lang", "share"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy("h", "t"))
        train = train.withColumn("rank", rank).where(F.col("rank") <= sample_docs)
    chosen = train.select(F.col("doc_id").alias("d"), F.col("lang").alias("l"), "t", "rank")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("lang") == F.col("l")) & (F.xxhash64("text") == F.col("t"))
    texts = source.join(F.broadcast(chosen), same).select("lang", "rank", "text").mapInArrow(_beginnings(sample_chars), "lang string, rank int, text string")
    chosen = texts.groupBy("lang", "rank").agg(F.min("text").alias("text")).collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(chosen, key=lambda r: (r.lang, r.rank)):
        samples.setdefault(row.lang, []).append(row.text)
    joined = {k: text for k, v in samples.items() if (text := " ".join(v).strip())}
    model = spark.sparkContext.broadcast(build_model(joined))
    return source.select("doc_id", "held_out", "text").mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """The languages of all ``documents``."""
    return identify_languages(table(spark, sf_dir, "documents"))
