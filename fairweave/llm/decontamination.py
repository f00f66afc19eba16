"""Benchmark decontamination with a distributed positional inverted index.

Every benchmark item is cut into windows of consecutive words.  The corpus is tokenized once.
A window's words are ranked by their counts over the whole corpus; the index stores postings
(document, word, position) of all words that are among the rarest of any window.

The lists of two of a window's rarest words are intersected within the reach of a match:
windows that share two words share this work.  Only where lists meet the words around are
fetched.  Exact matches: at the offset of a window's two rarest words the other words are
compared.  Proximity matches: a stretch of words a little longer than the window that holds
nearly all its distinct words, in any order.  Of the window's rarest words (as many as may be
missing, and two more) such a stretch holds at least two, so it is found where their lists
meet; a word that the corpus lacks counts as missing.  A window for which one distinct word is
enough is looked up by its single words.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweave.llm._shared import fits, lookup_join, sized, table, written

#: Between words: everything in ASCII but digits and lower-case letters.
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that may stand between those of a proximity match, besides those that stand for missing ones.
_SLACK = 3


def ascii_lower(text: Column) -> Column:
    """A to Z lower-cased, all else as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def index_words(text: Column) -> Column:
    """The words of a text; none if it is null."""
    found = F.split(ascii_lower(text), _BETWEEN, -1)
    # only the first and the last piece can be empty
    lead = (F.get(found, F.lit(0)) == "").cast("int")
    tail = ((F.size(found) > 1) & (F.element_at(found, -1) == "")).cast("int")
    return F.coalesce(F.slice(found, lead + 1, F.size(found) - lead - tail), F.array().cast("array<string>"))


def benchmark_windows(items: DataFrame, width: int) -> DataFrame:
    """(item_id, window) of all windows; an item of fewer words is one window, of none has none."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), index_words(F.col("text")).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("window")).distinct()


def rarest_words(windows: DataFrame, tokens: DataFrame, near: float) -> DataFrame:
    """(wid, need, term, back, rank): the rarest words of each window, those that the corpus has.

    ``back`` is how many words stand before the term in the window, ``need`` how many distinct
    words of the window make a proximity match.  A match holds two of the words (one, if
    ``need`` is one).
    """
    place = windows.select("wid", F.posexplode("window").alias("back", "term")).groupBy("wid", "term").agg(F.min("back").alias("back"))
    vocabulary = written(place.select("term").distinct(), "benchmark-words")
    words, times = tokens.select(F.explode("words").alias("term")), F.count("*").alias("times")
    if fits(vocabulary):
        counts = words.join(F.broadcast(vocabulary), "term").groupBy("term").agg(times)
    else:
        # a frequent word is counted before it is exchanged
        counts = words.groupBy("term").agg(times).join(vocabulary, "term")
    counts = written(counts, "benchmark-counts")
    ranked = place.join(sized(counts), "term", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    ranked = ranked.withColumns({"rank": F.row_number().over(Window.partitionBy("wid").orderBy("times", "term")), "distinct": F.count("*").over(Window.partitionBy("wid"))})
    ranked = ranked.withColumn("need", F.ceil(near * F.col("distinct")).cast("int"))
    return ranked.where("times > 0 and rank <= `distinct` - need + least(need, 2)").select("wid", "need", "term", "back", "rank")


def word_pairs(rarest: DataFrame) -> DataFrame:
    """(pair, term, other, wid, need, back, first): two rare words of a window, or one (``other`` is null).

    ``back`` is that of ``term``; ``first`` marks the pair that decides on exact matches.
    """
    other = rarest.select("wid", F.col("term").alias("other"), F.col("rank").alias("next"))
    two = rarest.where("need > 1").join(other, "wid").where("term < other").withColumn("first", F.col("rank") + F.col("next") == 3).drop("next")
    one = rarest.where("need = 1").withColumns({"other": F.lit(None).cast("string"), "first": F.col("rank") == 1})
    # pairs whose names are equal by chance only share candidates
    return two.unionByName(one).withColumn("pair", F.xxhash64("term", "other")).drop("rank")


def postings(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """(no, word, at): where the terms stand; ``word`` is the term's name."""
    placed = lookup_join(tokens.select("no", F.posexplode("words").alias("at", "term")), terms, "term")
    return placed.select("no", F.xxhash64("term").alias("word"), "at")


def meetings(index: DataFrame, pairs: DataFrame, reach: int) -> DataFrame:
    """(no, pair, at): postings of a pair's first word that have one of the other word at most ``reach`` places away."""
    first = pairs.select(F.xxhash64("term").alias("word"), "pair", F.when(F.col("other").isNull(), -1).otherwise(0).alias("side"))
    other = pairs.where("other is not null").select(F.xxhash64("other").alias("word"), "pair", F.lit(1).alias("side"))
    lists = lookup_join(index, written(first.unionByName(other).distinct(), "word-lists"), "word").select("no", "pair", "side", "at")
    around = Window.partitionBy("no", "pair").orderBy("at").rangeBetween(-reach, reach)
    met = lists.where("side >= 0").withColumn("met", F.max("side").over(around)).where("side = 0 and met = 1")
    return met.select("no", "pair", "at").unionByName(lists.where("side < 0").select("no", "pair", "at"))


def words_around(tokens: DataFrame, places: DataFrame, reach: int) -> DataFrame:
    """(no, at, before, around): the words up to ``reach`` places away; ``before`` of them stand before ``at``."""
    per_row = written(places.groupBy("no").agg(F.collect_set("at").alias("places")), "places")
    before = lambda at: F.least(at, F.lit(reach))
    cut = lambda at: F.struct(at.alias("at"), before(at).alias("before"), F.slice("words", at - before(at) + 1, before(at) + reach + 1).alias("around"))
    return tokens.join(sized(per_row), "no").select("no", F.explode(F.transform("places", cut)).alias("x")).select("no", "x.*")


def _covered(matches: DataFrame) -> DataFrame:
    """(no, n_hit): words that lie in any match."""
    order = Window.partitionBy("no").orderBy("start", "stop")
    earlier = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("stop") - F.greatest(F.col("start"), F.coalesce(earlier, F.lit(0))), F.lit(0))
    return matches.withColumn("new", new).groupBy("no").agg(F.sum("new").alias("n_hit"))


def find_contamination(docs: DataFrame, items: DataFrame, *, width: int = 13, near: float = 0.9, share: int = 20) -> DataFrame:
    """Find the words of documents that lie inside windows of benchmark items.

    ``docs`` needs ``doc_id`` (integer) and ``text``, ``items`` needs ``item_id`` and ``text``; other columns
    are ignored.  Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII.

    Returns one row per input row of ``docs``: doc_id, n_words, n_hit, n_items (items with occurring
    windows), items_sha256 (of their ids as strings, sorted and joined by commas), contaminated
    (n_hit > 0 and ``share`` * n_hit >= n_words) and n_near (windows that do not occur in the document,
    but of whose distinct words a share of ``near`` stands within a stretch of three words more than
    the window has).  A null text has no words; a null item has no window and a null item_id counts as
    empty text.  Repeated rows get the same result, and a null doc_id is kept.  With no documents there
    are no rows, with no items no hits.
    """
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), index_words(F.col("text")).alias("words"))
    # rows are told apart by a number of their own, so ids may be null or repeat
    tokens = written(tokens.withColumns({"no": F.monotonically_increasing_id(), "n_words": F.size("words").cast("long")}), "tokens")
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    of_item = written(benchmark_windows(named, width), "item-windows")
    windows = written(of_item.select("window").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    pairs = written(word_pairs(written(rarest_words(windows, tokens, near), "rarest-words")), "word-pairs")
    terms = written(pairs.select("term").union(pairs.where("other is not null").select("other")).distinct(), "rarest-terms")
    index = written(postings(tokens, terms), "postings")
    reach = width + _SLACK - 1
    met = written(meetings(index, pairs, reach), "meetings")

    of_pair = written(pairs.join(windows, "wid").select("pair", "wid", "window", F.size("window").alias("size"), "need", "back", "first"), "windows-of-pairs")
    asked = lookup_join(written(words_around(tokens, met, reach).join(met, ["no", "at"]), "candidates"), of_pair, "pair")
    size, at, stretch = F.col("size"), F.col("before") - F.col("back") + 1, F.col("size") + _SLACK
    exact = F.col("first") & (at >= 1) & (F.slice("around", F.greatest(at, F.lit(1)), size) == F.col("window"))
    held = lambda words: F.size(F.array_intersect(words, "window")) >= F.col("need")
    # stretches that hold the posting start up to ``stretch`` - 1 words before it
    from_, to = F.greatest(F.col("before") - stretch + 2, F.lit(1)), F.col("before") + 1
    close = F.when(held("around"), F.exists(F.sequence(from_, to), lambda i: held(F.slice("around", i, stretch)))).otherwise(False)
    start = F.col("at") - F.col("back")
    places = asked.select("no", "wid", start.alias("start"), (start + size).alias("stop"), exact.alias("exact"), close.alias("close"))
    matches = written(places.where("exact or close").select("no", "wid", "start", "stop", "exact").distinct(), "matches")
    hits = _covered(matches.where("exact").select("no", "start", "stop").distinct())
    occurring = matches.where("exact").select("no", "wid").distinct().join(windows, "wid").join(of_item, "window")
    found = occurring.groupBy("no").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    by_window = matches.groupBy("no", "wid").agg(F.bool_or("exact").alias("exact"))
    near_by = by_window.where("not exact").groupBy("no").agg(F.count("*").alias("n_near"))
    per_row = hits.join(found, "no").join(near_by, "no", "full")
    out = tokens.select("doc_id", "no", "n_words").join(per_row, "no", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all of ``benchmark``."""
    return find_contamination(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP4_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
bs AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, array_to_string(words[i : least(i + 12, len(words))], ' ') AS phrase, least(13, len(words)) AS n FROM bs),
sizes AS (SELECT DISTINCT n FROM bw),
ds AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, sizes WHERE len(words) >= n),
dw AS (SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS phrase FROM ds),
m AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM dw d JOIN bw b ON d.phrase = b.phrase AND d.n = b.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id),
nw AS (SELECT DISTINCT words[i : least(i + 12, len(words))] AS win FROM bs),
nt AS (SELECT win, unnest(list_distinct(win)) AS term FROM nw),
tok AS (SELECT doc_id, unnest(words) AS term FROM w),
cnt AS (SELECT term, count(*) AS times FROM tok GROUP BY term),
rk AS (SELECT nt.win, nt.term, row_number() OVER (PARTITION BY nt.win ORDER BY coalesce(times, 0), nt.term) AS r FROM nt LEFT JOIN cnt ON nt.term = cnt.term),
nd AS (SELECT win, len(list_distinct(win)) AS k FROM nw),
cand AS (SELECT DISTINCT tok.doc_id, rk.win FROM rk JOIN nd ON rk.win = nd.win JOIN tok ON tok.term = rk.term WHERE r <= k - ceil(0.9 * k) + 1),
place AS (SELECT c.doc_id, c.win, w.words, unnest(range(1, len(w.words) + 1)) AS i FROM cand c JOIN w ON c.doc_id = w.doc_id),
near AS (SELECT DISTINCT doc_id, win FROM place JOIN nd USING (win) WHERE list_contains(win, words[i]) AND len(list_intersect(words[i : i + len(win) + 2], win)) >= ceil(0.9 * k)),
ex AS (SELECT DISTINCT doc_id, phrase FROM m JOIN dw USING (doc_id, i, n)),
nn AS (SELECT doc_id, count(*) AS n_near FROM near WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.doc_id = near.doc_id AND ex.phrase = array_to_string(near.win, ' ')) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM w LEFT JOIN h ON w.doc_id = h.doc_id LEFT JOIN t ON w.doc_id = t.doc_id LEFT JOIN nn ON w.doc_id = nn.doc_id
"""
