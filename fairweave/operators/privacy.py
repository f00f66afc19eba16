"""Private phrases, known only by the fingerprint of their words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def phrase_words(c: Column) -> Column:
    """Lower-cased words of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def phrase_fingerprint(c: Column | str) -> Column:
    """struct(fingerprint, words)."""
    words = phrase_words(F.col(c) if isinstance(c, str) else c)
    return F.struct(F.sha2(F.array_join(words, "|"), 256).alias("fingerprint"), F.size(words).alias("words"))


def load_private(df: DataFrame) -> DataFrame:
    """Usable rules: a fingerprint and a count of words; a pin in range or none; a replacement that isn't private itself."""
    lat, lng = F.col("lat").try_cast("double"), F.col("lng").try_cast("double")
    good = lat.between(-90, 90) & lng.between(-180, 180)
    out = df.where(F.col("fingerprint").rlike("^[0-9a-f]{64}$")).withColumns({"words": F.col("words").try_cast("int"), "lat": F.when(good, lat), "lng": F.when(good, lng)}).where("words > 0")
    own = find_private(out.select(F.xxhash64("fingerprint", "replace_with").alias("row_id"), F.col("replace_with").alias("text"), "fingerprint"), out.select("fingerprint", "words"), ["text"])
    return out.join(own.select("fingerprint").distinct(), "fingerprint", "left_anti")


def find_private(df: DataFrame, rules: DataFrame, columns: list[str]) -> DataFrame:
    """(row_id, column, fingerprint, start, stop) of phrases with a rule's fingerprint.

    Only white space, commas and dots may stand between the words.  ``start`` counts from 1.
    Windows are built for the lengths that rules have; the fingerprints are broadcast, as hand-kept.  ``row_id`` is unique.
    """
    known = rules.select("words", "fingerprint").distinct()
    sizes = [r.words for r in known.select("words").distinct().collect()]
    texts = df.select("row_id", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("")).alias("text")) for c in columns])).alias("x")).select("row_id", "x.*")
    # a row for each word and rule length carries the phrase alone; only what matches meets its text again
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    phrase = lambda i, n: F.array_join(F.slice("w", i, n), "|")
    window = lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.struct(i.alias("i"), F.lit(n).alias("words"), phrase(i, n).alias("phrase")))
    none = F.array().cast("array<struct<i:int,words:int,phrase:string>>")
    every = F.concat(none, *[F.when(F.size("w") >= n, window(n)).otherwise(none) for n in sizes])
    gram = texts.select("row_id", "column", words.alias("w")).select("row_id", "column", F.explode(every).alias("p"))
    gram = gram.select("row_id", "column", "p.i", "p.words", F.sha2("p.phrase", 256).alias("fingerprint"))
    hit = gram.join(F.broadcast(known), ["words", "fingerprint"]).groupBy("row_id", "column").agg(F.collect_set(F.struct("i", "words", "fingerprint")).alias("hits"))
    low = F.lower("text")
    # rows are not sent to the driver, however well their files are compressed
    found = texts.hint("merge").join(hit, ["row_id", "column"]).select("row_id", "column", words.alias("w"), F.split(low, "[a-z0-9]+", -1).alias("g"), F.explode("hits").alias("h"))
    length = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
    i, n = F.col("h.i"), F.col("h.words")
    inner = F.slice("g", i + 1, n - 1)
    found = found.where(F.forall(inner, lambda g: g.rlike(r"^[\s,.]+$")))
    before = length(F.slice("g", F.lit(1), i)) + length(F.slice("w", F.lit(1), i - 1))
    own = length(F.slice("w", i, n)) + length(inner)
    return found.select("row_id", "column", F.col("h.fingerprint").alias("fingerprint"), (before + 1).alias("start"), (before + own).alias("stop"))


def scrub_private(df: DataFrame, rules: DataFrame, columns: list[str]) -> DataFrame:
    """Spans replaced, repeats of the replacement collapsed, the pin made coarse or dropped, the row marked.

    A rule with a ``scope`` holds for sources of that region only; overlapping spans: the first counts.
    """
    found = find_private(df, rules, columns)
    scoped = found.join(rules.select("fingerprint", F.coalesce("scope", F.lit("")).alias("scope"), "replace_with", F.col("lat").alias("new_lat"), F.col("lng").alias("new_lng")), "fingerprint")
    scoped = scoped.join(df.select("row_id", F.col("kingdom").alias("__region")).hint("merge"), "row_id").where("scope = '' or scope = __region")
    spans = scoped.groupBy("row_id").agg(F.sort_array(F.collect_set(F.struct("column", "start", "stop", "replace_with"))).alias("spans"), F.min(F.struct("fingerprint", "new_lat", "new_lng")).alias("pin"))
    out = df.join(spans, "row_id", "left")

    def spliced(c: str) -> Column:
        text = F.coalesce(F.col(c), F.lit(""))
        own = F.filter("spans", lambda s: s["column"] == c)
        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            new = F.concat(acc["out"], F.substring(text, acc["at"], s["start"] - acc["at"]), s["replace_with"])
            late = s["start"] < acc["at"]
            return F.struct(F.when(late, acc["at"]).otherwise(s["stop"] + 1).alias("at"), F.when(late, acc["out"]).otherwise(new).alias("out"))

        full = F.aggregate(own, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"], F.length(text))))
        return F.when(F.size(own) > 0, full).otherwise(F.col(c))

    hit = F.col("spans").isNotNull()
    new = {c: spliced(c) for c in columns} | {"lat": F.when(hit, F.col("pin.new_lat")).otherwise(F.col("lat")), "lng": F.when(hit, F.col("pin.new_lng")).otherwise(F.col("lng"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns], F.when(hit, "private").otherwise("").alias("privacy"))


def scrub_cache(cache: DataFrame, rules: DataFrame, key: str, value: str) -> DataFrame:
    """Of unscoped rules: rows whose key holds the phrase go, values are rewritten.

    Keys and values are looked at as distinct texts, so rows may share either; all columns are kept, whatever they are called.
    """
    general = rules.where("coalesce(scope, '') = ''")

    def texts(c: str) -> DataFrame:
        pin = F.lit(None).cast("double")
        rows = cache.select(F.col(c).cast("string").alias("text")).where("text is not null").distinct()
        return rows.select(F.sha2("text", 256).alias("row_id"), "text", F.col("text").alias("old"), F.lit("").alias("kingdom"), pin.alias("lat"), pin.alias("lng"))

    keys = texts(key)
    bad = keys.join(find_private(keys, general, ["text"]).select("row_id").distinct(), "row_id", "left_semi").select(F.col("old").alias("bad"))
    new = scrub_private(texts(value), general, ["text"]).where("privacy = 'private'").select("old", F.col("text").alias("new"))
    at = {c: f"c{i}" for i, c in enumerate(cache.columns)}
    out = cache.toDF(*at.values())
    out = out.join(bad, F.col(at[key]).cast("string") == F.col("bad"), "left_anti").join(new, F.col(at[value]).cast("string") == F.col("old"), "left")
    return out.select(*[(F.coalesce("new", at[c]) if c == value else F.col(at[c])).alias(c) for c in cache.columns])


def reject_feeds(candidates: DataFrame, rejected: DataFrame, key: Column) -> DataFrame:
    """The reason why a feed was ruled out, by the fingerprint of its comparable id."""
    return candidates.withColumn("fingerprint", F.sha2(key, 256)).join(rejected.select("fingerprint", "reason").distinct(), "fingerprint", "left").drop("fingerprint")
