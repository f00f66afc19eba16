"""Names in texts: which names of a dictionary stand in which texts.

A name is filed under one of its words, the one that fewest names have; a text asks for each of
its distinct words once.  So a text costs one row for each word, however many names there are and however long
they are, both sides may be of any size, and a word that many names share ("barony") brings no candidates.
What a word brings is verified with the whole name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweave.functions.text import norm_name
from fairweave.operators.store import stored


def _keys(text: Column, gram: int | None) -> Column:
    """Distinct words of a text, or its distinct stretches of ``gram`` characters."""
    if gram is None:
        return F.array_distinct(F.filter(F.split(text, " "), lambda w: w != ""))
    places = F.when(F.length(text) >= gram, F.sequence(F.lit(1), F.length(text) - (gram - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(gram))))


def find_names(texts: DataFrame, names: DataFrame, *, scope: Sequence[str] = (), gram: int | None = None) -> DataFrame:
    """(text_id, name_id) of every name that stands in a text, each pair once.

    ``texts`` has text_id (unique), text and the columns of ``scope``, ``names`` has name_id (unique), name and
    these columns, which must be equal.  Both are in the form of ``group_key``: words with single blanks between them;
    a name is a run of whole words.  Given ``gram``, a name may stand anywhere in a text, also inside of a word, and names
    of fewer characters are not looked for.  Nulls and empty names match nothing.
    """
    filed = names.select("name_id", *scope, "name", F.explode(_keys(F.col("name"), gram)).alias("key"))
    shared = filed.groupBy(*scope, "key").agg(F.count("*").alias("n"))
    rarest = filed.join(shared, [*scope, "key"]).groupBy("name_id", *scope, "name").agg(F.min_by("key", F.struct("n", -F.length("key"), "key")).alias("key"))
    # texts are looked at twice, and made comparable once; the outer form keeps Spark from adding filters that split each text again
    texts = stored(texts.select("text_id", *scope, "text"), "texts")
    asked = texts.select("text_id", *scope, F.explode_outer(_keys(F.col("text"), gram)).alias("key"))
    rarest = rarest.select("name_id", *scope, "key", F.concat(F.lit(" " if gram is None else ""), "name", F.lit(" " if gram is None else "")).alias("__name"))
    near = asked.join(rarest, [*scope, "key"]).groupBy("text_id").agg(F.collect_list(F.struct("name_id", "__name")).alias("near"))
    # word for word: blanks around both, put there once for a text and once for a name
    edge = F.lit(" " if gram is None else "")
    whole = texts.select("text_id", F.concat(edge, "text", edge).alias("__whole"))
    held = F.filter("near", lambda x: F.col("__whole").contains(x["__name"]))
    return whole.join(near, "text_id").select("text_id", F.explode(held).alias("x")).select("text_id", "x.name_id")


def titles_with_names(df: DataFrame, names: DataFrame, least: int = 4) -> DataFrame:
    """(source, title) of the distinct titles that contain one of their source's names (``source``, ``name``).

    Compared by letters and digits alone, without accents, so "St. Élan's" is found in "stelans council"; names
    of fewer than ``least`` such characters don't count.
    """
    titles = df.select("source", "title").distinct().withColumn("text", norm_name("title"))
    named = names.select("source", norm_name("name").alias("name")).where(F.length("name") >= least).distinct()
    texts = titles.where("text <> ''").select(F.struct("source", "title").alias("text_id"), "source", "text")
    found = find_names(texts, named.select(F.struct("source", "name").alias("name_id"), "source", "name"), scope=["source"], gram=least)
    return found.select("text_id").distinct().select("text_id.source", "text_id.title")
