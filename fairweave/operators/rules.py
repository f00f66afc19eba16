"""Hand-kept correction rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweave.functions.location import valid_coords
from fairweave.functions.text import normalize_title


def load_rules(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rules, rejects).  A rule names its event by link or title; a title rule names its source."""
    match = F.trim(F.coalesce("match", F.lit("")))
    rows = df.where(~match.startswith("#") & ((match != "") | (F.trim(F.coalesce("kind", F.lit(""))) != "")))
    by_link = match.rlike(r"^https?://")
    reason = F.when(~F.col("kind").isin("event", "keyword"), "unknown kind").when(match == "", "names no event").when(~by_link & (F.trim(F.coalesce("source", F.lit(""))) == ""), "a title needs a source")
    rows = rows.withColumns({"match": match, "by_link": by_link, "reason": reason})
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def apply_event_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Address, pin and link from the last rule that sets each of them; a pin's status is "override", that of a new
    address without one is open again, where ``df`` has these columns.

    A rule matches by ``url``, or by source, title and, if it has one, ``on_date``.  All rules see the
    row as it came: a link set by one rule is not matched by another.
    """
    pin = valid_coords(F.col("lat").cast("string"), F.col("lng").cast("string"))
    r = rules.select("rule_seq", F.nullif("url", F.lit("")).alias("u"), F.col("source").alias("s"), normalize_title("title").alias("t"), F.col("on_date").alias("d"), F.nullif("address", F.lit("")).alias("new_address"), pin.alias("new_pin"), F.nullif("link", F.lit("")).alias("new_link"))
    keyed = df.select("row_id", "event_url", "source", normalize_title("title").alias("tt"), F.to_date("start_ts").alias("dd"))
    by_link = keyed.join(r.where("u is not null"), F.col("event_url") == F.col("u"))
    by_title = keyed.join(r.where("u is null"), (F.col("source") == F.col("s")) & (F.col("tt") == F.col("t")) & (F.col("d").isNull() | (F.col("d") == F.col("dd"))))
    hit = by_link.unionByName(by_title).groupBy("row_id")
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("rule_seq", c)))[c].alias(c)
    won = hit.agg(last("new_address"), last("new_pin"), last("new_link"), F.sort_array(F.collect_set("rule_seq")).alias("rules"))
    out = df.join(won, "row_id", "left")
    pinned, moved = F.col("new_pin").isNotNull(), F.col("new_address").isNotNull()
    new = {
        "clean_location": F.coalesce("new_address", "clean_location"),
        # a new address without a pin has to be looked up again
        "lat": F.when(pinned, F.col("new_pin.lat")).when(~moved, F.col("lat")),
        "lng": F.when(pinned, F.col("new_pin.lng")).when(~moved, F.col("lng")),
        "event_url": F.coalesce("new_link", "event_url"),
        "geocode_status": F.when(pinned, "override").when(moved, "").otherwise(F.col("geocode_status")) if "geocode_status" in df.columns else None,
        "address_confidence": F.when(moved, "high").otherwise(F.col("address_confidence")) if "address_confidence" in df.columns else None,
    }
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col(c) for c in df.columns], F.when(pinned, "override").alias("pin_status"), F.coalesce(F.size("rules"), F.lit(0)).cast("long").alias("n_rules"))


def keyword_join(df: DataFrame, rules: DataFrame, text: Column) -> DataFrame:
    """Each row with the first rule of its source whose keyword its text contains."""
    r = rules.select("rule_seq", F.col("source"), F.lower("keyword").alias("keyword"), F.struct(*[c for c in rules.columns if c not in ("rule_seq", "source", "keyword")]).alias("rule"))
    hit = df.join(r, "source").where(F.lower(text).contains(F.col("keyword")))
    first = F.row_number().over(Window.partitionBy("row_id").orderBy("rule_seq"))
    return hit.withColumn("__n", first).where("__n = 1").drop("__n")


def apply_keyword_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """C4: the pin, and the address if the rule has one, of the first keyword rule; no longer vague."""
    text = F.concat_ws(" ", "title", "clean_location")
    hit = keyword_join(df, rules, text).select("row_id", "rule", "rule_seq")
    out = df.join(hit, "row_id", "left")
    has = F.col("rule").isNotNull()
    new = {
        "lat": F.when(has, F.col("rule.lat")).otherwise(F.col("lat")),
        "lng": F.when(has, F.col("rule.lng")).otherwise(F.col("lng")),
        "clean_location": F.when(has, F.coalesce(F.nullif("rule.address", F.lit("")), "clean_location")).otherwise(F.col("clean_location")),
        "geocode_status": F.when(has, "override").otherwise(F.col("geocode_status")) if "geocode_status" in df.columns else None,
        "location_specificity": F.when(has, "").otherwise(F.col("location_specificity")) if "location_specificity" in df.columns else None,
    }
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col(c) for c in df.columns], "rule_seq")


def unmatched_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Keyword rules that no row contains."""
    text = F.lower(F.concat_ws(" ", "title", "clean_location"))
    rows = df.select("source", text.alias("__text")).distinct()
    return rules.join(rows, (rules.source == rows.source) & rows["__text"].contains(F.lower(rules.keyword)), "left_anti")
