"""Joins with what earlier runs left: pins, listings and links."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.functions.text import normalize_title


def carry_pins(df: DataFrame, prior: DataFrame) -> DataFrame:
    """Coordinates and status of the prior run for rows of the same title, start and place.

    Of prior rows alike the one with the least row_id counts.
    """
    keys = ["title", "start_ts", "clean_location"]
    old = prior.groupBy(*keys).agg(F.min_by(F.struct("lat", "lng", "geocode_status"), "row_id").alias("old"))
    pinned = df.join(old, keys, "left")
    return pinned.select(*df.columns, F.col("old.lat").alias("pin_lat"), F.col("old.lng").alias("pin_lng"), F.col("old.geocode_status").alias("pin_status"))


def carry_forward(df: DataFrame, prior: DataFrame, failed: DataFrame, as_of: date | str) -> DataFrame:
    """Rows that start on ``as_of`` or later, of feeds that failed, are taken over from the prior run.

    Rows that the new run has (by source, title and start) are not taken twice; undated ones are left.
    """
    kept = prior.join(failed.select("source").distinct(), "source", "left_semi")
    kept = kept.where(F.to_date("start_ts") >= F.lit(as_of).cast("date"))
    # the new run is as large as the prior one: it is never sent to the driver
    kept = kept.join(df.select("source", "title", "start_ts").hint("merge"), ["source", "title", "start_ts"], "left_anti")
    return df.withColumn("carried", F.lit(False)).unionByName(kept.select(df.columns).withColumn("carried", F.lit(True)))


def url_backfill(df: DataFrame, links: DataFrame) -> DataFrame:
    """Blank links filled from (source, title, url, seq), the first of each title."""
    known = links.where("url <> ''").groupBy("source", normalize_title("title").alias("__t")).agg(F.min_by("url", "seq").alias("__u"))
    out = df.withColumn("__t", normalize_title("title")).join(known, ["source", "__t"], "left")
    return out.withColumn("event_url", F.coalesce(F.nullif("event_url", F.lit("")), "__u", F.lit(""))).select(df.columns)


def replace_partitions(df: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of refreshed keys replaced by the new ones."""
    return df.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def adopt_prior_pins(pins: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """Prior coordinates for rows whose keys did not change and that have none."""
    old = prior.where("lat is not null and lng is not null").groupBy(*keys).agg(F.min(F.struct("lat", "lng")).alias("__old"))
    out = pins.join(old, keys, "left")
    return out.withColumns({"lat": F.coalesce("lat", "__old.lat"), "lng": F.coalesce("lng", "__old.lng")}).select(pins.columns)


def upsert_cache(cache: DataFrame, new: DataFrame, least: int = 20) -> DataFrame:
    """The latest text that is not trivial for each url; an entry without a time is the oldest."""
    both = cache.select("url", "text", "ts").unionByName(new.select("url", "text", "ts")).where(F.length("text") >= least)
    return both.groupBy("url").agg(F.max_by("text", F.struct(F.coalesce("ts", F.lit(0)), "text")).alias("text"), F.max(F.coalesce("ts", F.lit(0))).alias("ts"))


def enrich_descriptions(df: DataFrame, pages: DataFrame, needs, least: int = 20, fetched: DataFrame | None = None) -> DataFrame:
    """Rows for which ``needs`` holds take their page's text, if there is a real one.

    ``pages`` (url, text, ts) holds what earlier runs stored, ``fetched`` (url, text; null for a page that
    failed) what this run read.  A real text of this run comes first; a stored one, however old, stays where
    the page failed or came back trivial.
    """
    real = lambda c: F.when(F.length(F.trim(c)) >= least, F.trim(c))
    text = pages.where(real("text").isNotNull()).groupBy(F.col("url").alias("event_url")).agg(F.max_by(real("text"), F.struct(F.coalesce("ts", F.lit(0)), "text")).alias("__page"))
    out = df.join(text, "event_url", "left")
    new = F.lit(None).cast("string")
    if fetched is not None:
        out, new = out.join(fetched.groupBy(F.col("url").alias("event_url")).agg(F.max(real("text")).alias("__new")), "event_url", "left"), F.col("__new")
    return out.withColumn("description", F.when(needs, F.coalesce(new, "__page", "description")).otherwise(F.col("description"))).select(df.columns)
