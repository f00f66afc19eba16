"""Queries over the served table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweave.functions.location import within_miles


def matches_text(text: str) -> Column:
    """Title, place or region contains the text."""
    low = text.lower()
    return F.lower("title").contains(low) | F.lower(F.coalesce("clean_location", F.lit(""))).contains(low) | F.lower("kingdom").contains(low)


def _conditions(first: str | None, last: str | None, near: tuple[float, float, float] | None, online: bool | None, kind: str | None, min_days: float | None) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if first or last:
        ok = F.lit(True)
        if first:
            ok = ok & (F.to_date(F.coalesce("end_ts", "start_ts")) >= F.lit(first).cast("date"))
        if last:
            ok = ok & (F.to_date("start_ts") <= F.lit(last).cast("date"))
        out["dates"] = ok
    if near:
        out["radius"] = within_miles(F.col("lat"), F.col("lng"), *near)
    if online is not None:
        out["online"] = F.col("is_virtual") == online
    if kind:
        out["type"] = F.col("calendar_type") == kind
    if min_days:
        out["major"] = F.datediff("end_ts", "start_ts") >= min_days
    return out


def search(df: DataFrame, text: str = "", first: str | None = None, last: str | None = None, near: tuple[float, float, float] | None = None, online: bool | None = None, kind: str | None = None, min_days: float | None = None) -> DataFrame:
    """Q1: listings that match a text and all filters; ``near`` is (lat, lng, miles)."""
    out = df.where(matches_text(text)) if text else df
    for ok in _conditions(first, last, near, online, kind, min_days).values():
        out = out.where(ok)
    return out


def hidden_by_reason(df: DataFrame, text: str, **filters) -> DataFrame:
    """Q2: of the text's matches, how many each filter hides, in one pass."""
    given = {"first": None, "last": None, "near": None, "online": None, "kind": None, "min_days": None} | filters
    checks = _conditions(**given)
    return df.where(matches_text(text)).agg(F.count("*").alias("matches"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"hidden_by_{k}") for k, ok in checks.items()])


def default_window(as_of: date | str) -> tuple[Column, Column]:
    """Q3: today and six months on."""
    today = F.lit(as_of).cast("date")
    return today, F.add_months(today, 6)


def groups_without_listings(groups: DataFrame, df: DataFrame, key: str = "group_name") -> DataFrame:
    """Q4."""
    return groups.join(df.select(F.col("source").alias(key)).distinct(), key, "left_anti")


def listings_per_site(df: DataFrame) -> DataFrame:
    """Q5: listings that share a pin."""
    return df.where("lat is not null").groupBy("lat", "lng").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))


def colour_of(df: DataFrame, colours: DataFrame, default: str = "#888888") -> DataFrame:
    """Q6: the effective region's colour, of events or of practices."""
    out = df.join(colours, "kingdom", "left")
    pick = F.when(F.col("calendar_type") == "kingdom", F.col("event_color")).otherwise(F.col("practice_color"))
    return out.select(*df.columns, F.coalesce(pick, F.lit(default)).alias("colour"))


def local_online_in_view(df: DataFrame, groups: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Q7: online listings: a region's always, a local one if its group lies in (lat, lat, lng, lng)."""
    seen = groups.where(F.col("lat").between(box[0], box[1]) & F.col("lng").between(box[2], box[3])).select(F.col("group_name").alias("source"))
    online = df.where("is_virtual")
    return online.where("calendar_type = 'kingdom'").unionByName(online.where("calendar_type <> 'kingdom'").join(seen.distinct(), "source", "left_semi"))


def coverage_horizon(df: DataFrame) -> DataFrame:
    """Q8: the date through which listings were imported."""
    return df.agg(F.to_date(F.max("start_ts")).alias("through"))
