"""Feed health and integrity checks; all return DataFrames of findings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """A1."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def failure_rate(df: DataFrame, by: str | None = None) -> DataFrame:
    """A2: failed lookups among all that were not skipped."""
    keys = [by] if by else []
    failed, tried = F.count_if(F.col("geocode_status") == "failed"), F.count_if(F.coalesce("geocode_status", F.lit("")) != "skipped")
    return df.groupBy(*keys).agg(failed.alias("failed"), tried.alias("tried"), F.try_divide(failed, tried).alias("rate"))


def samples(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """A5: up to ``n`` first titles of each key; the rank is cut before the shuffle."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy(key).orderBy("start_ts", "row_id"))
    top = df.withColumn("__n", first).where(F.col("__n") <= n)
    return top.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__n", "title")))["title"].alias("sample"))


def date_anomalies(df: DataFrame, first: int = 1900, last: int = 2100) -> DataFrame:
    """Per source: rows, implausible years, ends before starts, missing dates, and a flag."""
    s, e = F.col("start_ts"), F.col("end_ts")
    bad_year, backwards, missing = F.count_if(~F.year(s).between(first, last)), F.count_if(e < s), F.count_if(s.isNull())
    out = df.groupBy("source").agg(F.count("*").alias("total"), bad_year.alias("bad_year"), backwards.alias("backwards"), missing.alias("missing"))
    return out.withColumn("flag", F.when(F.col("bad_year") + F.col("backwards") + F.col("missing") > 0, "ANOMALY").otherwise("clean"))


def zero_feeds(registry: DataFrame, df: DataFrame, exempt: list[str] = []) -> DataFrame:
    """H1: configured feeds without a listing."""
    return registry.select("source").distinct().where(~F.col("source").isin(exempt)).join(df.select("source").distinct(), "source", "left_anti")


def feed_drop(now: DataFrame, before: DataFrame, drop: float = 0.6, least: int = 10) -> DataFrame:
    """H2: feeds that lost a share of ``drop`` of at least ``least`` listings."""
    a, b = now.groupBy("source").agg(F.count("*").alias("now")), before.groupBy("source").agg(F.count("*").alias("before"))
    out = b.join(a, "source", "left").withColumn("now", F.coalesce("now", F.lit(0)))
    return out.where((F.col("before") >= least) & (F.col("now") <= F.col("before") * (1 - drop))).select("source", "before", "now")


def total_drop(now: DataFrame, before: DataFrame, drop: float = 0.3) -> DataFrame:
    """H3: one row with both totals and whether the drop is alarming."""
    a, b = now.agg(F.count("*").alias("now")), before.agg(F.count("*").alias("before"))
    return a.join(b, F.lit(True)).withColumn("alarm", F.col("now") <= F.col("before") * (1 - drop))


def failrate_spike(df: DataFrame, most: float = 0.08) -> DataFrame:
    """H4."""
    return failure_rate(df).withColumn("alarm", F.coalesce(F.col("rate") > most, F.lit(False)))


def local_silent(now: DataFrame, before: DataFrame, least: int = 10) -> DataFrame:
    """H5: local feeds that had listings and have none."""
    had = before.where("calendar_type = 'baronial'").groupBy("source").agg(F.count("*").alias("before")).where(F.col("before") >= least)
    return had.join(now.select("source").distinct(), "source", "left_anti")


def stale_files(df: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """H6: hand-kept files whose newest stamp is old, or whose last event is near or over."""
    today = F.lit(as_of).cast("date")
    out = df.groupBy("file").agg(F.to_date(F.max("stamp")).alias("newest"), F.to_date(F.max("start_ts")).alias("last_event"))
    old, ends = F.datediff(today, "newest") > days, F.datediff("last_event", today) < days
    return out.withColumn("reason", F.when(old, "not updated").when(ends, "runs out")).where("reason is not null")


def state_snapshot(df: DataFrame, run_id: str) -> DataFrame:
    """H7: counts to keep for the next run."""
    return counts_by(df, "calendar_type", "source").withColumn("run_id", F.lit(run_id))


def health_rollup(df: DataFrame) -> DataFrame:
    """H8: totals, by calendar type and by source, in one result."""
    return df.rollup("calendar_type", "source").agg(F.count("*").alias("n"), F.count_if(F.col("clean_location") == "").alias("unplaced"), F.count_if("is_virtual").alias("online"))


def check_unique(df: DataFrame, *keys: str) -> DataFrame:
    """V1: keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_reference(df: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """V2: values that the dimension lacks."""
    values = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    return values.join(dimension.select(F.col(key).alias("value")).distinct(), "value", "left_anti")


def check_format(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """V3: values that do not match a pattern."""
    return df.select(F.col(column).alias("value")).where(~F.col("value").rlike(pattern) | F.col("value").isNull()).distinct()


def check_coordinates(df: DataFrame) -> DataFrame:
    """V3: rows whose coordinates are not a pair in range."""
    lat, lng = F.col("lat"), F.col("lng")
    return df.where((lat.isNull() != lng.isNull()) | ~F.coalesce(lat.between(-90, 90) & lng.between(-180, 180), F.lit(True)))


def check_shared_feed(df: DataFrame, feed: str = "feed_id", region: str = "kingdom") -> DataFrame:
    """V4: feeds that two regions use."""
    return df.groupBy(feed).agg(F.count_distinct(region).alias("regions")).where("regions > 1")


def check_schema(df: DataFrame, columns: list[str]) -> DataFrame:
    """V5: expected and actual columns that differ, by place."""
    rows = [(i, a, b) for i, (a, b) in enumerate(zip([*columns, *[None] * len(df.columns)], [*df.columns, *[None] * len(columns)])) if a != b and (a or b)]
    return df.sparkSession.createDataFrame(rows, "place int, expected string, actual string")


def check_symmetric(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """V6: pairs whose mirror image is missing."""
    return pairs.join(pairs.select(F.col(a).alias("__b"), F.col(b).alias("__a")), (F.col(a) == F.col("__a")) & (F.col(b) == F.col("__b")), "left_anti")


def dead_links(pages: DataFrame, status: Column, body: str = "html", least: int = 300) -> DataFrame:
    """V7: stored responses that are no page: bad status, short body, or a "not found" near the top."""
    text = F.trim(F.regexp_replace(F.regexp_replace(F.col(body), r"<[^>]+>", " "), r"\s+", " "))
    gone = F.lower(F.substring(text, 1, 5000)).rlike(r"page not found|404 not found|domain (is )?for sale|account suspended")
    reason = F.when(status != 200, "status").when(F.length(body) < least, "short").when(gone, "not found")
    return pages.withColumn("reason", reason).where("reason is not null")
