"""Feeds: registry, calendar files, JSON records, crawled pages, sitemaps; and the table they end in."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fairweave.functions.text import clean_text, strip_html, unescape
from fairweave.operators.store import stored

#: Columns of the served table, in order.
SERVED = ["row_id", "title", "start_ts", "end_ts", "source", "kingdom", "calendar_type", "is_virtual", "clean_location", "lat", "lng"]


def feed_registry(regions: DataFrame, locals_: DataFrame, placeholders: list[str] = ["", "none", "n/a", "-"]) -> DataFrame:
    """(feed_id, source, calendar_type, is_aggregator) of both registries; unknown types and placeholders go."""
    a = regions.select(F.trim("id").alias("feed_id"), F.trim("source").alias("source"), F.lower(F.trim("type")).alias("calendar_type"), F.lit(False).alias("is_aggregator"))
    b = locals_.select(F.trim("calendar_id").alias("feed_id"), F.concat_ws(" of ", F.trim("type"), F.trim("group")).alias("source"), F.lit("baronial").alias("calendar_type"), F.coalesce("is_aggregator", F.lit(False)).alias("is_aggregator"))
    both = a.unionByName(b).where(F.col("calendar_type").isin("kingdom", "baronial"))
    return both.where(~F.lower("feed_id").isin(placeholders))


def feed_url(c: Column | str) -> Column:
    """The feed's address from an embed link, an address or a bare id."""
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    inner = F.try_url_decode(F.regexp_extract(text, r"[?&]src=([^&]+)", 1))
    wrap = lambda i: F.concat(F.lit("https://calendar.google.com/calendar/ical/"), F.replace(i, F.lit("@"), F.lit("%40")), F.lit("/public/basic.ics"))
    return F.when(text.contains("/embed?") & (inner != ""), wrap(inner)).when(text.rlike(r"^(https?|webcal)://"), F.regexp_replace(text, "^webcal://", "https://")).otherwise(wrap(text))


def _property(block: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(block, rf"(?m)^{name}(?:;[^:\n]*)?:(.*)$", 1), F.lit(""))


def _stamp(text: Column) -> Column:
    """A wall-clock time without zone, from a date or date-time property."""
    t = F.regexp_replace(text, r"Z$", "")
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(t, F.lit("yyyyMMdd"))).cast("timestamp_ntz")


def read_ics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3: (events, rejects) of a folder of calendar files.

    One row per event: file, row_id, uid, title, location, description, url, start_ts, end_ts, rrule,
    exdates and stamp.  Files without a calendar, and events without a title or a start, are rejects;
    a bad event drops only itself.  Files are read event by event, so a large one is read by many tasks; what holds for a
    whole file (it is no calendar, it is a saved page) is found first and joined back to its events.  An event that a file has
    twice, word for word, counts once.
    """
    part = spark.read.option("lineSep", "END:VEVENT").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\r", "").alias("body"))
    files = part.groupBy("file").agg(F.max(F.col("body").contains("BEGIN:VCALENDAR")).alias("calendar"), F.max(F.col("body").contains("<pre")).alias("page"), F.min(F.substring("body", 1, 200)).alias("text"))
    none = files.where("not calendar").select("file", F.lit("no calendar").alias("reason"), "text")
    # few files are odd; the others' events meet no row here
    odd = files.where("page or not calendar").select("file", "calendar", "page")
    rows = part.where(F.col("body").contains("BEGIN:VEVENT")).join(odd, "file", "left").where("coalesce(calendar, true)")
    plain = F.when(F.col("page"), unescape(F.regexp_replace("body", r"(?s)^.*?<pre[^>]*>|</pre>.*$", ""))).otherwise(F.col("body"))
    rows = rows.select("file", F.regexp_replace(plain, r"\n[ \t]", "").alias("body"))
    block = rows.select("file", F.explode(F.slice(F.split("body", "BEGIN:VEVENT\n"), 2, 1_000_000)).alias("block"))
    block = block.withColumn("row_id", F.xxhash64("file", "block")).dropDuplicates(["row_id"])
    text = lambda n: clean_text(_property(F.col("block"), n))
    events = block.select(
        "file",
        "row_id",
        _property(F.col("block"), "UID").alias("uid"),
        text("SUMMARY").alias("title"),
        text("LOCATION").alias("location"),
        text("DESCRIPTION").alias("description"),
        _property(F.col("block"), "URL").alias("url"),
        _stamp(_property(F.col("block"), "DTSTART")).alias("start_ts"),
        _stamp(_property(F.col("block"), "DTEND")).alias("end_ts"),
        _property(F.col("block"), "RRULE").alias("rrule"),
        F.regexp_extract_all("block", F.lit(r"(?m)^EXDATE(?:;[^:\n]*)?:(\d{8})"), F.lit(1)).alias("exdates"),
        _stamp(_property(F.col("block"), "DTSTAMP")).alias("stamp"),
        "block",
    )
    good = F.col("title").isNotNull() & F.col("start_ts").isNotNull()
    bad = events.where(~good).select("file", F.lit("no title or start").alias("reason"), F.substring("block", 1, 200).alias("text"))
    return events.where(good).drop("block"), none.unionByName(bad)


def expand_recurrence(df: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """One row per occurrence in [first, last] of DAILY, WEEKLY, MONTHLY and YEARLY rules.

    ``df`` has rrule (INTERVAL, COUNT, UNTIL and, for weeks, BYDAY are read), exdates (yyyymmdd) and
    start_ts; a null rule is the single start.  Adds ``occurs_on``.  Steps are counted from the start, so
    COUNT and INTERVAL hold across the window's edges.
    """
    field = lambda n: F.nullif(F.regexp_extract("__rule", rf"(?:^|;){n}=([^;]+)", 1), F.lit(""))
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    # fields of a rule are read once for a row, not once for each step
    read = df.withColumns({"__rule": F.upper(F.coalesce("rrule", F.lit(""))), "__d": F.to_date("start_ts")})
    day_number = lambda x: F.array_position(F.array(*[F.lit(w) for w in ("MO", "TU", "WE", "TH", "FR", "SA", "SU")]), F.regexp_replace(x, r"^[-+]?\d+", "")).cast("int") - 1
    read = read.withColumns(
        {
            "__freq": field("FREQ"),
            "__step": F.greatest(F.coalesce(field("INTERVAL").try_cast("int"), F.lit(1)), F.lit(1)),
            "__count": field("COUNT").try_cast("int"),
            "__until": F.least(hi, F.coalesce(F.to_date(F.try_to_timestamp(F.substring(field("UNTIL"), 1, 8), F.lit("yyyyMMdd"))), hi)),
            "__days": F.transform(F.split(field("BYDAY"), ","), day_number),
            "__monday": F.date_sub("__d", F.weekday("__d")),
            "__out": F.transform(F.coalesce("exdates", F.array().cast("array<string>")), lambda x: F.to_date(F.try_to_timestamp(x, F.lit("yyyyMMdd")))),
        }
    )
    d, step, count, until, monday = (F.col(c) for c in ("__d", "__step", "__count", "__until", "__monday"))
    # without COUNT, steps that end before the window are passed over
    skipped = lambda unit: F.when(count.isNull(), F.greatest(F.floor(F.datediff(lo, d) / unit / step) - 1, F.lit(0))).otherwise(F.lit(0))
    spine = lambda n, unit: F.transform(F.when((d <= until) & (skipped(unit) <= F.floor(n / step)), F.sequence(skipped(unit), F.floor(n / step))).otherwise(F.array().cast("array<bigint>")), lambda k: (k * step).cast("int"))
    by_day = F.transform(spine(F.datediff(until, d), 1), lambda k: F.date_add(d, k))
    offsets = F.coalesce("__days", F.array(F.weekday(d)))
    by_week = F.flatten(F.transform(spine(F.floor(F.datediff(until, monday) / 7), 7), lambda k: F.transform(offsets, lambda o: F.when(F.date_add(monday, k * 7 + o) >= d, F.date_add(monday, k * 7 + o)))))
    months = F.greatest((F.year(until) - F.year(d)) * 12 + F.month(until) - F.month(d), F.lit(0))
    same_day = lambda x: F.when(F.day(x) == F.day(d), x)  # noqa: E731  a month without the day has no occurrence
    by_month = F.transform(spine(months, 31), lambda k: same_day(F.add_months(d, k)))
    by_year = F.transform(spine(F.floor(months / 12), 366), lambda k: same_day(F.add_months(d, k * 12)))
    freq = F.col("__freq")
    every = F.when(freq == "DAILY", by_day).when(freq == "WEEKLY", by_week).when(freq == "MONTHLY", by_month).when(freq == "YEARLY", by_year).otherwise(F.array(d))
    read = read.withColumn("__dates", F.sort_array(F.array_distinct(F.filter(every, lambda x: x.isNotNull() & (x <= until)))))
    counted = F.when(count.isNotNull(), F.slice("__dates", F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.col("__dates"))
    dates = F.filter(F.array_except(counted, "__out"), lambda x: (x >= lo) & (x <= hi))
    own = [c for c in read.columns if c not in df.columns]
    return read.withColumn("occurs_on", F.explode(dates)).drop(*own)


def _joined(*parts: Column) -> Column:
    """Parts of a place, blanks left out, repeats but for case left out."""
    some = F.filter(F.array(*[F.trim(F.coalesce(p, F.lit(""))) for p in parts]), lambda p: p != "")
    low = F.transform(some, F.lower)
    return F.array_join(F.filter(some, lambda p, i: F.array_position(low, F.lower(p)) == i + 1), ", ")


def tribe_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Records of an events REST answer."""
    shape = "struct<events:array<struct<id:string,title:string,description:string,start_date:string,end_date:string,url:string,venue:struct<venue:string,address:string,city:string,state:string,zip:string>>>>"
    e = df.select("source", F.explode(F.from_json(body, shape)["events"]).alias("e"))
    return e.select("source", F.col("e.id").alias("uid"), clean_text("e.title").alias("title"), strip_html("e.description").alias("description"), F.try_to_timestamp("e.start_date").cast("timestamp_ntz").alias("start_ts"), F.try_to_timestamp("e.end_date").cast("timestamp_ntz").alias("end_ts"), F.col("e.url").alias("event_url"), _joined(*[F.col(f"e.venue.{c}") for c in ("venue", "address", "city", "state", "zip")]).alias("location"))


def calon_events(df: DataFrame, page_texts: DataFrame, base: str = "https://example.org/event/", body: str = "body") -> DataFrame:
    """Records with site columns; the end defaults to the start, the text to the page's, else to who hosts."""
    shape = "array<struct<id:string,name:string,start:string,end:string,website:string,host:string,site_name:string,site_street:string,site_city:string,site_state:string>>"
    e = df.select("source", F.explode(F.from_json(body, shape)).alias("e"))
    s = F.try_to_timestamp("e.start").cast("timestamp_ntz")
    out = e.select("source", F.col("e.id").alias("uid"), clean_text("e.name").alias("title"), s.alias("start_ts"), F.coalesce(F.try_to_timestamp("e.end").cast("timestamp_ntz"), s).alias("end_ts"), F.coalesce(F.concat(F.lit(base), F.nullif("e.id", F.lit(""))), F.col("e.website")).alias("event_url"), _joined(*[F.col(f"e.site_{c}") for c in ("name", "street", "city", "state")]).alias("location"), F.concat_ws(" | ", F.concat(F.lit("Hosted by "), F.nullif("e.host", F.lit(""))), F.concat(F.lit("Website "), F.nullif("e.website", F.lit("")))).alias("stub"))
    t = page_texts.groupBy(F.col("url").alias("event_url")).agg(F.max("text").alias("text"))
    return out.join(t, "event_url", "left").withColumn("description", F.coalesce("text", "stub")).drop("text", "stub")


def drachenwald_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Records of type event that are not cancelled; an online address is the place where there is none."""
    shape = "array<map<string,string>>"
    e = df.select("source", F.explode(F.from_json(body, shape)).alias("e")).where("e['type'] = 'event' and lower(coalesce(e['status'], '')) <> 'cancelled'")
    place = _joined(F.col("e")["site-name"], F.col("e")["site-address"], F.col("e")["town"], F.col("e")["country"])
    day = lambda k: F.try_to_timestamp(F.col("e")[k], F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    return e.select("source", F.col("e")["slug"].alias("uid"), clean_text(F.col("e")["event-name"]).alias("title"), day("start-date").alias("start_ts"), F.coalesce(day("end-date"), day("start-date")).alias("end_ts"), F.when(place != "", place).otherwise(F.coalesce(F.col("e")["online-url"], F.lit(""))).alias("location"))


def mycal_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Day-keyed occurrences, each occurrence id once, approved and published ones only."""
    one = "struct<occur_id:string,occur_begin:string,occur_end:string,event_title:string,event_desc:string,event_label:string,event_street:string,event_city:string,event_state:string,event_approved:string>"
    by_day = F.flatten(F.map_values(F.from_json(body, f"map<string,array<{one}>>")))
    e = df.select("source", F.explode(F.coalesce(by_day, F.from_json(body, f"array<{one}>"))).alias("e")).where("e.event_approved in ('1', 'true')")
    e = e.groupBy("source", "e.occur_id").agg(F.min(F.col("e").cast(one)).alias("e"))
    return e.select("source", F.col("occur_id").alias("uid"), clean_text("e.event_title").alias("title"), strip_html("e.event_desc").alias("description"), F.try_to_timestamp("e.occur_begin").cast("timestamp_ntz").alias("start_ts"), F.try_to_timestamp("e.occur_end").cast("timestamp_ntz").alias("end_ts"), _joined(*[F.col(f"e.event_{c}") for c in ("label", "street", "city", "state")]).alias("location"))


def page_events(pages: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(events, pages without an event) of crawled pages.

    ``microdata``: itemprop name, startDate and location.  ``plugin``: event title and datetime
    attribute.  ``list``: <li> "date: title".  ``addlink``: an "add to calendar" link's fields.
    """
    all_ = lambda p, g=1: F.regexp_extract_all("html", F.lit(p), F.lit(g))
    if kind == "microdata":
        t, s, p = all_(r"(?is)itemprop=\"name\"[^>]*>([^<]+)<"), all_(r"(?is)itemprop=\"startDate\"[^>]*content=\"([^\"]+)\""), all_(r"(?is)itemprop=\"location\"[^>]*>([^<]*)<")
    elif kind == "plugin":
        t, s, p = all_(r"(?is)class=\"[^\"]*event-title[^\"]*\"[^>]*>\s*(?:<a[^>]*>)?([^<]+)<"), all_(r"(?is)<time[^>]*datetime=\"([^\"]+)\""), all_(r"(?is)class=\"[^\"]*event-venue[^\"]*\"[^>]*>([^<]*)<")
    elif kind == "list":
        t, s, p = all_(r"(?is)<li[^>]*>\s*\d{4}-\d{2}-\d{2}\s*:\s*([^<]+)<"), all_(r"(?is)<li[^>]*>\s*(\d{4}-\d{2}-\d{2})\s*:"), F.array().cast("array<string>")
    elif kind == "addlink":
        t, s, p = all_(r"calendar/(?:render|event)\?[^\"']*?[?&]?text=([^&\"']+)"), all_(r"calendar/(?:render|event)\?[^\"']*?dates=(\d{8}(?:T\d{6})?)"), all_(r"calendar/(?:render|event)\?[^\"']*?location=([^&\"']+)")
        plain = lambda xs: F.transform(xs, lambda x: F.coalesce(F.try_url_decode(x), x))
        t, p = plain(t), plain(p)
    else:
        raise ValueError(f"unknown page layout: {kind}")
    rows = pages.select("page_id", "url", F.explode_outer(F.arrays_zip(t.alias("t"), s.alias("s"), p.alias("p"))).alias("x"))
    s = F.col("x.s")
    when = F.coalesce(F.try_to_timestamp(s), F.try_to_timestamp(s, F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(s, F.lit("yyyyMMdd")), F.timestamp_seconds(s.try_cast("long"))).cast("timestamp_ntz")
    events = rows.select("page_id", "url", clean_text("x.t").alias("title"), when.alias("start_ts"), clean_text("x.p").alias("location")).where("title is not null and start_ts is not null")
    events = events.groupBy("title", "start_ts").agg(F.min(F.struct("page_id", "url", "location")).alias("b")).select("title", "start_ts", "b.page_id", "b.url", "b.location")
    missed = pages.join(rows.where("x.t is not null").select("page_id").distinct(), "page_id", "left_anti")
    return events, missed


#: Kind of source -> its reader; a new kind of source is one function and one entry.
READERS: dict[str, Callable] = {"tribe": tribe_events, "calon": calon_events, "drachenwald": drachenwald_events, "mycal": mycal_events}


def parse_date_range(c: Column | str) -> Column:
    """struct(first, last) of "May 16 2026", "Dec 19 - 21 2026" and "Dec 19 2026 - Jan 2 2027"; null if impossible."""
    text = F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[,\s]+", " "))
    day = lambda m, d, y: F.to_date(F.try_to_timestamp(F.concat_ws(" ", F.substring(m, 1, 3), d, y), F.lit("MMM d yyyy")))
    x = lambda p, i: F.regexp_extract(text, p, i)
    one, same, two = r"^([A-Za-z]+)\.? (\d{1,2}) (\d{4})$", r"^([A-Za-z]+)\.? (\d{1,2}) ?[-–] ?(\d{1,2}) (\d{4})$", r"^([A-Za-z]+)\.? (\d{1,2}) (\d{4}) ?[-–] ?([A-Za-z]+)\.? (\d{1,2}) (\d{4})$"
    both = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("first"), b.alias("last")))
    return F.coalesce(
        both(day(x(one, 1), x(one, 2), x(one, 3)), day(x(one, 1), x(one, 2), x(one, 3))),
        both(day(x(same, 1), x(same, 2), x(same, 4)), day(x(same, 1), x(same, 3), x(same, 4))),
        both(day(x(two, 1), x(two, 2), x(two, 3)), day(x(two, 4), x(two, 5), x(two, 6))),
    )


def guard_dates(df: DataFrame, first: int = 1900, last: int = 2100) -> DataFrame:
    """Rows with an implausible start go; an implausible or backwards end becomes the start."""
    ok = F.year("end_ts").between(first, last) & (F.col("end_ts") >= F.col("start_ts"))
    return df.where(F.year("start_ts").between(first, last)).withColumn("end_ts", F.when(ok, F.col("end_ts")).otherwise(F.col("start_ts")))


def sitemap_rows(df: DataFrame, body: str = "body") -> DataFrame:
    """(url, lastmod) of a sitemap's text."""
    block = df.select(F.explode(F.regexp_extract_all(body, F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))).alias("b"))
    return block.select(F.trim(F.regexp_extract("b", r"<loc>([^<]+)</loc>", 1)).alias("url"), F.nullif(F.regexp_extract("b", r"<lastmod>([^<]+)</lastmod>", 1), F.lit("")).alias("lastmod"))


def changed_pages(sitemap: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages to process: new or of another lastmod, cache rows that the sitemap still has)."""
    old = cache.select("url", F.col("lastmod").alias("__old"), F.lit(True).alias("__known"))
    todo = sitemap.join(old, "url", "left").where(F.col("__known").isNull() | ~F.col("lastmod").eqNullSafe(F.col("__old"))).select("url", "lastmod")
    return todo, cache.join(sitemap.select("url").distinct(), "url", "left_semi")


def static_practices(df: DataFrame, practices: DataFrame) -> DataFrame:
    """Hand-kept rows with a free-text schedule join the table; columns either lacks are null."""
    return df.unionByName(practices, allowMissingColumns=True)


def write_listings(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The served table, overwritten: exact column order, one folder per calendar type."""
    out = df.select(*SERVED, *[c for c in ("host_kingdom", "war_host") if c in df.columns])
    if fmt == "csv":
        out.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)
    else:
        out.write.mode("overwrite").partitionBy("calendar_type").parquet(path)


def read_listings(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """V5: (rows, ragged) of served CSV files: lines with as many fields as ``columns``, as text, and the others.

    ``ragged`` has file, line and fields (how many the line has).  Lines are parsed by Spark's reader against the whole
    schema; what it can't place is kept as it stood.
    """
    schema = StructType([StructField(c, StringType()) for c in [*columns, "__line"]])
    read = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__line").option("escape", '"')
    rows = stored(read.csv(path).withColumn("__file", F.col("_metadata.file_path")), "csv-rows")
    line = F.col("__line")
    # quoted fields count as one, whatever they hold
    fields = F.regexp_count(F.regexp_replace(line, r'"(?:[^"]|"")*"', "x"), F.lit(",")) + 1
    return rows.where(line.isNull()).select(columns), rows.where(line.isNotNull()).select(F.col("__file").alias("file"), line.alias("line"), fields.cast("long").alias("fields"))


def fetch_summary(registry: DataFrame, df: DataFrame) -> DataFrame:
    """Per feed: events, online ones, ones without a place; feeds with none have zeros."""
    n = df.groupBy("source").agg(F.count("*").alias("events"), F.count_if("is_virtual").alias("online"), F.count_if(F.coalesce("clean_location", F.lit("")) == "").alias("unplaced"))
    return registry.select("source").distinct().join(n, "source", "left").fillna(0, ["events", "online", "unplaced"])


def body_kind(body: Column | str) -> Column:
    """struct(kind, events) of a stored response: ics, json, html or empty."""
    text = F.ltrim(F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit("")))
    kind = F.when(text == "", "empty").when(text.contains("BEGIN:VCALENDAR"), "ics").when(text.startswith("{") | text.startswith("["), "json").otherwise("html")
    return F.struct(kind.alias("kind"), F.regexp_count(text, F.lit("BEGIN:VEVENT")).alias("events"))
