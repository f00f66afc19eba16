"""Duplicates, series and large events.

Wherever "the first row" counts, the row with the least ``row_id`` is meant: rows have no order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweave.functions.location import extract_state
from fairweave.functions.predicates import event_days, is_out_of_region
from fairweave.functions.text import normalize_title, title_tokens
from fairweave.operators.store import stored


def _place(c: str = "clean_location") -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def preferred(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row by ``order`` of each group of ``keys``."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).where("__n = 1").drop("__n")


def dedupe_listings(df: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """One row for each day, place and calendar type.

    Rows that are not marked out of region come first, then those from the region that hosts the
    place (``hosts``: state, region; without it a row whose source is its ``kingdom``), then region
    feeds.  Online rows and rows without a place or date are never duplicates.
    """
    placed = (_place() != "") & ~F.coalesce("is_virtual", F.lit(False)) & F.col("start_ts").isNotNull()
    day = F.to_date("start_ts")
    if hosts is None:
        home = F.col("source") == F.col("kingdom")
        src = df
    else:
        src = df.withColumn("__state", extract_state("clean_location")).join(hosts.select(F.col("state").alias("__state"), F.col("region").alias("__host")), "__state", "left")
        home = F.col("source") == F.col("__host")
    order = [is_out_of_region("title").cast("int"), F.when(home, 0).otherwise(1), F.when(F.col("calendar_type") == "kingdom", 0).otherwise(1), F.col("row_id")]
    kept = preferred(src.where(placed), [day, _place(), F.col("calendar_type")], order).select(df.columns)
    return kept.unionByName(df.where(~placed | placed.isNull()))


def _gaps(dates: Column) -> Column:
    return F.zip_with(F.slice(dates, F.lit(2), F.size(dates)), F.slice(dates, F.lit(1), F.size(dates) - 1), lambda b, a: F.datediff(b, a))


def is_recurring(dates: Column) -> Column:
    """Whether sorted dates (an array) follow a weekly or monthly cadence."""
    gaps = F.when(F.size(dates) >= 2, _gaps(dates))
    n = F.size(gaps)
    mean = F.aggregate(gaps, F.lit(0), lambda a, g: a + g) / n
    least, most = F.array_min(gaps), F.array_max(gaps)
    even = F.forall(gaps, lambda g: F.abs(g - mean) <= 3) & mean.between(6, 32)
    slack = F.when(least < 20, 2).otherwise(3)
    skips = least.between(6, 32) & F.forall(gaps, lambda g: (F.abs(g - least) <= slack) | (F.abs(g - least * 2) <= slack) | (F.abs(g - least * 3) <= slack))
    middle = F.get(F.sort_array(gaps), F.floor(n / 2).cast("int"))
    often = (F.size(dates) >= 3) & middle.between(2, 16) & (most <= 21)
    return F.coalesce(even | skips | often, F.lit(False))


def merge_series(df: DataFrame, shown: int = 8) -> DataFrame:
    """D3: rows of one source, title and place in a recurring cadence become the first of them.

    Its title is marked, ``series_dates`` has the first ``shown`` dates, and a ``description``, where there is
    one, gets them in words, with how many more there are and until when.  Rows that are part of no series,
    and undated ones, stay as they are.
    """
    key = ["source", "title", "__p"]
    dated = df.where("start_ts is not null").select("*", _place().alias("__p"))
    series = dated.groupBy(*key).agg(F.sort_array(F.collect_list(F.to_date("start_ts"))).alias("__d"))
    series = series.where(is_recurring(F.col("__d"))).withColumnsRenamed({"source": "__s", "title": "__t", "__p": "__q"})
    same = F.col("source").eqNullSafe(F.col("__s")) & F.col("title").eqNullSafe(F.col("__t")) & (F.col("__p") == F.col("__q"))
    first = F.row_number().over(Window.partitionBy(*key).orderBy("start_ts", "row_id"))
    kept = dated.withColumn("__n", first).join(series, same, "left").where("__d is null or __n = 1")
    day = lambda d: F.date_format(d, "d MMM yyyy")
    more = F.size("__d") - shown
    words = F.concat(F.array_join(F.transform(F.slice("__d", 1, shown), day), ", "), F.when(more > 0, F.concat(F.lit(", … "), more.cast("string"), F.lit(" more through "), day(F.element_at("__d", -1)))).otherwise(F.lit("")))
    told = F.concat(F.regexp_replace(F.coalesce(F.col("description") if "description" in df.columns else F.lit(""), F.lit("")), r"\s+$", ""), F.lit(" [RECURRING — also on: "), words, F.lit("]"))
    new = {"title": F.concat("title", F.lit(" (RECURRING)")), "description": told}
    out = kept.select(*[F.when(F.col("__d").isNotNull(), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns], F.slice("__d", 1, shown).alias("series_dates"))
    return out.unionByName(df.where("start_ts is null").withColumn("series_dates", F.lit(None).cast("array<date>")))


def venues_meet(x: Column, y: Column) -> Column:
    """J6 for venues in the form of ``normalize_title``; before a join that form is made once for each side."""
    number = lambda c: F.regexp_extract(c, r"^\d+", 0)
    word = lambda c: F.coalesce(F.get(F.split(c, " "), F.lit(1)), F.lit(""))
    return (x == "") | (y == "") | x.contains(y) | y.contains(x) | ((number(x) != "") & (number(x) == number(y)) & (word(x) == word(y)))


def same_venue(a: Column, b: Column) -> Column:
    """Unknown on either side, one within the other, or the same number and next word."""
    return venues_meet(normalize_title(a), normalize_title(b))


def _similar(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return (shared > 0) & (shared * 2 >= F.greatest(F.size(a), F.size(b)))


def _rare_first(titles: DataFrame) -> DataFrame:
    """(__tok, __rare): the words of each distinct title, those first that fewest titles have."""
    word = titles.select("__tok", F.explode("__tok").alias("w"))
    times = word.groupBy("w").agg(F.count("*").alias("n"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "w"))), lambda x: x["w"])
    return word.join(times, "w").groupBy("__tok").agg(ordered.alias("__rare"))


def similar_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that one of ``right`` resembles; both are distinct (__day, __tok, __loc).

    Two titles are alike if they share half of the larger set of words.  Words are ordered over all titles, rare ones first:
    then both have a common word among their first ones (half of them and one more), and common words, on which
    unlike titles meet, are hardly ever looked up.  What still meets is dropped if too few words follow in either title.
    """
    rare = _rare_first(left.select("__tok").union(right.select("__tok")).distinct().where("size(__tok) > 0"))
    size = F.size("__rare")
    under = F.posexplode(F.slice("__rare", F.lit(1), size - F.ceil(size / 2).cast("int") + 1)).alias("__i", "__key")
    side = lambda df: df.join(rare, "__tok").select("__day", "__tok", "__loc", under)
    other = side(right).withColumnsRenamed({"__day": "d", "__tok": "t", "__loc": "l", "__i": "j", "__key": "k"})
    enough = (1 + F.least(F.size("__tok") - 1 - F.col("__i"), F.size("t") - 1 - F.col("j"))) * 2 >= F.greatest(F.size("__tok"), F.size("t"))
    alike = (F.col("__day") == F.col("d")) & (F.col("__key") == F.col("k")) & enough & _similar(F.col("__tok"), F.col("t")) & venues_meet(F.col("__loc"), F.col("l"))
    return side(left).join(other, alike, "left_semi").select("__day", "__tok", "__loc").distinct()


def _without_copies(df: DataFrame, candidate: Column, original: Column) -> DataFrame:
    """Anti join: candidates that an original of the same day resembles in title and venue go.

    Distinct (day, tokens, venue) are compared, not rows, so popular titles stay cheap.  The keys are made once and stored.
    """
    keyed = stored(df.withColumns({"__day": F.to_date("start_ts"), "__tok": F.array_sort(title_tokens("title")), "__loc": normalize_title("clean_location")}), "titles")
    side = lambda which: keyed.where(which).select("__day", "__tok", "__loc").distinct().where("size(__tok) > 0")
    copies = similar_titles(side(candidate), side(original)).withColumns({"__copy": F.lit(True), "__cand": F.lit(True)})
    out = keyed.withColumn("__cand", candidate).join(copies, ["__day", "__tok", "__loc", "__cand"], "left")
    return out.where("__copy is null").select(df.columns)


def drop_aggregator_copies(df: DataFrame) -> DataFrame:
    """An aggregator's rows that another feed lists go; the flag column goes too."""
    flag = F.coalesce("is_aggregator", F.lit(False))
    return _without_copies(df, flag, ~flag).drop("is_aggregator")


def drop_local_copies(df: DataFrame) -> DataFrame:
    """Local rows that a region's feed lists go; both in person and with a place."""
    placed = (F.trim(F.coalesce("clean_location", F.lit(""))) != "") & ~F.coalesce("is_virtual", F.lit(False))
    return _without_copies(df, placed & (F.col("calendar_type") == "baronial"), placed & (F.col("calendar_type") == "kingdom"))


def overlap_with_known(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """(feed_id, source, shared): candidates' events that a source lists, by day, title and venue."""
    c = candidates.select("feed_id", F.to_date("start_ts").alias("day"), normalize_title("title").alias("t"), normalize_title("clean_location").alias("a"), "row_id")
    k = known.select("source", F.to_date("start_ts").alias("day"), normalize_title("title").alias("t"), normalize_title("clean_location").alias("b")).distinct()
    return c.join(k, ["day", "t"]).where(venues_meet(F.col("a"), F.col("b"))).groupBy("feed_id", "source").agg(F.count_distinct("row_id").alias("shared"))


def modal_dates(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3: the most common (start, end) days in each group; all of them where they tie."""
    count = df.groupBy(*keys, F.to_date("start_ts").alias("d1"), F.to_date("end_ts").alias("d2")).agg(F.count("*").alias("n"))
    return count.withColumn("r", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("n")))).where("r = 1").drop("r")


def interval_overlap(left: DataFrame, right: DataFrame, keys: list[str], days: int = 32) -> DataFrame:
    """(left_id, right_id) of intervals with equal ``keys`` that share a day, each pair once.

    ``left`` has left_id, keys, first and last (dates, both included), ``right`` right_id and the same.  Intervals
    are listed under stretches of ``days`` days, an equi-join; a pair is given out where the later of the two begins.
    Without a last day an interval is one day long; one without a first, or with a null key, overlaps nothing.
    """
    stretch = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / days)

    def listed(df: DataFrame, own: str) -> DataFrame:
        last = F.greatest("first", F.coalesce("last", "first"))
        spans = df.where("first is not null").select(own, *keys, F.col("first").alias(f"{own}_first"), last.alias(f"{own}_last"))
        return spans.select("*", F.explode(F.sequence(stretch(F.col(f"{own}_first")), stretch(F.col(f"{own}_last")))).alias("__at"))

    both = listed(left, "left_id").join(listed(right, "right_id"), [*keys, "__at"])
    meet = (F.col("left_id_first") <= F.col("right_id_last")) & (F.col("left_id_last") >= F.col("right_id_first"))
    here = F.col("__at") == stretch(F.greatest("left_id_first", "right_id_first"))
    return both.where(meet & here).select("left_id", "right_id")


def _marquee_matches(df: DataFrame, events: DataFrame, min_days: float) -> DataFrame:
    """(row_id, event_seq, host, year, calendar_type, source, first, last, start_ts) of listings that name an event.

    An event is looked up by the first word of a keyword; of several the least event_seq counts.
    """
    title = F.concat(F.lit(" "), normalize_title("title"), F.lit(" "))
    long = df.where(event_days(F.col("start_ts"), F.col("end_ts")) >= min_days)
    first, last = F.to_date("start_ts"), F.to_date(F.coalesce("end_ts", "start_ts"))
    long = long.select("row_id", "calendar_type", "source", "start_ts", first.alias("first"), F.to_date("end_ts").alias("end"), last.alias("last"), F.year("start_ts").alias("year"), title.alias("__title"))
    words = long.select("*", F.explode(F.array_distinct(F.split(F.trim("__title"), " "))).alias("__word"))
    keys = events.select("event_seq", "host", F.explode("keywords").alias("kw")).withColumn("__word", F.split("kw", " ")[0])
    named = words.join(keys, "__word").where(F.col("__title").contains(F.concat(F.lit(" "), F.col("kw"), F.lit(" "))))
    of = named.groupBy("row_id").agg(F.min(F.struct("event_seq", "host")).alias("e"))
    return long.hint("merge").join(of, "row_id").select("row_id", "e.event_seq", "e.host", "year", "calendar_type", "source", "first", "end", "last", "start_ts")


def marquee_merge(df: DataFrame, events: DataFrame, min_days: float = 3) -> DataFrame:
    """All listings of a large event in a year become one row.

    The dates are those of the host region's first listing, else the most common ones, the earliest
    of a tie.  Local listings join if they overlap these dates.  The row has the fullest description of
    all its listings and, where ``events`` has them, the event's host, place, pin (lat, lng) and link (website);
    a hand-set pin has the status "override" and no note on its precision.  Columns that ``df`` lacks are left out.
    """
    named = stored(_marquee_matches(df, events, min_days), "large-events")
    group = ["event_seq", "year"]
    region = named.where("calendar_type = 'kingdom'")
    modal = modal_dates(region.select(*group, F.col("first").alias("start_ts"), F.col("end").alias("end_ts")), group).select(*group, F.col("d1").alias("first"), F.col("d2").alias("end"), F.lit(True).alias("agreed"))
    modal = modal.withColumnsRenamed({c: f"m_{c}" for c in (*group, "first", "end")})
    same = (F.col("event_seq") == F.col("m_event_seq")) & (F.col("year") == F.col("m_year")) & (F.col("first") == F.col("m_first")) & F.col("end").eqNullSafe(F.col("m_end"))
    own = F.col("source").eqNullSafe(F.col("host"))
    order = F.struct(F.when(own, 0).when(F.col("agreed"), 1).otherwise(2), F.when(~own, F.col("start_ts")), F.col("row_id"))
    chosen = region.join(modal, same, "left").groupBy(*group).agg(F.min_by(F.struct("row_id", "first", "last"), order).alias("c")).select(*group, F.col("c.row_id").alias("chosen"), "c.first", "c.last")
    # all years of an event are compared by their dates: a listing may start the year before
    span = chosen.select(F.col("year").alias("right_id"), "event_seq", "first", "last")
    local = named.where("calendar_type <> 'kingdom'").select(F.struct("event_seq", "row_id", "source").alias("left_id"), "event_seq", "first", "last")
    local = interval_overlap(local, span, ["event_seq"]).select("left_id.event_seq", F.col("right_id").alias("year"), "left_id.row_id", "left_id.source")
    members = stored(region.select(*group, "row_id", "source").unionByName(local), "large-event-members")
    text = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
    told = members.join(df.select("row_id", F.coalesce(text, F.lit("")).alias("__text")), "row_id")
    counts = told.groupBy(*group).agg(F.count_distinct("row_id").alias("merged"), F.count_distinct("source").alias("sources"), F.max_by("__text", F.struct(F.length("__text"), -F.col("row_id"))).alias("__fullest"))

    given = [c for c in ("place", "lat", "lng", "website") if c in events.columns]
    about = events.select("event_seq", "host", *[F.col(c).alias(f"__{c}") for c in given])
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    placed = F.col("__lat").isNotNull() & F.col("__lng").isNotNull() if "lat" in given else F.lit(False)
    new = {"source": F.coalesce(some("host"), "source"), "calendar_type": F.lit("kingdom"), "is_virtual": F.lit(False), "description": F.col("__fullest"), "address_confidence": F.lit("high"), "dates_approximate": F.lit("")}
    if "place" in given:
        new |= {c: F.coalesce(some("__place"), "clean_location") for c in ("location", "clean_location")}
    if "lat" in given:
        new |= {c: F.when(placed, F.col(f"__{c}")).otherwise(F.col(c)) for c in ("lat", "lng") if c in df.columns}
        new |= {c: F.when(placed, v).otherwise(F.col(c)) for c, v in (("geocode_status", "override"), ("location_specificity", "")) if c in df.columns}
    if "website" in given:
        linked = F.coalesce(some("__website"), F.lit("")) != ""
        new |= {c: F.when(linked, v).otherwise(F.col(c)) for c, v in (("event_url", F.col("__website")), ("facebook_url", F.lit(""))) if c in df.columns}
    one = counts.join(chosen, group).join(about, "event_seq").drop("first", "last", "year")
    event = df.hint("merge").join(one, F.col("row_id") == F.col("chosen")).select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns], "merged", "sources")
    rest = df.join(members.select("row_id").distinct(), "row_id", "left_anti").select(*df.columns, F.lit(1).cast("long").alias("merged"), F.lit(1).cast("long").alias("sources"))
    return event.unionByName(rest)


def placeholders(events: DataFrame, listed: DataFrame, as_of: date | str) -> DataFrame:
    """(event_seq, name, start_date, end_date) of this and next year's events that nobody lists yet.

    ``events`` has month and day of a usual start and end; ranges that are over by ``as_of`` are left out.
    ``listed`` has event_seq and year.
    """
    today = F.lit(as_of).cast("date")
    years = events.where("from_month is not null").select("*", F.explode(F.array(F.year(today), F.year(today) + 1)).alias("year"))
    open_ = years.join(listed.select("event_seq", "year").distinct(), ["event_seq", "year"], "left_anti")
    out = open_.select("event_seq", "name", F.make_date("year", "from_month", "from_day").alias("start_date"), F.make_date("year", "to_month", "to_day").alias("end_date"))
    return out.where(F.col("end_date") >= today)


def dedupe_across_pages(df: DataFrame, by: list[str]) -> DataFrame:
    """Unique rows over result pages, the first kept, with a stable id."""
    kept = preferred(df, [F.col(c) for c in by], [F.col("row_id")])
    return kept.withColumn("listing_id", F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]), 256), 1, 16))
