"""More queries: single functions, the location cascade, health findings, feeds and caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairweave.functions import location as loc
from fairweave.functions import predicates as P
from fairweave.functions import text as T
from fairweave.operators import dedup as D
from fairweave.operators import discovery as N
from fairweave.operators import geo as G
from fairweave.operators import places as L
from fairweave.operators import privacy as X
from fairweave.operators import quality as H
from fairweave.operators import serve as Q
from fairweave.operators import state as J
from fairweave.operators.store import shared_folder
from fairweave.plans import fixtures as fx
from fairweave.plans.queries import _CANDIDATES, _NORM, _PRIOR, _TOK, _VENUE, _prior, _unescape_sql, query
from fairweave.sources import feeds as S


@query("title_keys", f"SELECT row_id, {_NORM} AS title_key, array_to_string(list_sort({_TOK}), ' ') AS tokens, string_split(trim(title), ' ')[1] AS first_word FROM listings")
def title_keys(spark, sf):
    df = fx.listings(spark, sf)
    return df.select("row_id", T.normalize_title("title").alias("title_key"), F.array_join(F.array_sort(T.title_tokens("title")), " ").alias("tokens"), T.first_words("title", 1).alias("first_word"))


_ESCAPED = r"replace(replace(replace(replace(text, '\,', ','), '\;', ';'), '\n', ' '), '\N', ' ')"


@query("clean_text", f"SELECT doc_id, md5(trim(regexp_replace(regexp_replace({_unescape_sql(_ESCAPED)}, '[\\r\\n]', ' ', 'g'), ' {{2,}}', ' ', 'g'))) AS clean_md5 FROM documents".replace("{{", "{").replace("}}", "}"), raw=True)
def clean_text(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", F.md5(T.clean_text("text")).alias("clean_md5"))


@query("group_keys", "SELECT group_id, trim(lower(regexp_replace(group_name, '[^A-Za-z0-9 ]', '', 'g'))) AS full_key, regexp_replace(trim(lower(regexp_replace(group_name, '[^A-Za-z0-9 ]', '', 'g'))), '^(barony|shire|canton|college) of (the )?', '') AS short_key FROM groups_reg")
def group_keys(spark, sf):
    return fx.groups(spark, sf).select("group_id", T.group_key("group_name").alias("full_key"), T.short_group_key("group_name").alias("short_key"))


@query("non_events", "SELECT row_id, title IN ('Award deadline', 'Cancelled: Demo') AS non_event, title = 'Cancelled: Demo' AS cancelled, contains(title, 'OUT OF KINGDOM') AS away FROM listings")
def non_events(spark, sf):
    return fx.listings(spark, sf).select("row_id", P.is_non_event("title").alias("non_event"), P.is_cancelled("title", F.lit("")).alias("cancelled"), P.is_out_of_region("title").alias("away"))


@query("marquee_flags", "SELECT row_id, calendar_type = 'kingdom' AND regexp_matches(title, '(?i)\\bwars?\\b') AND date_diff('second', start_ts, end_ts) / 86400.0 >= 5 AS marquee FROM listings")
def marquee_flags(spark, sf):
    return fx.listings(spark, sf).select("row_id", P.is_marquee("title", "calendar_type", F.col("start_ts"), F.col("end_ts")).alias("marquee"))


@query("promote_local", "SELECT row_id, CASE WHEN calendar_type = 'kingdom' AND is_virtual THEN 'baronial' ELSE calendar_type END AS calendar_type FROM listings")
def promote_local(spark, sf):
    groups = fx.groups(spark, sf).select(F.col("kingdom").alias("region"), "group_name")
    return L.promote_local(fx.listings(spark, sf), groups).select("row_id", "calendar_type")


@query("needs_description", "SELECT page_id, lower(regexp_extract(url, '^https?://(?:www\\.)?([^/:?#]+)', 1)) LIKE '%.example%' AND page_id % 3 <> 1 AS needed FROM pages", raw=True)
def needs_description(spark, sf):
    p = fx.table(spark, sf, "pages")
    text = F.when(F.expr("page_id % 3 = 0"), "No description yet").when(F.expr("page_id % 3 = 1"), "A description that is long enough to be of use to readers").otherwise(F.col("url"))
    eligible = P.url_host("url").contains(".example")
    return p.withColumn("text", text).select("page_id", P.needs_description("text", "url", eligible).alias("needed"))


@query("published_pins", "SELECT row_id, round(lat, 4) AS lat, round(lng, 4) AS lng FROM listings")
def published_pins(spark, sf):
    df = fx.listings(spark, sf)
    kind = F.expr("cast(row_id % 4 as int)")
    number = lambda c: F.format_string("%.5f", F.col(c))
    text = F.when(kind == 0, F.concat(F.lit("Park GPS: "), number("lat"), F.lit(" N, "), F.format_string("%.5f", -F.col("lng")), F.lit(" W"))).when(kind == 1, F.concat(F.lit("at "), number("lat"), F.lit(", "), number("lng"))).when(kind == 2, F.concat(F.lit("https://maps.google.com/maps?q="), number("lat"), F.lit(","), number("lng"))).otherwise(F.concat(F.lit("https://x.org/#map=9/"), number("lat"), F.lit("/"), number("lng")))
    told = df.select("row_id", text.alias("location"), F.lit("").alias("description"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"), F.lit("").alias("geocode_status"))
    return L.published_prepass(told).select("row_id", F.round("lat", 4).alias("lat"), F.round("lng", 4).alias("lng"))


@query(
    "resolve_location",
    """SELECT row_id, CASE WHEN row_id % 3 = 0 THEN clean_location WHEN row_id % 3 = 1 AND clean_location <> '' THEN clean_location WHEN calendar_type = 'baronial' AND NOT is_virtual THEN '' WHEN row_id % 3 = 2 THEN 'Texas, USA' ELSE '' END AS address,
 CASE WHEN row_id % 3 = 0 AND clean_location <> '' THEN 'own' WHEN row_id % 3 = 1 AND clean_location <> '' THEN 'description' WHEN calendar_type = 'baronial' AND NOT is_virtual THEN 'vague' WHEN row_id % 3 = 2 THEN 'fallback' ELSE 'none' END AS step FROM listings""",
)
def resolve_location(spark, sf):
    third = F.expr("cast(row_id % 3 as int)")
    df = fx.listings(spark, sf).withColumns({"location": F.when(third == 0, F.col("clean_location")).when(third == 2, "TX").otherwise(""), "description": F.when((third == 1) & (F.col("clean_location") != ""), F.concat(F.lit("Held at "), "clean_location"))})
    groups = spark.createDataFrame([("Barony of Nowhere Atall", "Far, TX")], "group_name string, location string")
    places = spark.createDataFrame([("TX", "Texas, USA")], "key string, place string")
    return L.resolve_location(df, groups, places).select("row_id", "address", "step")


@query(
    "query_ladder",
    """, a AS (SELECT DISTINCT clean_location AS x, list_transform(string_split(clean_location, ','), lambda p: trim(p)) AS p FROM listings WHERE clean_location <> '')
SELECT x AS address, 0 AS rung, array_to_string(p, ', ') AS query FROM a UNION ALL SELECT x, 1, array_to_string(p[2:], ', ') FROM a WHERE len(p) > 2 UNION ALL SELECT x, 2, array_to_string(p[len(p) - 1:], ', ') FROM a WHERE len(p) > 2 UNION ALL SELECT x, 3, regexp_extract(x, '\\b\\d{5}\\b') FROM a""",
)
def query_ladder(spark, sf):
    a = fx.listings(spark, sf).where("clean_location <> ''").select(F.col("clean_location").alias("address")).distinct()
    return a.select("address", F.posexplode(L.query_ladder(F.col("address"))).alias("rung", "r")).select("address", "rung", F.col("r.query").alias("query"))


@query(
    "geocode_cache",
    """, a AS (SELECT DISTINCT clean_location AS x FROM listings WHERE clean_location <> ''), c AS (SELECT x, string_split(x, ', ') AS p, CAST(regexp_extract(x, '^\\d+') AS INT) AS n FROM a)
SELECT l.row_id, CASE WHEN c.n % 3 = 0 THEN 'ok' WHEN c.n % 3 = 1 THEN 'ok_retry' ELSE 'failed' END AS geo_status, CAST(CASE WHEN c.n % 3 = 0 THEN c.n WHEN c.n % 3 = 1 THEN 50.0 END AS DOUBLE) AS geo_lat FROM listings l LEFT JOIN c ON l.clean_location = c.x""",
)
def geocode_cache(spark, sf):
    df = fx.listings(spark, sf)
    a = df.where("clean_location <> ''").select("clean_location").distinct().withColumn("n", F.regexp_extract("clean_location", r"^\d+", 0).try_cast("int"))
    whole = a.select(F.col("clean_location").alias("query"), F.when(F.col("n") % 3 == 0, F.col("n").cast("double")).alias("lat"), F.lit(0.0).alias("lng"))
    tail = a.where("n % 3 = 1").select(F.array_join(F.slice(F.split("clean_location", ", "), 2, 10), ", ").alias("query"), F.lit(50.0).alias("lat"), F.lit(0.0).alias("lng"))
    return L.geocode_from_cache(df, whole.unionByName(tail), F.lit(True)).select("row_id", "geo_status", "geo_lat")


@query("geocode_worklist", f", p AS ({_PRIOR}) SELECT lower(trim(clean_location)) AS query, count(*) AS listings FROM p WHERE geocode_status IN ('', 'failed') AND trim(clean_location) <> '' AND NOT contains(clean_location, 'Main St, NATION_1,') GROUP BY ALL ORDER BY listings DESC, query LIMIT 20")
def geocode_worklist(spark, sf):
    df = _prior(fx.listings(spark, sf))
    cache = df.where("clean_location like '%Main St, NATION_1,%'").select(F.col("clean_location").alias("query"))
    return L.geocode_worklist(df, cache, 20, retry_failed=True)


@query("local_fallback_pins", ", g AS (SELECT lower(regexp_replace(group_name, '[^A-Za-z0-9 ]', '', 'g')) AS k, lat, lng FROM groups_reg) SELECT l.row_id, CASE WHEN g.k IS NOT NULL THEN 'ok_fallback' ELSE '' END AS geocode_status, round(coalesce(g.lat, l.lat), 2) AS lat FROM listings l LEFT JOIN g ON g.k = lower(regexp_replace(l.source, '[^A-Za-z0-9 ]', '', 'g'))")
def local_fallback_pins(spark, sf):
    df = fx.listings(spark, sf).withColumns({"geocode_status": F.lit(""), "location_specificity": F.lit("vague")})
    return L.pin_local_fallback(df, fx.groups(spark, sf)).select("row_id", "geocode_status", F.round("lat", 2).alias("lat"))


@query("organizer_pins", ", g AS (SELECT min(struct_pack(lat := lat, lng := lng)) AS p FROM groups_reg WHERE group_name = (SELECT min(group_name) FROM groups_reg WHERE lat BETWEEN 24 AND 50)) SELECT row_id, CASE WHEN row_id % 4 = 0 THEN 'ok_organizer' ELSE '' END AS geocode_status, round(CASE WHEN row_id % 4 = 0 THEN (SELECT p.lat FROM g) ELSE lat END, 2) AS lat FROM listings")
def organizer_pins(spark, sf):
    groups = fx.groups(spark, sf)
    name = groups.where("lat between 24 and 50").agg(F.min("group_name").alias("organizer"))
    organizers = name.select(F.lit("u0").alias("url"), "organizer")
    df = fx.listings(spark, sf).withColumns({"event_url": F.concat(F.lit("u"), (F.col("row_id") % 4).cast("string")), "geocode_status": F.lit(""), "location_specificity": F.lit("vague")})
    return L.organizer_pin(df, organizers, groups, (24, 50, -125, -66)).select("row_id", "geocode_status", F.round("lat", 2).alias("lat"))


@query("nearest_group", """, m AS (SELECT l.row_id, g.group_id, 2 * 3958.7613 * asin(sqrt(least(1.0, pow(sin(radians(g.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(g.lat)) * pow(sin(radians(g.lng - l.lng) / 2), 2)))) AS miles FROM listings l JOIN groups_reg g ON abs(l.lat - g.lat) < 2.5),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY miles, group_id) AS rn FROM m WHERE miles <= 100) SELECT row_id, group_id AS site_id, round(miles, 3) AS miles FROM r WHERE rn = 1""")
def nearest_group(spark, sf):
    sites = fx.groups(spark, sf).select(F.col("group_id").alias("site_id"), "lat", "lng")
    return L.nearest(fx.listings(spark, sf), sites, 100).select("row_id", "site_id", F.round("miles", 3).alias("miles"))


@query("groups_in_view", "SELECT group_id FROM groups_reg WHERE lat BETWEEN 30 AND 40 AND lng BETWEEN -110 AND -80")
def groups_in_view(spark, sf):
    return G.nearest_groups(fx.groups(spark, sf), (30, 40, -110, -80)).select("group_id")


@query("local_online_view", "SELECT row_id FROM listings WHERE is_virtual AND (calendar_type = 'kingdom' OR source IN (SELECT 'Barony of ' || n_name FROM nation WHERE n_nationkey BETWEEN 5 AND 12))")
def local_online_view(spark, sf):
    seats = spark.read.parquet(f"{sf}/nation.parquet").select(F.concat(F.lit("Barony of "), "n_name").alias("group_name"), F.col("n_nationkey").cast("double").alias("lat"), F.lit(0.0).alias("lng"))
    return Q.local_online_in_view(fx.listings(spark, sf), seats, (5, 12, -1, 1)).select("row_id")


@query("coverage", "SELECT CAST(CAST(max(start_ts) AS DATE) AS VARCHAR) AS through FROM listings")
def coverage(spark, sf):
    return Q.coverage_horizon(fx.listings(spark, sf)).select(F.col("through").cast("string").alias("through"))


@query("known_overlap", f", k AS (SELECT row_id, source, CAST(start_ts AS DATE) AS d, {_NORM} AS t, {_VENUE} AS v FROM listings) SELECT a.source AS feed_id, b.source, count(DISTINCT a.row_id) AS shared FROM k a JOIN k b ON a.d = b.d AND a.t = b.t WHERE a.row_id % 5 = 0 AND b.row_id % 5 <> 0 AND (a.v = '' OR b.v = '' OR contains(a.v, b.v) OR contains(b.v, a.v) OR (regexp_extract(a.v, '^\\d+') = regexp_extract(b.v, '^\\d+') AND string_split(a.v, ' ')[2] = string_split(b.v, ' ')[2])) GROUP BY ALL")
def known_overlap(spark, sf):
    df = fx.listings(spark, sf)
    return D.overlap_with_known(df.where("row_id % 5 = 0").withColumn("feed_id", F.col("source")), df.where("row_id % 5 <> 0"))


@query("modal_dates", ", c AS (SELECT source, CAST(start_ts AS DATE) AS a, CAST(end_ts AS DATE) AS b, count(*) AS n FROM listings GROUP BY ALL), r AS (SELECT *, rank() OVER (PARTITION BY source ORDER BY n DESC) AS r FROM c) SELECT source, CAST(a AS VARCHAR) AS first_day, CAST(b AS VARCHAR) AS last_day, n FROM r WHERE r = 1")
def modal_dates(spark, sf):
    return D.modal_dates(fx.listings(spark, sf), ["source"]).select("source", F.col("d1").cast("string").alias("first_day"), F.col("d2").cast("string").alias("last_day"), "n")


@query("unique_occurrences", ", r AS (SELECT row_id, row_number() OVER (PARTITION BY title, CAST(start_ts AS DATE) ORDER BY row_id) AS rn, substr(sha256(title || '|' || CAST(CAST(start_ts AS DATE) AS VARCHAR)), 1, 16) AS listing_id FROM listings) SELECT row_id, listing_id FROM r WHERE rn = 1")
def unique_occurrences(spark, sf):
    return D.dedupe_across_pages(fx.listings(spark, sf).withColumn("day", F.to_date("start_ts")), ["title", "day"]).select("row_id", "listing_id")


@query("silent_feeds", "SELECT source, 'none' AS finding FROM (SELECT DISTINCT source FROM listings) WHERE source NOT IN (SELECT source FROM listings WHERE start_ts < TIMESTAMP '1992-01-15') UNION ALL SELECT source, 'silent' FROM listings WHERE calendar_type = 'baronial' AND source NOT IN (SELECT source FROM listings WHERE start_ts < TIMESTAMP '1992-01-15') GROUP BY source HAVING count(*) >= 10")
def silent_feeds(spark, sf):
    df = fx.listings(spark, sf)
    now = df.where("start_ts < timestamp_ntz'1992-01-15'")
    return H.zero_feeds(df, now).select("source", F.lit("none").alias("finding")).unionByName(H.local_silent(now, df).select("source", F.lit("silent").alias("finding")))


@query("total_drop", "SELECT (SELECT count(*) FROM listings WHERE row_id % 3 = 0) AS now, count(*) AS before, (SELECT count(*) FROM listings WHERE row_id % 3 = 0) <= count(*) * 0.7 AS alarm FROM listings")
def total_drop(spark, sf):
    df = fx.listings(spark, sf)
    return H.total_drop(df.where("row_id % 3 = 0"), df)


@query("stale_files", "SELECT source AS file, CASE WHEN max(start_ts) FILTER (WHERE row_id % 2 = 0) < TIMESTAMP '2001-11-20' THEN 'not updated' ELSE 'runs out' END AS reason FROM listings GROUP BY source HAVING CAST(max(start_ts) FILTER (WHERE row_id % 2 = 0) AS DATE) < DATE '2001-12-20' - 30 OR CAST(max(start_ts) AS DATE) < DATE '2001-12-20' + 30")
def stale_files(spark, sf):
    df = fx.listings(spark, sf).select(F.col("source").alias("file"), F.expr("case when row_id % 2 = 0 then start_ts end").alias("stamp"), "start_ts")
    return H.stale_files(df, "2001-12-20").select("file", "reason")


@query("sample_titles", ", r AS (SELECT source, title, row_number() OVER (PARTITION BY source ORDER BY start_ts, row_id) AS rn FROM listings) SELECT source, string_agg(title, '|' ORDER BY rn) AS sample FROM r WHERE rn <= 3 GROUP BY source")
def sample_titles(spark, sf):
    return H.samples(fx.listings(spark, sf), "source").select("source", F.array_join("sample", "|").alias("sample"))


@query("state_snapshot", "SELECT calendar_type, source, count(*) AS n, 'run-1' AS run_id FROM listings GROUP BY calendar_type, source")
def state_snapshot(spark, sf):
    return H.state_snapshot(fx.listings(spark, sf), "run-1")


@query("fetch_summary", "SELECT source, count(*) AS events, count(*) FILTER (WHERE is_virtual) AS online, count(*) FILTER (WHERE clean_location = '') AS unplaced FROM listings GROUP BY source UNION ALL SELECT group_name, 0, 0, 0 FROM groups_reg")
def fetch_summary(spark, sf):
    df = fx.listings(spark, sf)
    registry = df.select("source").unionByName(fx.groups(spark, sf).select(F.col("group_name").alias("source")))
    return S.fetch_summary(registry, df)


@query("feed_registry", "SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS feed_id, 'Kingdom of ' || r_name AS source, 'kingdom' AS calendar_type FROM region UNION ALL SELECT 'g' || CAST(group_id AS VARCHAR), 'Shire of ' || group_name, 'baronial' FROM groups_reg WHERE group_id % 5 <> 0")
def feed_registry(spark, sf):
    r = spark.read.parquet(f"{sf}/region.parquet").select(F.concat(F.lit(" r"), F.col("r_regionkey").cast("string")).alias("id"), F.concat(F.lit("Kingdom of "), "r_name").alias("source"), F.lit("Kingdom ").alias("type"))
    g = fx.groups(spark, sf).select(F.when(F.expr("group_id % 5 = 0"), "none").otherwise(F.concat(F.lit("g"), F.col("group_id").cast("string"))).alias("calendar_id"), F.lit("Shire").alias("type"), F.col("group_name").alias("group"), F.lit(False).alias("is_aggregator"))
    return S.feed_registry(r, g).select("feed_id", "source", "calendar_type")


@query("calendar_text", "SELECT row_id, title, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS start_day, clean_location AS location FROM listings WHERE row_id % 3 <> 0")
def calendar_text(spark, sf):
    """Listings written as calendar files into the shared folder, and read back; a third without a start are rejects."""
    import uuid

    folder = f"{shared_folder(spark)}/ics-{uuid.uuid4().hex}"
    escaped = lambda c: F.replace(F.col(c), F.lit(","), F.lit("\\,"))
    start = F.when(F.expr("row_id % 3 <> 0"), F.concat(F.lit("DTSTART:"), F.date_format("start_ts", "yyyyMMdd'T'HHmmss"), F.lit("\n"))).otherwise("")
    event = F.concat(F.lit("BEGIN:VEVENT\nUID:"), F.col("row_id").cast("string"), F.lit("\n"), start, F.lit("SUMMARY:"), escaped("title"), F.lit("\nLOCATION:"), escaped("clean_location"), F.lit("\nEND:VEVENT"))
    files = fx.listings(spark, sf).groupBy("source", F.year("start_ts"), F.month("start_ts")).agg(F.array_join(F.collect_list(event), "\n").alias("events"))
    # one file for a feed and month, each within a row of the text file
    text = files.select(F.concat(F.lit("BEGIN:VCALENDAR\n"), "events", F.lit("\nEND:VCALENDAR")).alias("value"))
    text.repartition(64).write.text(folder)
    events, _ = S.read_ics(spark, folder)
    return events.select(F.col("uid").cast("long").alias("row_id"), "title", F.to_date("start_ts").cast("string").alias("start_day"), F.coalesce("location", F.lit("")).alias("location"))


@query("date_ranges", "SELECT row_id, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS first_day, CAST(CAST(end_ts AS DATE) AS VARCHAR) AS last_day FROM listings")
def date_ranges(spark, sf):
    day = lambda c: F.date_format(c, "MMM d yyyy")
    text = F.when(F.to_date("start_ts") == F.to_date("end_ts"), day("start_ts")).otherwise(F.concat(day("start_ts"), F.lit(" - "), day("end_ts")))
    df = fx.listings(spark, sf).select("row_id", S.parse_date_range(text).alias("d"))
    return df.select("row_id", F.col("d.first").cast("string").alias("first_day"), F.col("d.last").cast("string").alias("last_day"))


@query("page_list_events", """SELECT 'Fair ' || CAST(page_id AS VARCHAR) AS title, CAST(DATE '2026-01-01' + CAST(page_id % 90 AS INT) AS VARCHAR) AS start_day, page_id FROM pages""", raw=True)
def page_list_events(spark, sf):
    p = fx.table(spark, sf, "pages")
    line = F.concat(F.lit("<li>"), F.date_add(F.lit("2026-01-01").cast("date"), F.expr("cast(page_id % 90 as int)")).cast("string"), F.lit(": Fair "), F.col("page_id").cast("string"), F.lit("</li>"))
    events, _ = S.page_events(p.withColumn("html", F.concat("html", line)), "list")
    return events.select("title", F.to_date("start_ts").cast("string").alias("start_day"), "page_id")


@query("body_kinds", "SELECT page_id, CASE CAST(page_id % 4 AS INT) WHEN 0 THEN 'ics' WHEN 1 THEN 'json' WHEN 2 THEN 'empty' ELSE 'html' END AS kind FROM pages", raw=True)
def body_kinds(spark, sf):
    p = fx.table(spark, sf, "pages")
    body = F.when(F.expr("page_id % 4 = 0"), F.concat(F.lit("BEGIN:VCALENDAR\n"), "html")).when(F.expr("page_id % 4 = 1"), F.concat(F.lit("{"), "html")).when(F.expr("page_id % 4 = 2"), "").otherwise(F.concat(F.lit("<html>"), "html"))
    return p.select("page_id", S.body_kind(body)["kind"].alias("kind"))


@query("assign_feeds", f"{_CANDIDATES}, b AS (SELECT page_id AS group_id, max(feed) AS feed FROM cand GROUP BY page_id) SELECT feed, min(group_id) AS group_id FROM b GROUP BY feed")
def assign_feeds(spark, sf):
    c = N.feed_candidates(fx.pages(spark, sf)).select(F.col("page_id").alias("group_id"), "feed", F.lit("own").alias("verdict"), F.lit(1).alias("upcoming"), F.lit(1).alias("with_location"))
    return N.assign_feeds(c)


@query("rejected_feeds", f"{_CANDIDATES} SELECT page_id, feed, CASE WHEN feed IN ('grp1@group.calendar.google.com', 'grp7@group.calendar.google.com') THEN 'by hand' END AS reason FROM cand")
def rejected_feeds(spark, sf):
    c = N.feed_candidates(fx.pages(spark, sf)).select("page_id", "feed")
    rejected = spark.createDataFrame([("grp1@group.calendar.google.com",), ("grp7@group.calendar.google.com",)], "id string").select(F.sha2("id", 256).alias("fingerprint"), F.lit("by hand").alias("reason"))
    return X.reject_feeds(c, rejected, N.feed_key(F.col("feed")))


@query("located_groups", "SELECT s_suppkey AS group_id, 'County ' || CAST(s_nationkey AS VARCHAR) AS location FROM supplier", raw=True)
def located_groups(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("group_id"), F.format_string("Shire of Mark%06d", F.col("s_suppkey")).alias("group_name"), "s_nationkey")
    # many groups on a page, one line each
    line = F.concat(F.lit("<p>The "), "group_name", F.lit(" is located in County "), F.col("s_nationkey").cast("string"), F.lit(". Welcome.</p>"))
    pages = s.select(F.col("group_id").alias("page_id"), line.alias("html"))
    return N.group_regions(pages, s)


@query("cached_texts", "SELECT url, max_by(t, ts) AS text_key, max(ts) AS ts FROM (SELECT url, 'p' || CAST(page_id AS VARCHAR) AS t, page_id AS ts FROM pages WHERE page_id % 4 <> 0) GROUP BY url", raw=True)
def cached_texts(spark, sf):
    p = fx.table(spark, sf, "pages")
    text = F.when(F.expr("page_id % 4 = 0"), "short").otherwise(F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(" and more than twenty letters")))
    rows = p.select("url", text.alias("text"), F.col("page_id").alias("ts"))
    return J.upsert_cache(rows.where("ts % 2 = 0"), rows.where("ts % 2 = 1")).select("url", F.substring_index("text", " ", 1).alias("text_key"), "ts")


@query("enriched", ", d AS (SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'page of ' || source || ' with enough text' ELSE 'own' END AS description FROM listings) SELECT row_id, description FROM d")
def enriched(spark, sf):
    df = fx.listings(spark, sf).withColumns({"event_url": F.col("source"), "description": F.when(F.expr("row_id % 2 = 0"), "TBA").otherwise("own")})
    pages = df.select(F.col("source").alias("url"), F.concat(F.lit("page of "), "source", F.lit(" with enough text")).alias("text"), F.lit(1).alias("ts")).distinct()
    return J.enrich_descriptions(df, pages, F.col("description") == "TBA").select("row_id", "description")


@query("replaced_regions", "SELECT row_id, FALSE AS fresh FROM listings WHERE kingdom <> 'Kingdom of ASIA' UNION ALL SELECT row_id, TRUE FROM listings WHERE kingdom = 'Kingdom of ASIA' AND row_id % 2 = 0")
def replaced_regions(spark, sf):
    df = fx.listings(spark, sf)
    new = df.where("kingdom = 'Kingdom of ASIA' and row_id % 2 = 0").withColumn("fresh", F.lit(True))
    return J.replace_partitions(df.withColumn("fresh", F.lit(False)), new, ["kingdom"]).select("row_id", "fresh")


@query("scrubbed", "SELECT row_id, replace(clean_location, '103 Main St', '[private]') AS clean_location, contains(clean_location, '103 Main St') AS private FROM listings")
def scrubbed(spark, sf):
    rules = spark.createDataFrame([("103 Main St",)], "p string").select(X.phrase_fingerprint("p").alias("f"), F.lit("").alias("scope"), F.lit("[private]").alias("replace_with"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng")).select("f.*", "scope", "replace_with", "lat", "lng")
    return X.scrub_private(fx.listings(spark, sf), rules, ["clean_location"]).select("row_id", "clean_location", (F.col("privacy") == "private").alias("private"))
