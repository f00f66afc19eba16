"""Queries that apply the operators to the given tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
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
from fairweave.operators import rules as C
from fairweave.operators import serve as Q
from fairweave.operators import state as J
from fairweave.operators.names import find_names
from fairweave.operators.store import stored
from fairweave.plans import fixtures as fx
from fairweave.plans.pipeline import real_listings
from fairweave.sources import feeds as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_WITH = f"WITH listings AS ({fx.plain(fx.LISTINGS)}), edges AS ({fx.plain(fx.EDGES)}), groups_reg AS ({fx.plain(fx.GROUPS)}), pages_x AS ({fx.plain(fx.PAGES)})"
_NON_EVENT = "regexp_matches(trim(title), '(?i)" + "|".join(P.NON_EVENT).replace("'", "''") + "')"
_REAL = f"SELECT * FROM listings WHERE NOT {_NON_EVENT} AND NOT regexp_matches(title, '(?i)\\bcancell?ed\\b') AND CAST(end_ts AS DATE) >= DATE '1998-01-01'"
_NORM = "trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))"
_DEDUP = "SELECT *, row_number() OVER (PARTITION BY CAST(start_ts AS DATE), lower(trim(clean_location)), calendar_type ORDER BY CASE WHEN lower(title) LIKE '%out of kingdom%' THEN 1 ELSE 0 END, CASE WHEN source = kingdom THEN 0 ELSE 1 END, row_id) AS rn FROM listings WHERE clean_location <> '' AND NOT is_virtual"


def query(name: str, sql: str | None, raw: bool = False):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql if raw else f"{_WITH} {sql}" if not sql.lstrip().upper().startswith(",") else f"{_WITH}{sql}"
        return f

    return add


def _day(c: str) -> F.Column:
    return F.to_date(c).cast("string")


@query("upcoming_real", f"SELECT row_id, title, source FROM ({_REAL})")
def upcoming_real(spark, sf):
    return real_listings(fx.listings(spark, sf), "1998-01-01").select("row_id", "title", "source")


@query("dedup_listings", f"SELECT source, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM (SELECT source, row_id FROM ({_DEDUP}) WHERE rn = 1 UNION ALL SELECT source, row_id FROM listings WHERE NOT (clean_location <> '' AND NOT is_virtual)) GROUP BY source")
def dedup_listings(spark, sf):
    return D.dedupe_listings(fx.listings(spark, sf)).groupBy("source").agg(F.count("*").alias("n"), F.sum("row_id").alias("ids"))


@query("dedup_audit", f"SELECT row_id, source, calendar_type FROM ({_DEDUP}) WHERE rn > 1")
def dedup_audit(spark, sf):
    df = fx.listings(spark, sf)
    return df.join(D.dedupe_listings(df).select("row_id"), "row_id", "left_anti").select("row_id", "source", "calendar_type")


@query(
    "virtual_flags",
    """, t AS (SELECT row_id, CASE CAST(row_id % 7 AS INT) WHEN 0 THEN title || ' with livestream' WHEN 1 THEN title || ' (Google Meet)' WHEN 2 THEN title || ' on Microsoft Teams' ELSE title END AS title,
  CASE CAST(row_id % 5 AS INT) WHEN 0 THEN 'Discord server' WHEN 1 THEN 'Via GoogleMeet' WHEN 2 THEN '' WHEN 3 THEN 'Webex Hall, 5 Main St' ELSE clean_location END AS place,
  CASE CAST(row_id % 3 AS INT) WHEN 0 THEN 'Register online' ELSE 'Posted to our Discord' END AS told FROM listings)
SELECT row_id, regexp_matches(lower(title), 'virtual|online|zoom|google ?meet|meet\\.google\\.com|microsoft teams|teams\\.microsoft\\.com') OR place IN ('Discord server', 'Via GoogleMeet') OR (place = '' AND told = 'Register online') AS online FROM t""",
)
def virtual_flags(spark, sf):
    df = fx.listings(spark, sf)
    title = F.expr("case cast(row_id % 7 as int) when 0 then concat(title, ' with livestream') when 1 then concat(title, ' (Google Meet)') when 2 then concat(title, ' on Microsoft Teams') else title end")
    place = F.expr("case cast(row_id % 5 as int) when 0 then 'Discord server' when 1 then 'Via GoogleMeet' when 2 then '' when 3 then 'Webex Hall, 5 Main St' else clean_location end")
    told = F.expr("case cast(row_id % 3 as int) when 0 then 'Register online' else 'Posted to our Discord' end")
    return df.select("row_id", P.is_virtual(title, place, told).alias("online"))


_SERIES = """, d AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS d FROM events),
g AS (SELECT user_id, event_type, d, CAST(date_diff('day', lag(d) OVER w, d) AS INT) AS gap FROM d WINDOW w AS (PARTITION BY user_id, event_type ORDER BY d)),
a AS (SELECT user_id, event_type, count(*) AS n, min(gap) AS lo, max(gap) AS hi, avg(gap) AS mean, list_sort(list(gap) FILTER (WHERE gap IS NOT NULL)) AS gaps FROM g GROUP BY user_id, event_type),
r AS (SELECT *, n >= 2 AND (
  (len(list_filter(gaps, lambda x: abs(x - mean) > 3)) = 0 AND mean BETWEEN 6 AND 32)
  OR (lo BETWEEN 6 AND 32 AND len(list_filter(gaps, lambda x: NOT (abs(x - lo) <= (CASE WHEN lo < 20 THEN 2 ELSE 3 END) OR abs(x - 2 * lo) <= (CASE WHEN lo < 20 THEN 2 ELSE 3 END) OR abs(x - 3 * lo) <= (CASE WHEN lo < 20 THEN 2 ELSE 3 END)))) = 0)
  OR (n >= 3 AND gaps[CAST(floor(len(gaps) / 2.0) AS INT) + 1] BETWEEN 2 AND 16 AND hi <= 21)) AS recurring FROM a)"""


def _series(spark, sf):
    d = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_type", F.to_date("ts").alias("d")).distinct()
    return d.groupBy("user_id", "event_type").agg(F.sort_array(F.collect_list("d")).alias("dates"))


@query("series_detect", f"{_SERIES} SELECT user_id, event_type, n, coalesce(recurring, FALSE) AS recurring FROM r")
def series_detect(spark, sf):
    return _series(spark, sf).select("user_id", "event_type", F.size("dates").cast("long").alias("n"), D.is_recurring(F.col("dates")).alias("recurring"))


@query(
    "series_merge",
    f"""{_SERIES}, x AS (SELECT user_id, event_type, list_sort(list(d)) AS ds FROM d GROUP BY user_id, event_type)
SELECT e.user_id, e.event_type, CAST(e.d AS VARCHAR) AS first_day, CASE WHEN r.recurring THEN least(8, r.n) ELSE 0 END AS shown,
 CASE WHEN r.recurring THEN 'Come. [RECURRING — also on: ' || array_to_string(list_transform(ds[1:8], lambda v: strftime(v, '%-d %b %Y')), ', ') || CASE WHEN len(ds) > 8 THEN ', … ' || CAST(len(ds) - 8 AS VARCHAR) || ' more through ' || strftime(ds[-1], '%-d %b %Y') ELSE '' END || ']' ELSE 'Come. ' END AS description
FROM d e JOIN r USING (user_id, event_type) JOIN x USING (user_id, event_type) WHERE NOT coalesce(r.recurring, FALSE) OR e.d = (SELECT min(x.d) FROM d x WHERE x.user_id = e.user_id AND x.event_type = e.event_type)""",
)
def series_merge(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_type", F.to_date("ts").alias("d")).distinct()
    rows = e.select(F.xxhash64("user_id", "event_type", "d").alias("row_id"), F.concat_ws(" ", F.col("event_type").cast("string"), F.col("user_id").cast("string")).alias("title"), F.col("d").cast("timestamp_ntz").alias("start_ts"), F.col("user_id").cast("string").alias("source"), F.lit("here").alias("clean_location"), F.lit("Come. ").alias("description"), "user_id", "event_type")
    return D.merge_series(rows).select("user_id", "event_type", _day("start_ts").alias("first_day"), F.coalesce(F.size("series_dates"), F.lit(0)).cast("long").alias("shown"), "description")


_TOK = "list_distinct(list_transform(list_filter(string_split(" + _NORM + ", ' '), lambda w: w <> '' AND NOT list_contains(['" + "','".join(T.STOP_WORDS) + "'], w)), lambda w: CASE WHEN length(w) > 3 AND suffix(w, 's') THEN left(w, length(w) - 1) ELSE w END))"
_VENUE = "trim(regexp_replace(lower(clean_location), '[^a-z0-9]+', ' ', 'g'))"
_COPY = """(a.v = '' OR b.v = '' OR contains(a.v, b.v) OR contains(b.v, a.v) OR (regexp_extract(a.v, '^\\d+') <> '' AND regexp_extract(a.v, '^\\d+') = regexp_extract(b.v, '^\\d+') AND coalesce(string_split(a.v, ' ')[2], '') = coalesce(string_split(b.v, ' ')[2], '')))
  AND len(list_intersect(a.t, b.t)) > 0 AND len(list_intersect(a.t, b.t)) * 2 >= greatest(len(a.t), len(b.t))"""


@query(
    "local_copies",
    f", k AS (SELECT row_id, calendar_type, CAST(start_ts AS DATE) AS d, {_TOK} AS t, {_VENUE} AS v, trim(clean_location) <> '' AND NOT is_virtual AS placed FROM listings) SELECT a.row_id FROM k a WHERE NOT (a.placed AND a.calendar_type = 'baronial' AND EXISTS (SELECT 1 FROM k b WHERE b.placed AND b.calendar_type = 'kingdom' AND b.d = a.d AND {_COPY}))",
)
def local_copies(spark, sf):
    return D.drop_local_copies(fx.listings(spark, sf)).select("row_id")


@query(
    "aggregator_copies",
    f", k AS (SELECT row_id, row_id % 10 = 0 AS agg, CAST(start_ts AS DATE) AS d, {_TOK} AS t, {_VENUE} AS v FROM listings) SELECT a.row_id FROM k a WHERE NOT (a.agg AND EXISTS (SELECT 1 FROM k b WHERE NOT b.agg AND b.d = a.d AND {_COPY}))",
)
def aggregator_copies(spark, sf):
    return D.drop_aggregator_copies(fx.listings(spark, sf).withColumn("is_aggregator", F.expr("row_id % 10 = 0"))).select("row_id")


_WARS = [(1, "Gulf Wars", ["gulf wars"], "Kingdom of ASIA", "Gulf site", 31.5, -89.25, "https://gulf.example.org", None, None, None, None), (2, "Lilies War", ["lilies war"], "Kingdom of EUROPE", "Lilies site", 39.0, -94.5, "", 6, 1, 6, 30)]


def _events(spark):
    return spark.createDataFrame(_WARS, "event_seq int, name string, keywords array<string>, host string, place string, lat double, lng double, website string, from_month int, from_day int, to_month int, to_day int")


@query(
    "marquee_merge",
    f""", w AS (SELECT * FROM (VALUES (1, 'gulf wars', 'Kingdom of ASIA', 'Gulf site', 31.5, -89.25, 'https://gulf.example.org'), (2, 'lilies war', 'Kingdom of EUROPE', 'Lilies site', 39.0, -94.5, '')) AS t(seq, kw, host, place, wla, wln, site)),
told AS (SELECT row_id, repeat('word ', CAST(row_id % 13 AS INT)) || CAST(row_id AS VARCHAR) AS description, 'https://own.example.org/' || CAST(row_id AS VARCHAR) AS event_url FROM listings),
m AS (SELECT l.*, w.seq, w.host, w.place, w.wla, w.wln, w.site, year(start_ts) AS y, CAST(start_ts AS DATE) AS s, CAST(end_ts AS DATE) AS e FROM listings l JOIN w ON contains(' ' || {_NORM} || ' ', ' ' || w.kw || ' ') WHERE date_diff('second', start_ts, end_ts) / 86400.0 >= 3),
k AS (SELECT * FROM m WHERE calendar_type = 'kingdom'),
n AS (SELECT seq, y, s, e, rank() OVER (PARTITION BY seq, y ORDER BY count(*) DESC) AS r FROM k GROUP BY seq, y, s, e),
c AS (SELECT k.*, row_number() OVER (PARTITION BY k.seq, k.y ORDER BY CASE WHEN k.source = k.host THEN 0 WHEN n.seq IS NOT NULL THEN 1 ELSE 2 END, CASE WHEN k.source <> k.host THEN k.start_ts END, k.row_id) AS rn
  FROM k LEFT JOIN n ON n.r = 1 AND n.seq = k.seq AND n.y = k.y AND n.s = k.s AND n.e = k.e),
ch AS (SELECT * FROM c WHERE rn = 1),
mem AS (SELECT seq, y, row_id, source FROM k UNION ALL SELECT ch.seq, ch.y, m.row_id, m.source FROM m JOIN ch ON m.seq = ch.seq AND m.s <= ch.e AND m.e >= ch.s WHERE m.calendar_type <> 'kingdom'),
cnt AS (SELECT seq, y, count(DISTINCT row_id) AS merged, count(DISTINCT source) AS sources, arg_max(description, (length(description), -row_id)) AS description FROM mem JOIN told USING (row_id) GROUP BY seq, y)
SELECT ch.row_id, ch.host AS source, ch.place AS clean_location, cnt.merged, cnt.sources, CAST(ch.wla AS DOUBLE) AS lat, CAST(ch.wln AS DOUBLE) AS lng, CASE WHEN ch.site <> '' THEN ch.site ELSE told.event_url END AS event_url, cnt.description, 'override' AS geocode_status FROM ch JOIN cnt ON ch.seq = cnt.seq AND ch.y = cnt.y JOIN told ON told.row_id = ch.row_id
UNION ALL SELECT l.row_id, l.source, l.clean_location, 1, 1, l.lat, l.lng, told.event_url, told.description, 'ok' FROM listings l JOIN told ON told.row_id = l.row_id WHERE l.row_id NOT IN (SELECT row_id FROM mem)""",
)
def marquee_merge(spark, sf):
    own = {"description": F.expr("concat(repeat('word ', cast(row_id % 13 as int)), cast(row_id as string))"), "event_url": F.expr("concat('https://own.example.org/', cast(row_id as string))"), "geocode_status": F.lit("ok")}
    return D.marquee_merge(stored(fx.listings(spark, sf).withColumns(own), "listings"), _events(spark)).select("row_id", "source", "clean_location", "merged", "sources", "lat", "lng", "event_url", "description", "geocode_status")


@query(
    "marquee_placeholders",
    """SELECT seq AS event_seq, name, CAST(make_date(y, 6, 1) AS VARCHAR) AS start_day, CAST(make_date(y, 6, 30) AS VARCHAR) AS end_day
FROM (VALUES (2, 'Lilies War', 'lilies war')) AS w(seq, name, kw), (SELECT max(year(start_ts)) AS y FROM listings UNION ALL SELECT max(year(start_ts)) + 1 FROM listings)
WHERE NOT EXISTS (SELECT 1 FROM listings WHERE contains(lower(title), kw) AND year(start_ts) = y)""",
)
def marquee_placeholders(spark, sf):
    """As of the first day of the last year that has listings."""
    df = fx.listings(spark, sf)
    years = df.select("title", F.year("start_ts").alias("year")).distinct()
    texts = years.select(F.struct("title", "year").alias("text_id"), T.normalize_title("title").alias("text"))
    named = find_names(texts, _events(spark).select(F.col("event_seq").alias("name_id"), F.explode("keywords").alias("name"))).select(F.col("name_id").alias("event_seq"), "text_id.year")
    last = df.agg(F.max(F.year("start_ts"))).first()[0]
    return D.placeholders(_events(spark), named, f"{last}-01-01").select("event_seq", "name", F.col("start_date").cast("string").alias("start_day"), F.col("end_date").cast("string").alias("end_day"))


_PRIOR = "SELECT *, CASE CAST(row_id % 4 AS INT) WHEN 0 THEN 'ok' WHEN 1 THEN 'failed' WHEN 2 THEN 'cached' ELSE '' END AS geocode_status FROM listings WHERE row_id % 5 <> 0"


def _prior(df):
    return df.where("row_id % 5 <> 0").withColumn("geocode_status", F.expr("case cast(row_id % 4 as int) when 0 then 'ok' when 1 then 'failed' when 2 then 'cached' else '' end"))


@query(
    "carry_pins",
    f", p AS ({_PRIOR}), f AS (SELECT title, start_ts, clean_location, lat, lng, geocode_status, row_number() OVER (PARTITION BY title, start_ts, clean_location ORDER BY row_id) AS rn FROM p) SELECT l.row_id, f.lat AS pin_lat, f.lng AS pin_lng, f.geocode_status AS pin_status FROM listings l LEFT JOIN f ON f.rn = 1 AND l.title = f.title AND l.start_ts = f.start_ts AND l.clean_location = f.clean_location",
)
def carry_pins(spark, sf):
    df = fx.listings(spark, sf)
    return J.carry_pins(df, _prior(df)).select("row_id", "pin_lat", "pin_lng", "pin_status")


@query(
    "carry_forward",
    f", p AS ({_PRIOR}), cur AS (SELECT * FROM listings WHERE row_id % 7 <> 0) SELECT row_id, FALSE AS carried FROM cur UNION ALL SELECT row_id, TRUE FROM p WHERE source = 'Kingdom of ASIA' AND CAST(start_ts AS DATE) >= DATE '1996-01-01' AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.source = p.source AND cur.title = p.title AND cur.start_ts = p.start_ts)",
)
def carry_forward(spark, sf):
    df = fx.listings(spark, sf)
    failed = spark.createDataFrame([("Kingdom of ASIA",)], "source string")
    return J.carry_forward(df.where("row_id % 7 <> 0"), _prior(df).drop("geocode_status"), failed, "1996-01-01").select("row_id", "carried")


_RULES = [(1, "", "Kingdom of ASIA", "Harvest Feast", None, "1 New Rd, Town, TX 75001", None, None, ""), (2, "", "Kingdom of ASIA", "harvest feast!", None, "", 40.5, -80.25, ""), (3, "", "Kingdom of EUROPE", "Lilies War", None, "", 99.0, 0.0, "https://example.org/l"), (4, "https://example.org/7", "", "", None, "Hall 7", None, None, "")]
_RULES_SQL = ", r AS (SELECT * FROM (VALUES (1, '', 'Kingdom of ASIA', 'harvest feast', '1 New Rd, Town, TX 75001', NULL, NULL, ''), (2, '', 'Kingdom of ASIA', 'harvest feast', '', 40.5, -80.25, ''), (3, '', 'Kingdom of EUROPE', 'lilies war', '', NULL, NULL, 'https://example.org/l'), (4, 'https://example.org/7', '', '', 'Hall 7', NULL, NULL, '')) AS t(seq, url, src, tt, addr, la, ln, link))"


def _linked(df):
    return df.withColumn("event_url", F.concat(F.lit("https://example.org/"), (F.col("row_id") % 50).cast("string")))


@query(
    "event_rules",
    f"""{_RULES_SQL}, l AS (SELECT *, 'https://example.org/' || CAST(row_id % 50 AS VARCHAR) AS event_url FROM listings),
h AS (SELECT l.row_id, r.* FROM l JOIN r ON (r.url <> '' AND r.url = l.event_url) OR (r.url = '' AND r.src = l.source AND r.tt = {_NORM})),
w AS (SELECT row_id, count(DISTINCT seq) AS n_rules, max_by(addr, seq) FILTER (WHERE addr <> '') AS addr, max_by(la, seq) FILTER (WHERE la IS NOT NULL) AS la, max_by(ln, seq) FILTER (WHERE la IS NOT NULL) AS ln, max_by(link, seq) FILTER (WHERE link <> '') AS link FROM h GROUP BY row_id)
SELECT l.row_id, coalesce(w.addr, l.clean_location) AS clean_location, CAST(CASE WHEN w.la IS NOT NULL THEN w.la WHEN w.addr IS NULL THEN l.lat END AS DOUBLE) AS lat, CAST(CASE WHEN w.la IS NOT NULL THEN w.ln WHEN w.addr IS NULL THEN l.lng END AS DOUBLE) AS lng, coalesce(w.link, l.event_url) AS event_url, CASE WHEN w.la IS NOT NULL THEN 'override' END AS pin_status, coalesce(w.n_rules, 0) AS n_rules FROM l LEFT JOIN w ON l.row_id = w.row_id""",
)
def event_rules(spark, sf):
    rules = spark.createDataFrame(_RULES, "rule_seq int, url string, source string, title string, on_date date, address string, lat double, lng double, link string")
    return C.apply_event_rules(_linked(fx.listings(spark, sf)), rules).select("row_id", "clean_location", "lat", "lng", "event_url", "pin_status", "n_rules")


_KEYWORDS = [(1, "Kingdom of ASIA", "crown", 41.0, -81.0, "Crown site"), (2, "Kingdom of ASIA", "main st", 42.0, -82.0, ""), (3, "Kingdom of NOWHERE", "feast", 43.0, -83.0, ""), (4, "Kingdom of AFRICA", "no such word", 44.0, -84.0, "")]
_KEYWORDS_SQL = ", r AS (SELECT * FROM (VALUES (1, 'Kingdom of ASIA', 'crown', 41.0, -81.0, 'Crown site'), (2, 'Kingdom of ASIA', 'main st', 42.0, -82.0, ''), (3, 'Kingdom of NOWHERE', 'feast', 43.0, -83.0, ''), (4, 'Kingdom of AFRICA', 'no such word', 44.0, -84.0, '')) AS t(seq, src, kw, la, ln, addr))"


def _keyword_rules(spark):
    return spark.createDataFrame(_KEYWORDS, "rule_seq int, source string, keyword string, lat double, lng double, address string")


@query(
    "keyword_rules",
    f"{_KEYWORDS_SQL}, h AS (SELECT l.row_id, r.*, row_number() OVER (PARTITION BY l.row_id ORDER BY seq) AS rn FROM listings l JOIN r ON r.src = l.source AND contains(lower(title || ' ' || clean_location), kw)) SELECT l.row_id, CAST(coalesce(h.la, l.lat) AS DOUBLE) AS lat, CAST(coalesce(h.ln, l.lng) AS DOUBLE) AS lng, CASE WHEN h.addr <> '' THEN h.addr ELSE l.clean_location END AS clean_location, h.seq AS rule_seq FROM listings l LEFT JOIN h ON h.rn = 1 AND h.row_id = l.row_id",
)
def keyword_rules(spark, sf):
    return C.apply_keyword_rules(fx.listings(spark, sf), _keyword_rules(spark)).select("row_id", "lat", "lng", "clean_location", "rule_seq")


@query("unmatched_rules", f"{_KEYWORDS_SQL} SELECT seq AS rule_seq, kw AS keyword FROM r WHERE NOT EXISTS (SELECT 1 FROM listings l WHERE l.source = r.src AND contains(lower(title || ' ' || clean_location), kw))")
def unmatched_rules(spark, sf):
    return C.unmatched_rules(fx.listings(spark, sf), _keyword_rules(spark)).select("rule_seq", "keyword")


@query(
    "url_backfill",
    f", l AS (SELECT *, CASE WHEN row_id % 3 = 0 THEN 'https://example.org/' || CAST(row_id AS VARCHAR) ELSE '' END AS u FROM listings), k AS (SELECT source, {_NORM} AS t, min_by(u, row_id) AS u FROM l WHERE u <> '' GROUP BY ALL) SELECT l.row_id, CASE WHEN l.u <> '' THEN l.u ELSE coalesce(k.u, '') END AS event_url FROM l LEFT JOIN k ON k.source = l.source AND k.t = {_NORM}",
)
def url_backfill(spark, sf):
    df = fx.listings(spark, sf).withColumn("event_url", F.expr("case when row_id % 3 = 0 then concat('https://example.org/', cast(row_id as string)) else '' end"))
    return J.url_backfill(df, df.select("source", "title", F.col("event_url").alias("url"), F.col("row_id").alias("seq"))).select("row_id", "event_url")


_INSIDE = """, hit AS (SELECT la, ln, min(poly_id) AS poly_id, arg_min(kingdom, poly_id) AS territory FROM (
  SELECT p.la, p.ln, t.poly_id, t.kingdom, sum(CASE WHEN (t.y1 > p.la) <> (t.y2 > p.la) AND p.ln < (t.x2 - t.x1) * (p.la - t.y1) / (t.y2 - t.y1) + t.x1 THEN 1 ELSE 0 END) AS c
  FROM (SELECT DISTINCT round(lat, 4) AS la, round(lng, 4) AS ln FROM listings) p JOIN edges t ON p.la BETWEEN 24 + CAST(floor(t.poly_id / 5) AS INT) * 5.2 AND 29.2 + CAST(floor(t.poly_id / 5) AS INT) * 5.2
  GROUP BY p.la, p.ln, t.poly_id, t.kingdom) WHERE c % 2 = 1 GROUP BY la, ln)"""


@query(
    "territory_tag",
    f"{_INSIDE} SELECT l.row_id, coalesce(h.territory, '') AS host_kingdom, CASE WHEN calendar_type = 'kingdom' AND regexp_matches(title, '(?i)\\bwars?\\b') AND date_diff('second', start_ts, end_ts) / 86400.0 >= 5 THEN coalesce(h.territory, '') ELSE '' END AS war_host FROM listings l LEFT JOIN hit h ON round(l.lat, 4) = h.la AND round(l.lng, 4) = h.ln",
)
def territory_tag(spark, sf):
    return G.marquee_host(G.host_region(fx.listings(spark, sf), fx.territory_edges(spark, sf))).select("row_id", "host_kingdom", "war_host")


_BOXES = [(1, "TX", 25.7, 36.6, -106.7, -93.4), (2, "MS", 30.1, 35.1, -91.8, -87.9), (3, "PA", 39.6, 42.4, -80.6, -74.6), (4, "OH", 38.3, 42.1, -84.9, -80.4), (5, "CA", 32.4, 42.1, -124.5, -114.0)]
_BOXES_SQL = ", b AS (SELECT * FROM (VALUES " + ", ".join(map(str, _BOXES)) + ") AS t(ord, st, a, z, w, e)), s AS (SELECT row_id, min_by(st, ord) AS st FROM listings JOIN b ON lat BETWEEN a AND z AND lng BETWEEN w AND e GROUP BY row_id)"


def _boxes(spark):
    return spark.createDataFrame(_BOXES, "ord int, state string, lat_min double, lat_max double, lng_min double, lng_max double")


@query("bbox_state", f"{_BOXES_SQL} SELECT l.row_id, s.st AS box_state FROM listings l LEFT JOIN s ON l.row_id = s.row_id")
def bbox_state(spark, sf):
    return G.box_state(fx.listings(spark, sf), _boxes(spark)).select("row_id", "box_state")


@query(
    "validate_pins",
    f"""{_BOXES_SQL}, v AS (SELECT l.row_id, s.st, CASE WHEN s.st IS NULL THEN 'reject' WHEN n.st IS NOT NULL AND NOT (l.lat BETWEEN n.a AND n.z AND l.lng BETWEEN n.w AND n.e) THEN 'reject'
 WHEN l.source IN ('Kingdom of ASIA', 'Barony of CHINA') AND s.st NOT IN ('MS', 'TX') THEN CASE WHEN l.calendar_type = 'baronial' THEN 'reject' ELSE 'defer' END ELSE 'accept' END AS verdict
 FROM listings l LEFT JOIN s ON l.row_id = s.row_id LEFT JOIN b n ON n.st = nullif(regexp_extract(l.clean_location, ', ([A-Z]{{2}}) \\d{{5}}', 1), ''))
SELECT row_id, st AS box_state, verdict, verdict = 'reject' AS cleared FROM v""".replace("{{", "{").replace("}}", "}"),
)
def validate_pins(spark, sf):
    homes = spark.createDataFrame([("Kingdom of ASIA", ["MS", "TX"]), ("Barony of CHINA", ["MS", "TX"])], "source string, states array<string>")
    state = loc.state_from_address("clean_location", {"PA": "Pennsylvania", "TX": "Texas", "MS": "Mississippi", "OH": "Ohio", "CA": "California"})
    out = G.validate_pins(fx.listings(spark, sf), _boxes(spark), homes, state)
    return L.revalidate(out.withColumn("geocode_status", F.lit("ok"))).select("row_id", "box_state", "verdict", "cleared")


_MILES = "2 * 3958.7613 * asin(sqrt(least(1.0, pow(sin(radians(39.0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(39.0)) * pow(sin(radians(-98.0 - lng) / 2), 2))))"


@query("radius_search", f"SELECT row_id, round({_MILES}, 3) AS miles FROM listings WHERE {_MILES} <= 300 AND contains(lower(title), 'feast')")
def radius_search(spark, sf):
    df = Q.search(fx.listings(spark, sf), "feast", near=(39.0, -98.0, 300.0))
    return df.select("row_id", F.round(loc.miles_between(F.col("lat"), F.col("lng"), F.lit(39.0), F.lit(-98.0)), 3).alias("miles"))


@query(
    "search_hidden",
    f"SELECT count(*) AS matches, count(*) FILTER (WHERE NOT (CAST(end_ts AS DATE) >= DATE '1997-01-01' AND CAST(start_ts AS DATE) <= DATE '1997-06-30')) AS hidden_by_dates, count(*) FILTER (WHERE NOT {_MILES} <= 500) AS hidden_by_radius, count(*) FILTER (WHERE is_virtual) AS hidden_by_online, count(*) FILTER (WHERE calendar_type <> 'kingdom') AS hidden_by_type, count(*) FILTER (WHERE date_diff('day', CAST(start_ts AS DATE), CAST(end_ts AS DATE)) < 3) AS hidden_by_major FROM listings WHERE contains(lower(title), 'war') OR contains(lower(clean_location), 'war') OR contains(lower(kingdom), 'war')",
)
def search_hidden(spark, sf):
    return Q.hidden_by_reason(fx.listings(spark, sf), "war", first="1997-01-01", last="1997-06-30", near=(39.0, -98.0, 500.0), online=False, kind="kingdom", min_days=3)


@query("groups_silent", "SELECT group_id, group_name FROM groups_reg WHERE group_name NOT IN (SELECT source FROM listings)")
def groups_silent(spark, sf):
    return Q.groups_without_listings(fx.groups(spark, sf), fx.listings(spark, sf)).select("group_id", "group_name")


@query("site_counts", "SELECT lat, lng, count(*) AS n, min(row_id) AS first_row FROM listings GROUP BY lat, lng")
def site_counts(spark, sf):
    return Q.listings_per_site(fx.listings(spark, sf))


@query("colours", "SELECT row_id, CASE kingdom WHEN 'Kingdom of ASIA' THEN CASE WHEN calendar_type = 'kingdom' THEN '#aa0000' ELSE '#ffaaaa' END WHEN 'Kingdom of EUROPE' THEN CASE WHEN calendar_type = 'kingdom' THEN '#0000aa' ELSE '#aaaaff' END ELSE '#888888' END AS colour FROM listings")
def colours(spark, sf):
    table = spark.createDataFrame([("Kingdom of ASIA", "#aa0000", "#ffaaaa"), ("Kingdom of EUROPE", "#0000aa", "#aaaaff")], "kingdom string, event_color string, practice_color string")
    return Q.colour_of(fx.listings(spark, sf), table).select("row_id", "colour")


@query(
    "host_group_pin",
    """, g AS (SELECT *, trim(lower(regexp_replace(group_name, '[^A-Za-z0-9 ]', '', 'g'))) AS gf FROM groups_reg),
n AS (SELECT kingdom, gf AS k, gf, group_name, lat, lng, FALSE AS short FROM g UNION ALL SELECT kingdom, regexp_replace(gf, '^(barony|shire|canton|college) of (the )?', ''), gf, group_name, lat, lng, TRUE FROM g),
f AS (SELECT kingdom, min(group_name) AS first_name, max(group_name) AS last_name FROM groups_reg GROUP BY kingdom),
l AS (SELECT row_id, l.kingdom, source, title || ' (' || CASE CAST(row_id % 4 AS INT) WHEN 0 THEN first_name WHEN 1 THEN regexp_replace(last_name, '^[A-Za-z]+ of ', '') ELSE 'Nowhere' END || ')' AS title, CASE CAST(row_id % 4 AS INT) WHEN 2 THEN 'Hosted by the ' || last_name || '.' WHEN 3 THEN 'near ' || regexp_replace(last_name, '^[A-Za-z]+ of ', '') ELSE '' END AS description FROM listings l JOIN f ON l.kingdom = f.kingdom WHERE NOT is_virtual),
t AS (SELECT DISTINCT kingdom, p, t FROM (SELECT kingdom, 1 AS p, trim(lower(regexp_replace(regexp_extract(title, '.*\\(([^()]+)\\)[^()]*$', 1), '[^A-Za-z0-9 ]', '', 'g'))) AS t FROM l UNION ALL SELECT kingdom, 2, trim(lower(regexp_replace(title, '[^A-Za-z0-9 ]', '', 'g'))) FROM l UNION ALL SELECT kingdom, 3, trim(lower(regexp_replace(description, '[^A-Za-z0-9 ]', '', 'g'))) FROM l)),
tn AS (SELECT t.kingdom, p, t, -length(gf) AS neg, group_name, lat, lng FROM t JOIN n ON t.kingdom = n.kingdom AND (p < 3 OR NOT short) AND contains(' ' || t.t || ' ', ' ' || k || ' ')),
k AS (SELECT row_id, kingdom, source, trim(lower(regexp_replace(regexp_extract(title, '.*\\(([^()]+)\\)[^()]*$', 1), '[^A-Za-z0-9 ]', '', 'g'))) AS a, trim(lower(regexp_replace(title, '[^A-Za-z0-9 ]', '', 'g'))) AS b, trim(lower(regexp_replace(description, '[^A-Za-z0-9 ]', '', 'g'))) AS c FROM l),
c AS (SELECT k.row_id, p, neg, group_name, lat, lng FROM k JOIN tn ON k.kingdom = tn.kingdom AND tn.t = CASE p WHEN 1 THEN k.a WHEN 2 THEN k.b ELSE k.c END UNION ALL SELECT row_id, 0, 0, group_name, lat, lng FROM k JOIN g ON trim(lower(regexp_replace(source, '[^A-Za-z0-9 ]', '', 'g'))) = gf),
h AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY p, neg, group_name) AS rn FROM c)
SELECT l.row_id, round(h.lat, 2) AS group_lat, round(h.lng, 2) AS group_lng, CASE WHEN h.row_id IS NOT NULL THEN 'ok_group' ELSE 'failed' END AS group_status FROM l LEFT JOIN h ON h.rn = 1 AND h.row_id = l.row_id""",
)
def host_group_pin(spark, sf):
    groups = fx.groups(spark, sf)
    ends = groups.groupBy("kingdom").agg(F.min("group_name").alias("first_name"), F.max("group_name").alias("last_name"))
    df = fx.listings(spark, sf).where("not is_virtual").join(ends, "kingdom")
    short = "regexp_replace(last_name, '^[A-Za-z]+ of ', '')"
    df = df.withColumns(
        {
            "title": F.expr(f"concat(title, ' (', case cast(row_id % 4 as int) when 0 then first_name when 1 then {short} else 'Nowhere' end, ')')"),
            "description": F.expr(f"case cast(row_id % 4 as int) when 2 then concat('Hosted by the ', last_name, '.') when 3 then concat('near ', {short}) else '' end"),
            "geocode_status": F.lit("failed"),
        }
    )
    return L.pin_at_host_group(df, groups).select("row_id", F.round("group_lat", 2).alias("group_lat"), F.round("group_lng", 2).alias("group_lng"), "group_status")


_CHUNKS = ", c AS (SELECT group_id, kingdom AS chunk, CASE CAST(group_id % 3 AS INT) WHEN 0 THEN 'TX' WHEN 1 THEN 'OH' ELSE 'PA' END AS state, lat, lng FROM groups_reg)"


@query(
    "centroid_vote",
    f"{_CHUNKS}, h AS (SELECT a.group_id, a.state, count(*) AS hits, avg(b.lat) AS lat, avg(b.lng) AS lng FROM c a JOIN c b ON a.chunk = b.chunk AND a.state = b.state GROUP BY a.group_id, a.state), r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY hits DESC, state) AS rn FROM h) SELECT group_id, state, hits, round(lat, 4) AS lat, round(lng, 4) AS lng FROM r WHERE rn = 1",
)
def centroid_vote(spark, sf):
    c = fx.groups(spark, sf).select("group_id", F.col("kingdom").alias("chunk"), F.expr("case cast(group_id % 3 as int) when 0 then 'TX' when 1 then 'OH' else 'PA' end").alias("state"), "lat", "lng")
    return G.centroid_vote(c.select("group_id", "chunk", "state"), c.select("chunk", "state", "lat", "lng")).select("group_id", "state", "hits", F.round("lat", 4).alias("lat"), F.round("lng", 4).alias("lng"))


@query(
    "state_from_address",
    "SELECT row_id, nullif(regexp_extract(clean_location, ', ([A-Z]{2}) \\d{5}', 1), '') AS state, CASE WHEN clean_location = '' THEN 'empty' ELSE 'high' END AS confidence, clean_location AS address FROM listings",
)
def state_from_address(spark, sf):
    names = {"PA": "Pennsylvania", "TX": "Texas", "MS": "Mississippi", "OH": "Ohio", "CA": "California"}
    cleaned = fx.listings(spark, sf).withColumn("c", loc.clean_location(F.concat(F.when(F.expr("row_id % 2 = 0 and clean_location <> ''"), "The Hall, ").otherwise(""), "clean_location")))
    return cleaned.select("row_id", loc.state_from_address("clean_location", names).alias("state"), F.col("c.confidence").alias("confidence"), F.col("c.address").alias("address"))


_REDACT = "text"
for _p in (T.URL, T.EMAIL, T.PHONE, T.CONTACT_ROLES, T.PO_BOX, T.CARE_OF, T.EMPTY_BRACKETS):
    _REDACT = f"regexp_replace({_REDACT}, '" + _p.replace("'", "''") + "', '', 'g')"


@query("redact_contacts", f"SELECT doc_id, md5(regexp_replace(regexp_replace({_REDACT}, '\\s{{2,}}', ' ', 'g'), '^[ .,;|]+|[ .,;|]+$', '', 'g')) AS clean_md5 FROM documents".replace("{{", "{").replace("}}", "}"), raw=True)
def redact_contacts(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", F.md5(T.redact_contacts("text")).alias("clean_md5"))


@query(
    "private_ngrams",
    """WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark),
r AS (SELECT DISTINCT sha256(array_to_string(w[1:6], '|')) AS fp FROM w WHERE len(w) >= 6),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w, string_split_regex(lower(text), '[a-z0-9]+') AS g FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 4)) AS i, w, g FROM d WHERE len(w) >= 6),
f AS (SELECT doc_id, i, sha256(array_to_string(w[i:i+5], '|')) AS fp, len(list_filter(g[i+1:i+5], lambda x: NOT regexp_full_match(x, '[\\s,.]+'))) = 0 AS tight FROM s)
SELECT doc_id, count(*) AS hits FROM f JOIN r USING (fp) WHERE tight GROUP BY doc_id""",
    raw=True,
)
def private_ngrams(spark, sf):
    words = X.phrase_words(F.col("text"))
    rules = spark.read.parquet(f"{sf}/benchmark.parquet").where(F.size(words) >= 6).select(X.phrase_fingerprint(F.array_join(F.slice(words, 1, 6), " ")).alias("f")).select("f.*").distinct()
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return X.find_private(docs, rules, ["text"]).groupBy(F.col("row_id").alias("doc_id")).agg(F.count("*").alias("hits"))


@query(
    "page_links",
    """WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*?href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\s[^>]*?href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 2) AS l,
 regexp_matches(html, '(?i)covid|safety\\s+polic|code\\s+of\\s+conduct|waiver|release\\s+form|reopening\\s+polic|health\\s+polic') AS policy, html FROM pages)
SELECT page_id, len(h) > 0 AS anchored,
 CASE WHEN len(h) > 0 THEN coalesce(list_filter(list_zip(h, l), lambda x: regexp_matches(x[2], '(?i)event\\s+web'))[1][1], CASE WHEN NOT policy THEN list_filter(h, lambda x: starts_with(x, 'http') AND NOT contains(x, 'facebook.com') AND NOT contains(x, 'fb.com'))[1] END) END AS event_url,
 CASE WHEN len(h) > 0 THEN list_filter(h, lambda x: contains(x, 'facebook.com') OR contains(x, 'fb.com'))[1] END AS facebook_url FROM a""",
    raw=True,
)
def page_links(spark, sf):
    pages = fx.table(spark, sf, "pages")
    anchored = F.size(F.regexp_extract_all("html", F.lit(T.ANCHOR), F.lit(1))) > 0
    links = T.extract_links("html")
    return pages.select("page_id", anchored.alias("anchored"), F.when(anchored, links["event_url"]).alias("event_url"), F.when(anchored, links["facebook_url"]).alias("facebook_url"))


@query(
    "calendar_subpages",
    """, a AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, regexp_extract_all(html, '(?is)<a\\s[^>]*?href=["'']([^"''#]+)["''][^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\s[^>]*?href=["'']([^"''#]+)["''][^>]*>(.*?)</a>', 2) AS l FROM (SELECT page_id, url, html || '<a href="/events/' || CAST(page_id AS VARCHAR) || '">Next events</a><a href="/about">About</a>' AS html FROM pages_x)),
u AS (SELECT page_id, url, root, unnest(range(1, len(h) + 1)) AS i, h, l FROM a),
f AS (SELECT page_id, url, root, i, CASE WHEN regexp_matches(h[i], '^https?://') THEN h[i] WHEN starts_with(h[i], '/') THEN root || h[i] ELSE regexp_replace(url, '[^/]*$', '') || h[i] END AS link, lower(trim(regexp_replace(regexp_replace(l[i], '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS label FROM u),
m AS (SELECT page_id, link, min(i) AS i FROM f WHERE regexp_extract(link, '^(https?://[^/?#]+)', 1) = root AND regexp_matches(label || ' ' || lower(link), 'calendar|events?\\b|practice|schedule|activities') AND rtrim(link, '/') <> rtrim(url, '/') GROUP BY page_id, link),
r AS (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY i, link) AS rn FROM m)
SELECT page_id, link FROM r WHERE rn <= 3""",
)
def calendar_subpages(spark, sf):
    more = F.concat("html", F.lit('<a href="/events/'), F.col("page_id").cast("string"), F.lit('">Next events</a><a href="/about">About</a>'))
    return N.calendar_subpages(fx.pages(spark, sf).withColumn("html", more))


_CANDIDATES = """, cand AS (SELECT DISTINCT page_id, url, kind, feed FROM (
  SELECT page_id, url, 'calendar' AS kind, 'grp' || CAST(page_id % 20 AS VARCHAR) || '@group.calendar.google.com' AS feed FROM pages WHERE page_id % 7 = 0
  UNION ALL SELECT page_id, url, 'ics', 'https://site' || CAST(page_id AS VARCHAR) || '.example.org/feed.ics' FROM pages WHERE page_id % 7 = 1
  UNION ALL SELECT page_id, url, 'tribe', regexp_extract(url, '^(https?://[^/?#]+)', 1) FROM pages WHERE page_id % 7 = 2
  UNION ALL SELECT page_id, url, 'ics', regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/events.ics' FROM pages WHERE page_id % 7 = 3))"""


@query("feed_candidates", f"{_CANDIDATES} SELECT page_id, url, kind, feed FROM cand")
def feed_candidates(spark, sf):
    return N.feed_candidates(fx.pages(spark, sf))


@query(
    "classify_feeds",
    f"""{_CANDIDATES}, k AS (SELECT *, CASE WHEN kind = 'ics' OR kind = 'tribe' THEN rtrim(regexp_replace(lower(feed), '^https?://(?:www\\.)?', ''), '/') ELSE lower(feed) END AS key, page_id % 11 <> 0 AS fetched, CAST(page_id % 5 AS INT) AS upcoming, CAST(page_id % 3 AS INT) AS with_location FROM cand),
v AS (SELECT page_id, kind, feed, CASE WHEN key = 'grp1@group.calendar.google.com' THEN 'rejected' WHEN key = 'grp2@group.calendar.google.com' THEN 'duplicate' WHEN NOT fetched THEN 'failed' WHEN upcoming = 0 THEN 'empty'
  WHEN key = 'grp3@group.calendar.google.com' THEN 'kingdom' WHEN key = 'grp4@group.calendar.google.com' THEN 'duplicate' WHEN with_location = 0 THEN 'no-location' ELSE 'own' END AS verdict FROM k)
SELECT page_id, kind, feed, CASE WHEN verdict = 'own' AND count(*) OVER (PARTITION BY page_id, kind) > 2 THEN 'ambiguous' ELSE verdict END AS verdict FROM v""",
)
def classify_feeds(spark, sf):
    c = N.feed_candidates(fx.pages(spark, sf)).withColumns({"fetched": F.expr("page_id % 11 <> 0"), "upcoming": F.expr("cast(page_id % 5 as int)"), "with_location": F.expr("cast(page_id % 3 as int)"), "compared": F.lit(4)})
    g = "@group.calendar.google.com"
    rejected = spark.createDataFrame([(f"grp1{g}",)], "id string").select(F.sha2("id", 256).alias("fingerprint"))
    used = spark.createDataFrame([(f"https://calendar.google.com/calendar/ical/grp2%40group.calendar.google.com/public/basic.ics",)], "feed string")
    overlap = spark.createDataFrame([(f"grp3{g}", "Kingdom of ASIA", 3), (f"grp4{g}", "Barony of CHINA", 2), (f"grp5{g}", "Barony of CHINA", 1)], "feed string, source string, shared int")
    return N.flag_directories(N.classify_feeds(c, rejected, used, overlap)).select("page_id", "kind", "feed", "verdict")


def _unescape_sql(x: str) -> str:
    for a, b in T.ENTITIES:
        x = f"replace({x}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return x


@query("page_text", f"SELECT page_id, md5(trim(regexp_replace({_unescape_sql(chr(114) + 'egexp_replace(html, ' + chr(39) + '<[^>]+>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}, '\\s+', ' ', 'g'))) AS text_md5 FROM pages", raw=True)
def page_text(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", F.md5(T.strip_html("html")).alias("text_md5"))


@query(
    "dead_links",
    """WITH p AS (SELECT page_id, CASE WHEN page_id % 13 = 0 THEN 404 ELSE 200 END AS status, CASE WHEN page_id % 17 = 0 THEN left(html, 100) WHEN page_id % 19 = 0 THEN '<h1>Page not found</h1>' || html ELSE html END AS html FROM pages),
r AS (SELECT page_id, CASE WHEN status <> 200 THEN 'status' WHEN length(html) < 300 THEN 'short' WHEN regexp_matches(lower(left(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 5000)), 'page not found|404 not found|domain (is )?for sale|account suspended') THEN 'not found' END AS reason FROM p)
SELECT page_id, reason FROM r WHERE reason IS NOT NULL""",
    raw=True,
)
def dead_links(spark, sf):
    p = fx.table(spark, sf, "pages").withColumn("html", F.when(F.expr("page_id % 17 = 0"), F.substring("html", 1, 100)).when(F.expr("page_id % 19 = 0"), F.concat(F.lit("<h1>Page not found</h1>"), "html")).otherwise(F.col("html")))
    return H.dead_links(p, F.when(F.expr("page_id % 13 = 0"), 404).otherwise(200)).select("page_id", "reason")


@query("health_rollup", "SELECT calendar_type, source, count(*) AS n, count(*) FILTER (WHERE clean_location = '') AS unplaced, count(*) FILTER (WHERE is_virtual) AS online FROM listings GROUP BY ROLLUP (calendar_type, source)")
def health_rollup(spark, sf):
    return H.health_rollup(fx.listings(spark, sf))


@query("feed_drop", ", a AS (SELECT source, count(*) AS n FROM listings WHERE start_ts < TIMESTAMP '1998-01-01' GROUP BY source), b AS (SELECT source, count(*) AS n FROM listings WHERE start_ts >= TIMESTAMP '1998-01-01' AND row_id % 4 = 0 AND source <> 'Kingdom of ASIA' GROUP BY source) SELECT a.source, a.n AS before, coalesce(b.n, 0) AS now FROM a LEFT JOIN b ON a.source = b.source WHERE a.n >= 10 AND coalesce(b.n, 0) <= a.n * 0.4")
def feed_drop(spark, sf):
    df = fx.listings(spark, sf)
    now = df.where("start_ts >= timestamp_ntz'1998-01-01' and row_id % 4 = 0 and source <> 'Kingdom of ASIA'")
    return H.feed_drop(now, df.where("start_ts < timestamp_ntz'1998-01-01'"))


@query("failure_rate", f", p AS ({_PRIOR}) SELECT source, count(*) FILTER (WHERE geocode_status = 'failed') AS failed, count(*) AS tried, round(count(*) FILTER (WHERE geocode_status = 'failed') / CAST(count(*) AS DOUBLE), 6) AS rate FROM p GROUP BY source")
def failure_rate(spark, sf):
    return H.failure_rate(_prior(fx.listings(spark, sf)), "source").withColumn("rate", F.round("rate", 6))


_SHIFTED = ", s AS (SELECT row_id, source, CASE WHEN row_id % 31 = 0 THEN start_ts + INTERVAL '200' YEAR ELSE start_ts END AS start_ts, CASE WHEN row_id % 23 = 0 THEN end_ts - INTERVAL '20' DAY ELSE end_ts END AS end_ts FROM listings)"


def _shifted(spark, sf):
    return fx.listings(spark, sf).withColumns({"start_ts": F.expr("case when row_id % 31 = 0 then start_ts + interval '200' year else start_ts end"), "end_ts": F.expr("case when row_id % 23 = 0 then end_ts - interval '20' day else end_ts end")})


@query("date_anomalies", f"{_SHIFTED} SELECT source, count(*) AS total, count(*) FILTER (WHERE year(start_ts) NOT BETWEEN 1900 AND 2100) AS bad_year, count(*) FILTER (WHERE end_ts < start_ts) AS backwards, CAST(0 AS BIGINT) AS missing, CASE WHEN count(*) FILTER (WHERE year(start_ts) NOT BETWEEN 1900 AND 2100 OR end_ts < start_ts) > 0 THEN 'ANOMALY' ELSE 'clean' END AS flag FROM s GROUP BY source")
def date_anomalies(spark, sf):
    return H.date_anomalies(_shifted(spark, sf))


@query("guard_dates", f"{_SHIFTED} SELECT row_id, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS start_day, CAST(CAST(CASE WHEN year(end_ts) BETWEEN 1900 AND 2100 AND end_ts >= start_ts THEN end_ts ELSE start_ts END AS DATE) AS VARCHAR) AS end_day FROM s WHERE year(start_ts) BETWEEN 1900 AND 2100")
def guard_dates(spark, sf):
    return S.guard_dates(_shifted(spark, sf)).select("row_id", _day("start_ts").alias("start_day"), _day("end_ts").alias("end_day"))


@query(
    "integrity_checks",
    "SELECT 'duplicate' AS finding, CAST(s_nationkey AS VARCHAR) AS value FROM supplier GROUP BY s_nationkey HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'reference', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20) UNION ALL SELECT DISTINCT 'format', group_name FROM groups_reg WHERE NOT regexp_matches(group_name, '^(Barony|Shire|Canton) of ') UNION ALL SELECT 'shared', source FROM listings GROUP BY source HAVING count(DISTINCT calendar_type) > 1",
)
def integrity_checks(spark, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    named = lambda df, n, c: df.select(F.lit(n).alias("finding"), F.col(c).cast("string").alias("value"))
    return (
        named(H.check_unique(read("supplier"), "s_nationkey"), "duplicate", "s_nationkey")
        .unionByName(named(H.check_reference(read("customer"), "c_nationkey", read("nation").where("n_nationkey < 20"), "n_nationkey"), "reference", "value"))
        .unionByName(named(H.check_format(fx.groups(spark, sf), "group_name", "^(Barony|Shire|Canton) of "), "format", "value"))
        .unionByName(named(H.check_shared_feed(fx.listings(spark, sf), "source", "calendar_type"), "shared", "source"))
    )


@query(
    "expand_recurrence",
    "WITH r AS (SELECT c_custkey, DATE '2026-01-01' + CAST(c_custkey % 28 AS INT) AS d, CAST(1 + c_custkey % 2 AS INT) AS step FROM customer) SELECT c_custkey, CAST(CAST(x AS DATE) AS VARCHAR) AS occurs_on FROM (SELECT c_custkey, unnest(generate_series(CAST(d AS TIMESTAMP), TIMESTAMP '2026-03-31', to_days(7 * step))) AS x FROM r) WHERE CAST(x AS DATE) BETWEEN DATE '2026-02-01' AND DATE '2026-03-31' AND CAST(x AS DATE) <> DATE '2026-03-10'",
    raw=True,
)
def expand_recurrence(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.expr("cast(date_add(date'2026-01-01', cast(c_custkey % 28 as int)) as timestamp_ntz)").alias("start_ts"), F.expr("concat('FREQ=WEEKLY;INTERVAL=', cast(1 + c_custkey % 2 as string))").alias("rrule"), F.array(F.lit("20260310")).alias("exdates"))
    return S.expand_recurrence(c, "2026-02-01", "2026-03-31").select("c_custkey", F.col("occurs_on").cast("string").alias("occurs_on"))


@query(
    "refresh_due",
    ", c AS (SELECT row_id, CAST(start_ts AS DATE) AS s, CASE WHEN row_id % 6 = 0 THEN NULL ELSE DATE '1997-06-01' - CAST(row_id % 40 AS INT) END AS c FROM listings) SELECT row_id FROM c WHERE c IS NULL OR date_diff('day', c, DATE '1997-06-01') > CASE WHEN s < DATE '1997-06-01' THEN 3650 WHEN date_diff('day', DATE '1997-06-01', s) < 7 THEN 1 WHEN date_diff('day', DATE '1997-06-01', s) < 30 THEN 7 ELSE 30 END",
)
def refresh_due(spark, sf):
    df = fx.listings(spark, sf).withColumn("cached_on", F.expr("case when row_id % 6 = 0 then null else date_sub(date'1997-06-01', cast(row_id % 40 as int)) end"))
    return P.refresh_due(df, "1997-06-01").select("row_id")


@query(
    "changed_pages",
    "WITH m AS (SELECT url, max(CAST(page_id % 9 AS VARCHAR)) AS lastmod FROM pages GROUP BY url), c AS (SELECT url, CASE WHEN lastmod = '3' THEN '9' ELSE lastmod END AS lastmod FROM m WHERE lastmod <> '5') SELECT m.url, m.lastmod FROM m LEFT JOIN c ON m.url = c.url WHERE c.url IS NULL OR m.lastmod <> c.lastmod",
    raw=True,
)
def changed_pages(spark, sf):
    m = fx.table(spark, sf, "pages").groupBy("url").agg(F.max(F.expr("cast(page_id % 9 as string)")).alias("lastmod"))
    cache = m.where("lastmod <> '5'").withColumn("lastmod", F.expr("case when lastmod = '3' then '9' else lastmod end"))
    return S.changed_pages(m, cache)[0]


@query(
    "json_feed",
    """SELECT source, CAST(row_id AS VARCHAR) AS uid, title, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS start_day, CASE WHEN clean_location = '' THEN 'Hall' ELSE 'Hall, ' || clean_location END AS location FROM listings""",
)
def json_feed(spark, sf):
    one = F.struct(F.col("row_id").cast("string").alias("id"), "title", F.lit("<p>x</p>").alias("description"), F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss").alias("start_date"), F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss").alias("end_date"), F.struct(F.lit("Hall").alias("venue"), F.col("clean_location").alias("address")).alias("venue"))
    body = fx.listings(spark, sf).select("source", F.to_json(F.struct(F.array(one).alias("events"))).alias("body"))
    return S.tribe_events(body).select("source", "uid", "title", _day("start_ts").alias("start_day"), "location")


from fairweave.plans import queries_detail  # noqa: E402, F401  registers the rest

from fairweave.plans import queries_more  # noqa: E402, F401

from fairweave.plans import queries_refresh  # noqa: E402, F401
