"""The refresh as a query: every step on the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairweave.functions import location as loc
from fairweave.operators import privacy as X
from fairweave.plans import fixtures as fx
from fairweave.plans.pipeline import refresh
from fairweave.plans.queries import _COPY, _KEYWORDS_SQL, _NON_EVENT, _NORM, _RULES, _RULES_SQL, _TOK, _VENUE, _boxes, _BOXES, _events, _keyword_rules, query

_BOX = ", ".join(map(str, _BOXES))
_URL = "CASE WHEN row_id % 3 = 0 THEN '' ELSE concat('https://example.org/', CAST(row_id % 50 AS STRING)) END"
_VAGUE = "CASE WHEN calendar_type = 'baronial' AND clean_location = '' AND NOT is_virtual THEN 'vague' ELSE '' END"
_STATUS = "CASE WHEN row_id % 4 = 0 THEN 'override' ELSE 'ok' END"

_SQL = f"""{_RULES_SQL}, kr AS (SELECT * FROM {_KEYWORDS_SQL.split("FROM", 1)[1].rsplit(")", 1)[0]}),
b AS (SELECT * FROM (VALUES {_BOX}) AS t(ord, st, a, z, w, e)),
c0 AS (SELECT row_id, title, start_ts, end_ts, source, kingdom, calendar_type, is_virtual, clean_location, {_URL} AS event_url, {_VAGUE} AS spec FROM listings
  WHERE NOT (source = 'Kingdom of ASIA' AND row_id % 2 = 0) AND NOT {_NON_EVENT} AND NOT regexp_matches(title, '(?i)\\bcancell?ed\\b') AND CAST(end_ts AS DATE) >= DATE '1998-01-01'),
dd AS (SELECT *, row_number() OVER (PARTITION BY CAST(start_ts AS DATE), lower(trim(clean_location)), calendar_type ORDER BY CASE WHEN lower(title) LIKE '%out of kingdom%' THEN 1 ELSE 0 END, CASE WHEN source = kingdom THEN 0 ELSE 1 END, row_id) AS rn FROM c0 WHERE clean_location <> '' AND NOT is_virtual),
c1 AS (SELECT * EXCLUDE rn FROM dd WHERE rn = 1 UNION ALL SELECT * FROM c0 WHERE NOT (clean_location <> '' AND NOT is_virtual)),
k AS (SELECT row_id, calendar_type, CAST(start_ts AS DATE) AS d, {_TOK} AS t, {_VENUE} AS v, trim(clean_location) <> '' AND NOT is_virtual AS placed FROM c1),
c2 AS (SELECT * FROM c1 WHERE row_id IN (SELECT a.row_id FROM k a WHERE NOT (a.placed AND a.calendar_type = 'baronial' AND EXISTS (SELECT 1 FROM k b WHERE b.placed AND b.calendar_type = 'kingdom' AND b.d = a.d AND {_COPY})))),
pr AS (SELECT row_id, title, start_ts, end_ts, source, kingdom, calendar_type, is_virtual, clean_location, {_URL} AS event_url, '' AS spec, lat, lng, {_STATUS} AS status FROM listings WHERE row_id % 5 <> 0),
fp AS (SELECT title, start_ts, clean_location, lat, lng, status FROM pr QUALIFY row_number() OVER (PARTITION BY title, start_ts, clean_location ORDER BY row_id) = 1),
c3 AS (SELECT c2.*, fp.lat, fp.lng, coalesce(fp.status, '') AS status FROM c2 LEFT JOIN fp ON c2.title = fp.title AND c2.start_ts = fp.start_ts AND c2.clean_location = fp.clean_location),
bs AS (SELECT row_id, min_by(st, ord) AS st FROM c3 JOIN b ON lat BETWEEN a AND z AND lng BETWEEN w AND e GROUP BY row_id),
bad AS (SELECT c3.row_id FROM c3 LEFT JOIN bs ON c3.row_id = bs.row_id LEFT JOIN b n ON n.st = nullif(regexp_extract(c3.clean_location, ', ([A-Z]{{2}}) \\d{{5}}', 1), '')
  WHERE c3.lat IS NOT NULL AND status <> 'override' AND ((n.st IS NOT NULL AND NOT (lat BETWEEN n.a AND n.z AND lng BETWEEN n.w AND n.e)) OR (bs.st IS NOT NULL AND source IN ('Kingdom of EUROPE', 'Barony of CHINA') AND bs.st NOT IN ('MS', 'TX')))),
c4 AS (SELECT c3.* REPLACE (CASE WHEN bad.row_id IS NULL THEN lat END AS lat, CASE WHEN bad.row_id IS NULL THEN lng END AS lng, CASE WHEN bad.row_id IS NULL THEN status ELSE 'failed' END AS status) FROM c3 LEFT JOIN bad ON c3.row_id = bad.row_id),
c5 AS (SELECT * FROM c4 UNION ALL BY NAME SELECT * FROM pr WHERE source = 'Kingdom of ASIA' AND CAST(start_ts AS DATE) >= DATE '1998-01-01' AND NOT EXISTS (SELECT 1 FROM c4 WHERE c4.source = pr.source AND c4.title = pr.title AND c4.start_ts = pr.start_ts)),
h AS (SELECT c5.row_id, r.* FROM c5 JOIN r ON (r.url <> '' AND r.url = c5.event_url) OR (r.url = '' AND r.src = c5.source AND r.tt = {_NORM})),
wn AS (SELECT row_id, max_by(addr, seq) FILTER (WHERE addr <> '') AS addr, max_by(la, seq) FILTER (WHERE la IS NOT NULL) AS la, max_by(ln, seq) FILTER (WHERE la IS NOT NULL) AS ln, max_by(link, seq) FILTER (WHERE link <> '') AS link FROM h GROUP BY row_id),
c6 AS (SELECT c5.* REPLACE (coalesce(addr, clean_location) AS clean_location, CASE WHEN la IS NOT NULL THEN la WHEN addr IS NULL THEN lat END AS lat, CASE WHEN la IS NOT NULL THEN ln WHEN addr IS NULL THEN lng END AS lng, coalesce(link, event_url) AS event_url, CASE WHEN la IS NOT NULL THEN 'override' WHEN addr IS NOT NULL THEN '' ELSE status END AS status) FROM c5 LEFT JOIN wn ON c5.row_id = wn.row_id),
kh AS (SELECT c6.row_id, kr.* FROM c6 JOIN kr ON kr.src = c6.source AND contains(lower(title || ' ' || clean_location), kw) QUALIFY row_number() OVER (PARTITION BY c6.row_id ORDER BY seq) = 1),
c7 AS (SELECT c6.* REPLACE (coalesce(kh.la, lat) AS lat, coalesce(kh.ln, lng) AS lng, CASE WHEN kh.addr <> '' THEN kh.addr ELSE clean_location END AS clean_location, CASE WHEN kh.seq IS NULL THEN status ELSE 'override' END AS status, CASE WHEN kh.seq IS NULL THEN spec ELSE '' END AS spec) FROM c6 LEFT JOIN kh ON c6.row_id = kh.row_id),
c8 AS (SELECT c7.* REPLACE (CASE WHEN v AND n_name IS NOT NULL THEN 30 + n_nationkey * 0.5 ELSE lat END AS lat, CASE WHEN v AND n_name IS NOT NULL THEN -100 + n_nationkey * 0.25 ELSE lng END AS lng, CASE WHEN v AND n_name IS NOT NULL THEN 'ok_fallback' ELSE status END AS status, CASE WHEN v AND n_name IS NULL THEN '' ELSE spec END AS spec)
  FROM (SELECT *, spec = 'vague' AND status <> 'override' AS v FROM c7) c7 LEFT JOIN nation ON source = 'Barony of ' || n_name),
ev AS (SELECT * FROM (VALUES (1, 'gulf wars', 'Kingdom of ASIA', 'Gulf site', 31.5, -89.25, 'https://gulf.example.org'), (2, 'lilies war', 'Kingdom of EUROPE', 'Lilies site', 39.0, -94.5, '')) AS t(eseq, kw, host, place, wla, wln, site)),
m AS (SELECT l.row_id, l.source, l.calendar_type, l.start_ts, ev.*, year(start_ts) AS y, CAST(start_ts AS DATE) AS s, CAST(end_ts AS DATE) AS en FROM c8 l JOIN ev ON contains(' ' || {_NORM} || ' ', ' ' || ev.kw || ' ') WHERE date_diff('second', start_ts, end_ts) / 86400.0 >= 3),
mk AS (SELECT * FROM m WHERE calendar_type = 'kingdom'),
mn AS (SELECT eseq, y, s, en, rank() OVER (PARTITION BY eseq, y ORDER BY count(*) DESC) AS r FROM mk GROUP BY eseq, y, s, en),
ch AS (SELECT mk.* FROM mk LEFT JOIN mn ON mn.r = 1 AND mn.eseq = mk.eseq AND mn.y = mk.y AND mn.s = mk.s AND mn.en = mk.en
  QUALIFY row_number() OVER (PARTITION BY mk.eseq, mk.y ORDER BY CASE WHEN mk.source = mk.host THEN 0 WHEN mn.eseq IS NOT NULL THEN 1 ELSE 2 END, CASE WHEN mk.source <> mk.host THEN mk.start_ts END, mk.row_id) = 1),
mem AS (SELECT row_id FROM mk UNION SELECT m.row_id FROM m JOIN ch ON m.eseq = ch.eseq AND m.s <= ch.en AND m.en >= ch.s WHERE m.calendar_type <> 'kingdom'),
c9 AS (SELECT row_id, title, start_ts, end_ts, source, calendar_type, clean_location, event_url, spec, lat, lng, status FROM c8 WHERE row_id NOT IN (SELECT row_id FROM mem)
  UNION ALL SELECT c8.row_id, title, c8.start_ts, end_ts, ch.host, 'kingdom', ch.place, CASE WHEN ch.site <> '' THEN ch.site ELSE event_url END, '', ch.wla, ch.wln, 'override' FROM c8 JOIN ch ON c8.row_id = ch.row_id),
c10 AS (SELECT * REPLACE (replace(clean_location, '103 Main St', '[private]') AS clean_location, CASE WHEN private = '' THEN lat END AS lat, CASE WHEN private = '' THEN lng END AS lng) FROM (SELECT *, CASE WHEN contains(clean_location, '103 Main St') THEN 'private' ELSE '' END AS private FROM c9)),
lk AS (SELECT source, {_NORM} AS t, min_by('https://link.example.org/' || CAST(row_id AS VARCHAR), row_id) AS u FROM listings WHERE row_id % 7 = 0 GROUP BY ALL),
c11 AS (SELECT c10.* REPLACE (CASE WHEN event_url <> '' THEN event_url ELSE coalesce(lk.u, '') END AS event_url) FROM c10 LEFT JOIN lk ON lk.source = c10.source AND lk.t = {_NORM}),
hit AS (SELECT la, ln, min(poly_id) AS poly_id, arg_min(kingdom, poly_id) AS territory FROM (
  SELECT p.la, p.ln, t.poly_id, t.kingdom, sum(CASE WHEN (t.y1 > p.la) <> (t.y2 > p.la) AND p.ln < (t.x2 - t.x1) * (p.la - t.y1) / (t.y2 - t.y1) + t.x1 THEN 1 ELSE 0 END) AS c
  FROM (SELECT DISTINCT round(lat, 4) AS la, round(lng, 4) AS ln FROM c11 WHERE lat IS NOT NULL) p JOIN edges t ON p.la BETWEEN 24 + CAST(floor(t.poly_id / 5) AS INT) * 5.2 AND 29.2 + CAST(floor(t.poly_id / 5) AS INT) * 5.2
  GROUP BY p.la, p.ln, t.poly_id, t.kingdom) WHERE c % 2 = 1 GROUP BY la, ln)
SELECT row_id, source, clean_location, round(CAST(lat AS DOUBLE), 4) AS lat, round(CAST(lng AS DOUBLE), 4) AS lng, status AS geocode_status, spec AS location_specificity, event_url, coalesce(territory, '') AS host_kingdom,
  CASE WHEN calendar_type = 'kingdom' AND regexp_matches(title, '(?i)\\bwars?\\b') AND date_diff('second', start_ts, end_ts) / 86400.0 >= 5 THEN coalesce(territory, '') ELSE '' END AS war_host, private AS privacy
FROM c11 LEFT JOIN hit ON round(lat, 4) = la AND round(lng, 4) = ln""".replace("{{", "{").replace("}}", "}")


@query("refresh", _SQL)
def refreshed(spark, sf):
    """As of 1998: half of a region's rows come from the prior run, as its feed failed; a fifth of the rows have no prior pin."""
    df = fx.listings(spark, sf).withColumn("event_url", F.expr(_URL))
    new = df.where("not (source = 'Kingdom of ASIA' and row_id % 2 = 0)").drop("lat", "lng").withColumn("location_specificity", F.expr(_VAGUE))
    prior = df.where("row_id % 5 <> 0").withColumn("geocode_status", F.expr(_STATUS))
    rules = spark.createDataFrame(_RULES, "rule_seq int, url string, source string, title string, on_date date, address string, lat double, lng double, link string")
    homes = spark.createDataFrame([("Kingdom of EUROPE", ["MS", "TX"]), ("Barony of CHINA", ["MS", "TX"])], "source string, states array<string>")
    private = spark.createDataFrame([("103 Main St",)], "p string").select(X.phrase_fingerprint("p").alias("f")).select("f.*", F.lit("").alias("scope"), F.lit("[private]").alias("replace_with"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"))
    seats = spark.read.parquet(f"{sf}/nation.parquet").selectExpr("concat('Barony of ', n_name) AS group_name", "30 + n_nationkey * 0.5D AS lat", "-100 + n_nationkey * 0.25D AS lng")
    links = df.where("row_id % 7 = 0").select("source", "title", F.concat(F.lit("https://link.example.org/"), F.col("row_id").cast("string")).alias("url"), F.col("row_id").alias("seq"))
    out = refresh(
        new,
        prior,
        spark.createDataFrame([("Kingdom of ASIA",)], "source string"),
        _events(spark),
        fx.territory_edges(spark, sf),
        private,
        "1998-01-01",
        boxes=_boxes(spark),
        homes=homes,
        state=loc.state_from_address("clean_location", {"PA": "Pennsylvania", "TX": "Texas", "MS": "Mississippi", "OH": "Ohio", "CA": "California"}),
        rules=rules,
        keywords=_keyword_rules(spark),
        seats=seats,
        links=links,
    )
    pin = [F.round(c, 4).alias(c) for c in ("lat", "lng")]
    return out.select("row_id", "source", "clean_location", *pin, "geocode_status", "location_specificity", "event_url", "host_kingdom", "war_host", "privacy")
