"""Queries of operators that the other two modules leave out; the SQL states the expected values independently."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
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
from fairweave.operators.store import shared_folder, stored
from fairweave.plans import fixtures as fx
from fairweave.plans.queries import _PRIOR, _day, _prior, query
from fairweave.sources import feeds as S
from fairweave.streaming.ingest import current_listings, history, ingest_listings, ingest_snapshots


def _case(column: str, *values: str) -> F.Column:
    """The SQL value for the remainder 0, 1, ... of a column."""
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values[:-1]))
    return F.expr(f"case cast({column} % {len(values)} as int) {whens} else {values[-1]} end")


_ICS = "https://calendar.google.com/calendar/ical/"


@query("feed_urls", f"SELECT s_suppkey AS feed, CASE CAST(s_suppkey % 4 AS INT) WHEN 0 THEN '{_ICS}grp' || CAST(s_suppkey AS VARCHAR) || '%40group.calendar.google.com/public/basic.ics' WHEN 3 THEN '{_ICS}own' || CAST(s_suppkey AS VARCHAR) || '%40example.org/public/basic.ics' ELSE 'https://site' || CAST(s_suppkey AS VARCHAR) || '.example.org/f.ics' END AS url FROM supplier", raw=True)
def feed_urls(spark, sf):
    k = "cast(s_suppkey as string)"
    text = _case("s_suppkey", f"concat('https://calendar.google.com/calendar/embed?src=grp', {k}, '%40group.calendar.google.com&ctz=UTC')", f"concat('webcal://site', {k}, '.example.org/f.ics')", f"concat(' https://site', {k}, '.example.org/f.ics')", f"concat('own', {k}, '@example.org')")
    return spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("feed"), S.feed_url(text).alias("url"))


def _body(df, *fields):
    """Ten records to a body, as a feed would send them."""
    return df.groupBy("source", F.floor(F.col("row_id") / 10)).agg(F.to_json(F.collect_list(F.struct(*fields))).alias("body"))


@query(
    "calon_feed",
    """SELECT source, CAST(row_id AS VARCHAR) AS uid, title, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS first_day, CAST(CAST(CASE WHEN row_id % 3 = 0 THEN start_ts ELSE end_ts END AS DATE) AS VARCHAR) AS last_day,
 CASE WHEN row_id % 2 = 0 THEN 'https://example.org/event/' || CAST(row_id AS VARCHAR) ELSE 'https://example.org/event/' || CAST(row_id AS VARCHAR) END AS event_url, 'Hall, ' || kingdom AS location, CASE WHEN row_id % 2 = 0 THEN 'page ' || CAST(row_id AS VARCHAR) ELSE 'Hosted by ' || source END AS description FROM listings""",
)
def calon_feed(spark, sf):
    df = fx.listings(spark, sf)
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    id_ = F.col("row_id").cast("string")
    body = _body(df, id_.alias("id"), F.col("title").alias("name"), time("start_ts").alias("start"), F.when(F.expr("row_id % 3 <> 0"), time("end_ts")).alias("end"), F.col("source").alias("host"), F.lit("Hall").alias("site_name"), F.lit("hall").alias("site_city"), F.col("kingdom").alias("site_state"))
    texts = df.where("row_id % 2 = 0").select(F.concat(F.lit("https://example.org/event/"), id_).alias("url"), F.concat(F.lit("page "), id_).alias("text"))
    return S.calon_events(body, texts).select("source", "uid", "title", _day("start_ts").alias("first_day"), _day("end_ts").alias("last_day"), "event_url", "location", "description")


@query(
    "drachenwald_feed",
    "SELECT source, CAST(row_id AS VARCHAR) AS uid, title, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS first_day, CASE WHEN row_id % 4 = 0 THEN 'https://meet.example.org' ELSE 'Hall, ' || kingdom END AS location FROM listings WHERE row_id % 5 <> 0 AND row_id % 7 <> 0",
)
def drachenwald_feed(spark, sf):
    here = lambda c: F.when(F.expr("row_id % 4 <> 0"), c)
    fields = {"type": F.expr("if(row_id % 5 = 0, 'news', 'event')"), "status": F.expr("if(row_id % 7 = 0, 'Cancelled', '')"), "event-name": F.col("title"), "start-date": F.date_format("start_ts", "yyyy-MM-dd"), "site-name": here(F.lit("Hall")), "town": here(F.lit("hall")), "country": here(F.col("kingdom")), "online-url": F.lit("https://meet.example.org"), "slug": F.col("row_id").cast("string")}
    body = _body(fx.listings(spark, sf), *[v.alias(k) for k, v in fields.items()])
    return S.drachenwald_events(body).select("source", "uid", "title", _day("start_ts").alias("first_day"), "location")


@query("mycal_feed", "SELECT source, CAST(row_id AS VARCHAR) AS uid, title, 'told' AS description, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS first_day, 'Hall, ' || kingdom AS location FROM listings WHERE row_id % 6 <> 0")
def mycal_feed(spark, sf):
    """Each occurrence stands under two days."""
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    one = F.struct(F.col("row_id").cast("string").alias("occur_id"), time("start_ts").alias("occur_begin"), time("end_ts").alias("occur_end"), F.col("title").alias("event_title"), F.lit("<p>told</p>").alias("event_desc"), F.lit("Hall").alias("event_label"), F.col("kingdom").alias("event_state"), F.expr("if(row_id % 6 = 0, '0', '1')").alias("event_approved"))
    some = fx.listings(spark, sf).groupBy("source", F.floor(F.col("row_id") / 10)).agg(F.collect_list(one).alias("x"))
    body = some.select("source", F.to_json(F.create_map(F.lit("day 1"), F.col("x"), F.lit("day 2"), F.col("x"))).alias("body"))
    return S.mycal_events(body).select("source", "uid", "title", "description", _day("start_ts").alias("first_day"), "location")


@query("static_practices", "SELECT row_id, title, CAST(NULL AS VARCHAR) AS schedule FROM listings UNION ALL SELECT -group_id, 'Practice of ' || group_name, 'Tuesdays' FROM groups_reg")
def static_practices(spark, sf):
    practices = fx.groups(spark, sf).select((-F.col("group_id")).alias("row_id"), F.concat(F.lit("Practice of "), "group_name").alias("title"), F.lit("Tuesdays").alias("schedule"))
    return S.static_practices(fx.listings(spark, sf), practices).select("row_id", "title", "schedule")


@query("written_listings", "SELECT row_id, title, source, calendar_type, is_virtual, clean_location, round(lat, 2) AS lat FROM listings")
def written_listings(spark, sf):
    """Written twice over as the served table, and read back."""
    path = f"{shared_folder(spark)}/served-{uuid.uuid4().hex}"
    for _ in range(2):
        S.write_listings(fx.listings(spark, sf), path)
    return spark.read.parquet(path).select("row_id", "title", "source", "calendar_type", "is_virtual", "clean_location", F.round("lat", 2).alias("lat"))


@query("name_keys", "WITH n AS (SELECT s_suppkey, n_name, CASE CAST(s_suppkey % 3 AS INT) WHEN 0 THEN lower(replace(n_name, 'A', 'Á')) WHEN 1 THEN replace(n_name, 'I', 'ï') ELSE n_name || ' x' END AS other FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_suppkey, strip_accents(lower(n_name)) = strip_accents(lower(other)) AS same, regexp_replace(lower(strip_accents(other)), '[^a-z0-9]', '', 'g') AS key FROM n", raw=True)
def name_keys(spark, sf):
    n = spark.read.parquet(f"{sf}/supplier.parquet").join(spark.read.parquet(f"{sf}/nation.parquet"), F.expr("s_nationkey = n_nationkey"))
    other = _case("s_suppkey", "lower(replace(n_name, 'A', 'Á'))", "replace(n_name, 'I', 'ï')", "concat(n_name, ' x')")
    return n.withColumn("other", other).select("s_suppkey", T.same_name(F.col("n_name"), F.col("other")).alias("same"), T.norm_name("other").alias("key"))


@query("unwrapped_links", "SELECT page_id, url FROM pages", raw=True)
def unwrapped_links(spark, sf):
    link = _case("page_id", "concat('https://l.facebook.com/l.php?u=', url_encode(url), '&h=1')", "concat('https://www.google.com/url?sa=D&q=', url_encode(url))", "url")
    return fx.table(spark, sf, "pages").select("page_id", T.unwrap_redirect(link).alias("url"))


@query("clean_descriptions", "SELECT page_id, CASE CAST(page_id % 3 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'Fair ' || CAST(page_id AS VARCHAR) || ' for all. Event web site' ELSE 'Mail or call about ' || CAST(page_id AS VARCHAR) END AS description, CASE WHEN page_id % 3 = 1 THEN url END AS event_url FROM pages", raw=True)
def clean_descriptions(spark, sf):
    k = "cast(page_id as string)"
    html = _case("page_id", "'<p>No description yet</p>'", f"concat('<p>Fair ', {k}, ' for all.</p><a href=\"', url, '\">Event web site</a>')", f"concat('Mail a.b@example.org or call 555-123-4567 about ', {k}, ' 555.123.4567')")
    got = fx.table(spark, sf, "pages").select("page_id", T.clean_description(html).alias("c"))
    return got.select("page_id", "c.description", "c.event_url")


@query(
    "structured_descriptions",
    """SELECT row_id, CASE source WHEN 'Kingdom of ASIA' THEN 'body ' || CAST(row_id AS VARCHAR) WHEN 'Kingdom of EUROPE' THEN 'Intro Details: body ' || CAST(row_id AS VARCHAR) || ' -- end [ad]'
 WHEN 'Kingdom of AMERICA' THEN 'Level: 5 Intro Details: body ' || CAST(row_id AS VARCHAR) || ' -- end' ELSE 'Level: 5 Intro Details: body ' || CAST(row_id AS VARCHAR) || ' -- end [ad]' END AS description FROM listings""",
)
def structured_descriptions(spark, sf):
    rules = spark.createDataFrame([("Kingdom of ASIA", 1, "before", "Details:"), ("Kingdom of ASIA", 2, "after", " -- "), ("Kingdom of EUROPE", 1, "label", "Level"), ("Kingdom of AMERICA", 1, "pattern", r"\[ad\]")], "source string, rule_seq int, kind string, marker string")
    df = fx.listings(spark, sf).withColumn("description", F.expr("concat('Level: 5 Intro Details: body ', cast(row_id as string), ' -- end [ad]')"))
    return T.strip_structured(df, rules).select("row_id", "description")


@query("note_blocks", "SELECT row_id, CASE CAST(row_id % 3 AS INT) WHEN 0 THEN 'Hosted. Greetings to all of ' || source || '.' WHEN 1 THEN 'Then we dance at ' || source || '.' ELSE 'No notes on ' || source END AS description FROM listings")
def note_blocks(spark, sf):
    text = _case("row_id", "concat('Hosted. Additional Notes on Pets: none. Additional Notes on Fire: pits only. Greetings to all of ', source, '.')", "concat('Additional Notes on Food: bring some. Then we dance at ', source, '.')", "concat('No notes on ', source)")
    return fx.listings(spark, sf).select("row_id", T.strip_note_blocks(text).alias("description"))


@query("page_fields", "SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'Notes of page ' || CAST(page_id AS VARCHAR) || ' & more of them' END AS notes, CASE WHEN page_id % 2 = 0 THEN 'Shire ' || CAST(page_id AS VARCHAR) END AS organizer FROM pages", raw=True)
def page_fields(spark, sf):
    k = "cast(page_id as string)"
    notes = _case("page_id", "'<div class=\"event-notes\">TBA</div>'", *[f"concat('<div class=\"x event-notes y\">Notes of <b>page</b> ', {k}, ' &amp; more of them</div>')"] * 2)
    told = _case("page_id", f"concat('<script type=\"application/ld+json\">{{\"organizer\": {{\"@type\": \"x\", \"name\": \"Shire ', {k}, '\"}}}}</script>')", "''")
    html = F.concat("html", notes, told)
    return fx.table(spark, sf, "pages").select("page_id", T.page_field_text(html, "event-notes").alias("notes"), T.jsonld_organizer(html).alias("organizer"))


@query("withheld_places", "SELECT row_id, row_id % 5 < 4 AS withheld FROM listings")
def withheld_places(spark, sf):
    place = _case("row_id", "'Ask the marshal for the address'", "'DM us on Discord'", "concat(source, '''s house')", "'contact the seneschal, Main St'", "concat(clean_location, ' near the private road')")
    return fx.listings(spark, sf).select("row_id", P.is_address_withheld(place).alias("withheld"))


@query("street_lines", "SELECT row_id, CASE CAST(row_id % 4 AS INT) WHEN 0 THEN 'The Hall, ' || CAST(row_id + 1 AS VARCHAR) || ' Oak Street, Town, TX 75001' WHEN 1 THEN CAST(row_id + 1 AS VARCHAR) || ' Oak Street, Town, TX 75001' WHEN 2 THEN CAST(row_id + 1 AS VARCHAR) || ' Elm Road, Town, OH 44101' END AS address FROM listings")
def street_lines(spark, sf):
    n = "cast(row_id + 1 as string)"
    text = _case("row_id", f"concat('Join us.\\nThe Hall\\n', {n}, ' Oak Street\\nTown, TX 75001\\nBye')", f"concat('We meet at:\\n', {n}, ' Oak Street\\n\\nTown, TX 75001')", f"concat('News\\n', {n}, ' Elm Road, Town, OH 44101')", "'no place\\nat all'")
    return fx.listings(spark, sf).select("row_id", loc.address_from_text(text).alias("address"))


@query("second_addresses", "SELECT row_id, CASE WHEN row_id % 2 = 0 AND row_id % 3 <> 0 THEN CAST(row_id + 1 AS VARCHAR) || ' New Road, Town, TX 75001' END AS second_address FROM listings")
def second_addresses(spark, sf):
    n = "concat(cast(row_id + 1 as string), ' New Road, Town, TX 75001')"
    df = fx.listings(spark, sf).withColumns({"geocode_status": _case("row_id", "'failed'", "'ok'"), "clean_location": _case("row_id", f"upper({n})", "clean_location", "clean_location"), "description": F.expr(f"concat('Moved to ', {n}, ' this year')")})
    return L.second_address(df).select("row_id", "second_address")


@query("prior_pins", "SELECT group_id, CASE WHEN group_id % 3 <> 0 THEN lat WHEN group_id % 2 = 0 THEN lat + 1 END AS lat FROM groups_reg")
def prior_pins(spark, sf):
    g = fx.groups(spark, sf)
    prior = g.select("group_name", F.when(F.expr("group_id % 2 = 0"), F.col("lat") + 1).alias("lat"), "lng")
    now = g.withColumns({c: F.when(F.expr("group_id % 3 <> 0"), F.col(c)) for c in ("lat", "lng")})
    return J.adopt_prior_pins(now, prior, ["group_name"]).select("group_id", "lat")


@query("group_seats", "SELECT group_id, CASE WHEN group_id % 2 = 0 THEN 'Seat ' || CAST(group_id AS VARCHAR) ELSE 'unknown' END AS seat FROM groups_reg")
def group_seats(spark, sf):
    g = fx.groups(spark, sf)
    seats = g.where("group_id % 2 = 0").select(F.concat(F.upper("group_name"), F.lit("!")).alias("name"), F.concat(F.lit("Seat "), F.col("group_id").cast("string")).alias("seat"))
    return L.lookup_seat(g, "group_name", seats, "unknown").select("group_id", "seat")


@query("loaded_rules", "SELECT s_suppkey AS rule_seq, CASE CAST(s_suppkey % 5 AS INT) WHEN 1 THEN 'unknown kind' WHEN 2 THEN 'a title needs a source' WHEN 3 THEN 'names no event' END AS reason FROM supplier WHERE s_suppkey % 7 <> 0", raw=True)
def loaded_rules(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet")
    match = F.when(F.expr("s_suppkey % 7 = 0"), "# a note").otherwise(_case("s_suppkey", "'https://example.org/x'", "'A title'", "'A title'", "' '", "'A title'"))
    raw = s.select(F.col("s_suppkey").alias("rule_seq"), _case("s_suppkey", "'event'", "'song'", "'event'", "'keyword'", "'keyword'").alias("kind"), match.alias("match"), _case("s_suppkey", "''", "'S'", "''", "'S'", "'S'").alias("source"))
    rules, rejects = C.load_rules(raw)
    return rules.select("rule_seq", F.lit(None).cast("string").alias("reason")).unionByName(rejects.select("rule_seq", "reason"))


@query("private_rules", "SELECT sha256('supplier|' || CAST(s_suppkey AS VARCHAR) || '|street') AS fingerprint, 3 AS words, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 90 AS DOUBLE) END AS lat FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0", raw=True)
def private_rules(spark, sf):
    """A fifth have no fingerprint, a seventh replace the phrase by itself, a third have no pin in range."""
    k = "cast(s_suppkey as string)"
    rules = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.expr(f"if(s_suppkey % 5 = 0, 'none', sha2(concat('supplier|', {k}, '|street'), 256))").alias("fingerprint"),
        F.lit("3").alias("words"),
        F.expr("if(s_suppkey % 3 = 0, '91', cast(s_suppkey % 90 as string))").alias("lat"),
        F.lit("10").alias("lng"),
        F.expr(f"if(s_suppkey % 7 = 0, concat('at Supplier ', {k}, ', Street'), 'hidden')").alias("replace_with"),
    )
    return X.load_private(stored(rules, "rules")).select("fingerprint", "words", "lat")


@query("private_cache", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'at [private] ok' ELSE 'fine ' || CAST(page_id AS VARCHAR) END AS value FROM pages WHERE page_id % 10 <> 0", raw=True)
def private_cache(spark, sf):
    k = "cast(page_id as string)"
    cache = fx.table(spark, sf, "pages").select("page_id", F.expr(f"concat('k', {k}, if(page_id % 10 = 0, ' 12 Secret Lane', ''))").alias("key"), F.expr(f"if(page_id % 3 = 0, 'at 12 Secret, Lane ok', concat('fine ', {k}))").alias("value"))
    rules = spark.createDataFrame([("12 secret lane",)], "p string").select(X.phrase_fingerprint("p").alias("f")).select("f.*", F.lit("").alias("scope"), F.lit("[private]").alias("replace_with"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"))
    return X.scrub_cache(cache, rules, "key", "value").select("page_id", "value")


@query("private_cache_repeats", "SELECT page_id, page_id % 4 AS lat, CASE WHEN page_id % 3 = 0 THEN 'at [private] near ' || CAST(page_id AS VARCHAR) WHEN page_id % 3 = 1 THEN 'a rather longer text, [private] of page ' || CAST(page_id AS VARCHAR) ELSE 'fine' END AS value FROM pages WHERE page_id % 4 <> 0", raw=True)
def private_cache_repeats(spark, sf):
    """Four keys for all rows, one of them private, and a column that the operator uses too."""
    k = "cast(page_id as string)"
    value = _case("page_id", f"concat('at 12 Secret, Lane near ', {k})", f"concat('a rather longer text, 12 secret lane of page ', {k})", "'fine'")
    cache = fx.table(spark, sf, "pages").select("page_id", F.expr("page_id % 4").alias("lat"), F.expr("if(page_id % 4 = 0, '12 secret lane', concat('key ', cast(page_id % 4 as string)))").alias("key"), value.alias("value"))
    rules = spark.createDataFrame([("12 secret lane",)], "p string").select(X.phrase_fingerprint("p").alias("f")).select("f.*", F.lit("").alias("scope"), F.lit("[private]").alias("replace_with"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"))
    return X.scrub_cache(cache, rules, "key", "value").select("page_id", "lat", "value")


@query("sorted_groups", "SELECT group_id, kingdom, group_name, row_number() OVER (ORDER BY kingdom, group_name, group_id) AS place FROM groups_reg")
def sorted_groups(spark, sf):
    """The place of each row in the sorted table: parts in order, and rows in order within them."""
    at = F.monotonically_increasing_id()
    df = stored(N.sorted_groups(fx.groups(spark, sf).withColumn("row_id", F.col("group_id"))).withColumn("at", at), "sorted-groups").withColumn("part", F.shiftright("at", 33))
    # one row for each part: how many rows come before it
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first")).select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return df.join(parts, "part").select("group_id", "kingdom", "group_name", (F.col("before") + F.col("at") - F.col("first") + 1).alias("place"))


@query("decoded_territories", "SELECT n_nationkey AS poly_id, r AS ring, e AS edge, CAST(n_nationkey + x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(n_nationkey + x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM nation, (VALUES (0, 0, 0, 0, 2, 0), (0, 1, 2, 0, 2, 1), (0, 2, 2, 1, 0, 1), (0, 3, 0, 1, 0, 0), (1, 0, 0.5, 0.25, 1.5, 0.25), (1, 1, 1.5, 0.25, 1.5, 0.75), (1, 2, 1.5, 0.75, 0.5, 0.25)) AS t(r, e, x1, y1, x2, y2)", raw=True)
def decoded_territories(spark, sf):
    step = lambda x, y: F.struct((x if isinstance(x, F.Column) else F.lit(float(x))).alias("dx"), F.lit(float(y)).alias("dy"))
    at = F.col("n_nationkey").cast("double")
    rings = F.array(F.array(step(at, 0), step(2, 0), step(0, 1), step(-2, 0)), F.array(step(at + 0.5, 0.25), step(1, 0), step(0, 0.5)))
    topology = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("poly_id"), F.col("n_name").alias("kingdom"), rings.alias("rings"))
    return G.territory_edges(topology).select("poly_id", "ring", "edge", "x1", "y1", "x2", "y2")


@query("assigned_territories", "SELECT n_nationkey, lpad(CAST(n_nationkey AS VARCHAR), CAST(CASE CAST(n_nationkey % 4 AS INT) WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE length(CAST(n_nationkey AS VARCHAR)) END AS INT), '0') AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'Parent' ELSE n_name END AS region FROM nation", raw=True)
def assigned_territories(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    rows = n.select("n_nationkey", F.col("n_nationkey").cast("string").alias("id"), _case("n_nationkey", "'county'", "'state'", "'cd'", "'country'").alias("type"), _case("n_nationkey", "'Parent'", "''").alias("parent"), F.col("n_name").alias("kingdom"))
    return G.territory_assignment(rows).select("n_nationkey", "id", "region")


@query("clipped_territories", ", b AS (SELECT poly_id FROM edges GROUP BY poly_id HAVING (max(x1) >= -100 AND min(x1) <= -80 AND max(y1) >= 30 AND min(y1) <= 40) OR poly_id NOT IN (0, 1, 2, 12, 13, 24)) SELECT poly_id, count(*) AS edges FROM edges WHERE poly_id IN (SELECT poly_id FROM b) GROUP BY poly_id")
def clipped_territories(spark, sf):
    return G.clip_polygons(fx.territory_edges(spark, sf), (-100, 30, -80, 40), [0, 1, 2, 12, 13, 24]).groupBy("poly_id").agg(F.count("*").alias("edges"))


@query("assigned_countries", "SELECT s_suppkey AS poly_id, CASE WHEN s_nationkey < 10 THEN 'nation ' || n_name WHEN n_regionkey < 3 THEN 'region ' || r_name END AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", raw=True)
def assigned_countries(spark, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    polys = read("supplier").join(read("nation"), F.expr("s_nationkey = n_nationkey")).join(read("region"), F.expr("n_regionkey = r_regionkey")).select(F.col("s_suppkey").alias("poly_id"), "n_name", "r_name")
    named = read("nation").where("n_nationkey < 10").select(F.col("n_name").alias("name"), F.concat(F.lit("nation "), "n_name").alias("region"))
    named = named.unionByName(read("region").where("r_regionkey < 3").select(F.col("r_name").alias("name"), F.concat(F.lit("region "), "r_name").alias("region")))
    return G.assign_countries(polys, named, ["n_name", "r_name"]).select("poly_id", "region")


@query("default_window", "SELECT row_id FROM listings WHERE CAST(start_ts AS DATE) BETWEEN DATE '1996-08-31' AND DATE '1997-02-28'")
def default_window(spark, sf):
    first, last = Q.default_window("1996-08-31")
    return fx.listings(spark, sf).where(F.to_date("start_ts").between(first, last)).select("row_id")


@query("failrate_alarm", f", p AS ({_PRIOR}) SELECT count(*) FILTER (WHERE geocode_status = 'failed') AS failed, count(*) AS tried, count(*) FILTER (WHERE geocode_status = 'failed') > 0.08 * count(*) AS alarm FROM p")
def failrate_alarm(spark, sf):
    return H.failrate_spike(_prior(fx.listings(spark, sf))).select("failed", "tried", "alarm")


@query("asymmetric_pairs", "WITH p AS (SELECT DISTINCT s_nationkey AS a, CAST((s_suppkey * 7) % 25 AS INT) AS b FROM supplier) SELECT a, b FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.a = p.b AND q.b = p.a)", raw=True)
def asymmetric_pairs(spark, sf):
    pairs = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_nationkey").alias("a"), F.expr("cast((s_suppkey * 7) % 25 as int)").alias("b")).distinct()
    return H.check_symmetric(pairs, "a", "b").select("a", "b")


@query("directory_groups", "SELECT 'Shire of Marsh ' || CAST(page_id AS VARCHAR) AS group_name, 'Town ' || CAST(page_id AS VARCHAR) || ', Ohio' AS location, page_id FROM pages WHERE page_id % 5 <> 0", raw=True)
def directory_groups(spark, sf):
    k = "cast(page_id as string)"
    entry = F.expr(f"concat('<p>Shire of Marsh ', {k}, ': ', if(page_id % 5 = 0, 'dormant since 2001', concat('Town ', {k}, ', Ohio')), '</p>')")
    return N.directory_groups(fx.table(spark, sf, "pages").withColumn("html", F.concat("html", entry))).drop("website")


@query("ingested_snapshots", "SELECT row_id, title FROM listings")
def ingested_snapshots(spark, sf):
    """Two snapshots of the listings, the second with all rows again, taken in as a stream."""
    folder = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    df = fx.listings(spark, sf)
    for part in (df.where("row_id % 2 = 0"), df):
        part.write.mode("append").parquet(f"{folder}/in")

    def each(batch, number):
        batch.select("row_id", "title").write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    ingest_snapshots(spark, f"{folder}/in", df.schema, f"{folder}/checkpoint", each, keys=["row_id", "title", "start_ts"], event_time="start_ts")
    return spark.read.parquet(f"{folder}/out").select("row_id", "title")


@query(
    "recurrence_rules",
    """WITH r AS (SELECT c_custkey, CAST(c_custkey % 5 AS INT) AS k, DATE '2026-01-01' + CAST(c_custkey % 28 AS INT) AS d FROM customer),
day AS (SELECT c_custkey, k, d, CAST(unnest(generate_series(CAST(d AS TIMESTAMP), TIMESTAMP '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS x FROM r),
hit AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY x) AS n FROM day WHERE CASE k WHEN 0 THEN date_diff('day', d, x) % 3 = 0 WHEN 1 THEN isodow(x) IN (2, 4) WHEN 2 THEN day(x) = day(d) AND month(x) % 2 = 1 WHEN 3 THEN day(x) = day(d) AND month(x) = month(d) ELSE isodow(x) = isodow(d) END)
SELECT c_custkey, CAST(x AS VARCHAR) AS occurs_on FROM hit WHERE x BETWEEN DATE '2026-01-10' AND DATE '2026-06-30' AND (k <> 0 OR n <= 20) AND (k <> 4 OR x <= DATE '2026-04-15')""",
    raw=True,
)
def recurrence_rules(spark, sf):
    """Daily with COUNT, weekly with BYDAY, every second month, yearly, weekly with UNTIL."""
    rule = _case("c_custkey", "'FREQ=DAILY;INTERVAL=3;COUNT=20'", "'FREQ=WEEKLY;BYDAY=TU,TH'", "'FREQ=MONTHLY;INTERVAL=2'", "'FREQ=YEARLY'", "'FREQ=WEEKLY;UNTIL=20260415T000000Z'")
    c = fx.table(spark, sf, "customer").select("c_custkey", F.expr("cast(date_add(date'2026-01-01', cast(c_custkey % 28 as int)) as timestamp_ntz)").alias("start_ts"), rule.alias("rrule"), F.array().cast("array<string>").alias("exdates"))
    return S.expand_recurrence(c, "2026-01-10", "2026-06-30").select("c_custkey", F.col("occurs_on").cast("string").alias("occurs_on"))


@query("promoted_by_group", ", t AS (SELECT l.row_id, calendar_type, is_virtual, CASE CAST(l.row_id % 3 AS INT) WHEN 0 THEN 'Council at ' || lower(regexp_replace(x.group_name, '^[A-Za-z]+ of ', '')) WHEN 1 THEN 'Council of the realm' ELSE 'Shire of Elsewhere moot' END AS title FROM listings l JOIN (SELECT kingdom, min(group_name) AS group_name FROM groups_reg GROUP BY kingdom) x ON l.kingdom = x.kingdom) SELECT row_id, CASE WHEN calendar_type = 'kingdom' AND is_virtual AND row_id % 3 <> 1 THEN 'baronial' ELSE calendar_type END AS calendar_type FROM t")
def promoted_by_group(spark, sf):
    """Online listings of a region that name one of its groups, or start with the kind of group."""
    groups = fx.groups(spark, sf)
    first = groups.groupBy("kingdom").agg(F.min("group_name").alias("first_name"))
    title = _case("row_id", "concat('Council at ', lower(regexp_replace(first_name, '^[A-Za-z]+ of ', '')))", "'Council of the realm'", "'Shire of Elsewhere moot'")
    df = fx.listings(spark, sf).join(first, "kingdom").withColumn("title", title)
    return L.promote_local(df, groups.select(F.col("kingdom").alias("region"), "group_name")).select("row_id", "calendar_type")


@query("entity_titles", "SELECT row_id, CASE CAST(row_id % 4 AS INT) WHEN 0 THEN 'arts sciences s' WHEN 1 THEN 'caf fair' WHEN 2 THEN 'lt b gt' ELSE 'q a unknown bogus' END AS title_key FROM listings")
def entity_titles(spark, sf):
    title = _case("row_id", "'Arts &amp; Sciences &#115;'", "'Caf&eacute;&nbsp;&hearts; Fair&#x21;'", "'&amp;lt; b &amp;gt;'", "'Q&#38;A; unknown &bogus;'")
    return fx.listings(spark, sf).select("row_id", T.normalize_title(title).alias("title_key"))


@query("expired_lookups", """, a AS (SELECT DISTINCT clean_location AS x, CAST(regexp_extract(clean_location, '^\\d+') AS INT) AS n FROM listings WHERE clean_location <> '')
SELECT l.row_id, CASE WHEN a.n % 3 = 0 THEN 'ok' WHEN a.n % 3 = 1 THEN '' WHEN a.n % 3 = 2 THEN 'failed' ELSE 'failed' END AS geo_status FROM listings l LEFT JOIN a ON l.clean_location = a.x""")
def expired_lookups(spark, sf):
    """All rungs were looked up: a third hit, a third missed 40 days ago, a third missed last week."""
    df = fx.listings(spark, sf)
    n = F.regexp_extract("clean_location", r"^\d+", 0).try_cast("int")
    rung = df.where("clean_location <> ''").select("clean_location", n.alias("n")).distinct().select("n", F.posexplode(L.query_ladder(F.col("clean_location"))).alias("i", "r"))
    # tails are shared by several addresses, so each rung is stored for its own address alone where it holds the number
    own = rung.where(F.col("r.query").rlike(r"^\d+ ")).select(F.col("r.query").alias("query"), F.when(F.expr("n % 3 = 0"), 40.0).alias("lat"), F.when(F.expr("n % 3 = 0"), -90.0).alias("lng"), F.when(F.expr("n % 3 = 1"), "1997-04-22").otherwise("1997-05-25").alias("looked_up"))
    tails = rung.where(~F.col("r.query").rlike(r"^\d+ ")).select(F.col("r.query").alias("query"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"), F.lit("1997-05-30").alias("looked_up"))
    return L.geocode_from_cache(df, own.unionByName(tails).distinct(), F.lit(True), "1997-06-01").select("row_id", "geo_status")


@query("stale_enriched", "SELECT row_id, CASE WHEN row_id % 2 = 1 THEN 'own' WHEN row_id % 3 = 0 THEN 'the new text of page ' || CAST(row_id AS VARCHAR) WHEN row_id % 3 = 1 THEN 'the old text of page ' || CAST(row_id AS VARCHAR) ELSE 'TBA' END AS description FROM listings")
def stale_enriched(spark, sf):
    """Pages read anew, failed with an old copy kept, and failed without one."""
    df = fx.listings(spark, sf).withColumns({"event_url": F.col("row_id").cast("string"), "description": _case("row_id", "'TBA'", "'own'")})
    told = lambda kind: F.concat(F.lit(f"the {kind} text of page "), F.col("row_id").cast("string"))
    pages = df.where("row_id % 3 <> 2").select(F.col("event_url").alias("url"), told("old").alias("text"), F.lit(1).alias("ts"))
    fetched = df.select(F.col("event_url").alias("url"), F.when(F.expr("row_id % 3 = 0"), told("new")).when(F.expr("row_id % 3 = 1"), "soon").alias("text"))
    return J.enrich_descriptions(df, pages, F.col("description") == "TBA", fetched=fetched).select("row_id", "description")


@query("non_event_titles", "SELECT row_id, row_id % 14 < 12 AS non_event FROM listings")
def non_event_titles(spark, sf):
    """A title for each pattern, and two that only look like them."""
    titles = ["Award deadline", "Quarterly reports due", "Submission due today", "Polling opens", "Registration closes", "Last day to enter", "Reminder: dues", "Due date of letters", "Cancelled fair", "busy", "Anna’s dental appointment", "Vet appointment", "Feast of deadlines", "Busy bees feast"]
    return fx.listings(spark, sf).select("row_id", P.is_non_event(_case("row_id", *[f"'{t}'" for t in titles])).alias("non_event"))


@query(
    "place_text_ranges",
    "WITH l AS (SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS d FROM orders) SELECT row_id, CASE WHEN row_id % 4 < 3 THEN CAST(d AS VARCHAR) END AS first_day, CAST(CASE CAST(row_id % 4 AS INT) WHEN 0 THEN d WHEN 1 THEN make_date(year(d), month(d), day(d + 1)) WHEN 2 THEN d + 40 END AS VARCHAR) AS last_day FROM l",
    raw=True,
)
def place_text_ranges(spark, sf):
    """Dates as pages write them: one day, two days of a month (backwards at its end), across months with full names; the last kind is no date."""
    text = _case("row_id", "date_format(start_ts, 'MMMM d, yyyy')", "concat(date_format(start_ts, 'MMM d'), ' - ', cast(day(date_add(to_date(start_ts), 1)) as string), ' ', cast(year(start_ts) as string))", "concat(date_format(start_ts, 'MMMM d yyyy'), ' – ', date_format(date_add(to_date(start_ts), 40), 'MMMM d yyyy'))", "'Feb 30 2026'")
    got = fx.listings(spark, sf).select("row_id", S.parse_date_range(text).alias("d"))
    return got.select("row_id", F.col("d.first").cast("string").alias("first_day"), F.col("d.last").cast("string").alias("last_day"))


_AS_KEY = "trim(regexp_replace(regexp_replace(lower(translate(text, '‘’“”', '''''\"\"')), '[^a-z0-9 ]', '', 'g'), ' {2,}', ' ', 'g'))"


@query("named_phrases", f"WITH d AS (SELECT doc_id, {_AS_KEY} AS t FROM documents), b AS (SELECT DISTINCT array_to_string(string_split({_AS_KEY}, ' ')[1:12], ' ') AS n FROM benchmark) SELECT doc_id, count(*) AS names, min(n) AS first_name FROM d JOIN b ON n <> '' AND contains(' ' || t || ' ', ' ' || n || ' ') GROUP BY doc_id", raw=True)
def named_phrases(spark, sf):
    """Names of up to twelve words, the beginnings of benchmark texts, in all documents."""
    start = F.array_join(F.slice(F.split(T.group_key("text"), " "), 1, 12), " ")
    names = spark.read.parquet(f"{sf}/benchmark.parquet").select(start.alias("name")).distinct().withColumn("name_id", F.col("name"))
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), T.group_key("text").alias("text"))
    return find_names(docs, names).groupBy(F.col("text_id").alias("doc_id")).agg(F.count("*").alias("names"), F.min("name_id").alias("first_name"))


@query(
    "territory_layers",
    f""", le AS ({fx.plain(fx.LAYERED)}), spots AS (SELECT DISTINCT round(lat, 4) AS la, round(lng, 4) AS ln FROM listings),
c AS (SELECT la, ln, layer, poly_id, kingdom, count(*) AS n FROM spots JOIN le ON (y1 > la) <> (y2 > la) AND ln < (x2 - x1) * (la - y1) / (y2 - y1) + x1 WHERE kingdom IS NOT NULL GROUP BY ALL),
h AS (SELECT la, ln, arg_min(kingdom, layer * 1000 + poly_id) AS territory FROM c WHERE n % 2 = 1 GROUP BY la, ln)
SELECT row_id, coalesce(territory, '') AS host_kingdom FROM listings LEFT JOIN h ON round(lat, 4) = la AND round(lng, 4) = ln""",
)
def territory_layers(spark, sf):
    """Counties with holes before nations; a county that is not assigned leaves its points to the nation."""
    edges = fx.run_sql(spark, sf, fx.LAYERED)
    return G.host_region(fx.listings(spark, sf), edges, "layer").select("row_id", "host_kingdom")


@query(
    "assigned_in_order",
    """WITH RECURSIVE c AS (SELECT page_id AS g, 'feed' || CAST((page_id * 7 + k * k * 13) % 90 AS VARCHAR) AS feed, CAST((page_id * (k + 3)) % 5 AS INT) AS up FROM pages, (VALUES (0), (1), (2), (3)) AS t(k)),
w AS (SELECT g, row_number() OVER (ORDER BY g) AS i, list(feed ORDER BY up DESC, feed DESC) AS wish FROM (SELECT g, feed, max(up) AS up FROM c GROUP BY g, feed) GROUP BY g),
r AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS BIGINT) AS g, CAST(NULL AS VARCHAR) AS feed
  UNION ALL SELECT w.i, CASE WHEN x IS NULL THEN used ELSE list_append(used, x) END, w.g, x FROM (SELECT w.i, w.g, r.used, list_filter(w.wish, lambda f: NOT list_contains(r.used, f))[1] AS x FROM r JOIN w ON w.i = r.i + 1) w)
SELECT feed, g AS group_id FROM r WHERE feed IS NOT NULL""",
    raw=True,
)
def assigned_in_order(spark, sf):
    """Four feeds for each page, ninety in all: most groups do not get their first wish, and many none."""
    c = fx.table(spark, sf, "pages").select(F.col("page_id").alias("group_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    feed = F.expr("concat('feed', cast((group_id * 7 + k * k * 13) % 90 as string))")
    return N.assign_feeds(c.select("group_id", feed.alias("feed"), F.lit("own").alias("verdict"), F.expr("cast((group_id * (k + 3)) % 5 as int)").alias("upcoming"), F.lit(0).alias("with_location")))


@query("ragged_rows", "SELECT 'whole' AS kind, 3 AS fields, count(*) AS n, sum(row_id) AS ids FROM listings WHERE row_id % 9 <> 4 AND row_id % 11 <> 5 UNION ALL SELECT 'ragged', CASE WHEN row_id % 9 = 4 THEN 2 ELSE 4 END, count(*), sum(row_id) FROM listings WHERE row_id % 9 = 4 OR row_id % 11 = 5 GROUP BY ALL")
def ragged_rows(spark, sf):
    """Listings as quoted lines, a ninth of them a field short, an eleventh a field long; titles hold commas and quotes."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    title = F.concat(F.col("title"), F.lit(', "so called"'))
    fields = F.when(F.expr("row_id % 9 = 4"), F.array(F.col("row_id").cast("string"), title)).when(F.expr("row_id % 11 = 5"), F.array(F.col("row_id").cast("string"), title, F.col("source"), F.lit("more"))).otherwise(F.array(F.col("row_id").cast("string"), title, F.col("source")))
    line = F.array_join(F.transform(fields, quoted), ",").alias("value")
    head = F.lit('"row_id","title","source"').alias("value")
    # a file for each partition, each with a header
    rows = fx.listings(spark, sf).repartition(8, "row_id").select(F.spark_partition_id().alias("p"), line)
    lines = rows.withColumn("o", F.lit(1)).unionByName(rows.select("p").distinct().select("p", head, F.lit(0).alias("o")))
    lines.repartition(8, "p").sortWithinPartitions("p", "o").select("p", "value").write.partitionBy("p").text(folder)
    good, bad = S.read_listings(spark, folder, ["row_id", "title", "source"])
    whole = good.groupBy().agg(F.count("*").alias("n"), F.sum(F.col("row_id").cast("long")).alias("ids")).select(F.lit("whole").alias("kind"), F.lit(3).cast("long").alias("fields"), "n", "ids")
    id_ = F.regexp_extract("line", r'^"(\d+)"', 1).cast("long")
    return whole.unionByName(bad.groupBy("fields").agg(F.count("*").alias("n"), F.sum(id_).alias("ids")).select(F.lit("ragged").alias("kind"), "fields", "n", "ids"))


@query(
    "stored_ingest",
    """, a AS (SELECT * FROM listings WHERE row_id % 2 = 0), b AS (SELECT * FROM listings WHERE source <> 'Kingdom of ASIA' AND row_id % 3 <> 0),
f AS (SELECT title, start_ts, clean_location, lat FROM a QUALIFY row_number() OVER (PARTITION BY title, start_ts, clean_location ORDER BY row_id) = 1)
SELECT b.row_id, f.lat, CASE WHEN f.lat IS NULL THEN '' ELSE 'ok' END AS geocode_status, FALSE AS carried, '' AS finding FROM b LEFT JOIN f ON b.title = f.title AND b.start_ts = f.start_ts AND b.clean_location = f.clean_location
UNION ALL SELECT row_id, lat, 'ok', TRUE, 'failed' FROM a WHERE source NOT IN (SELECT source FROM b) AND CAST(start_ts AS DATE) >= DATE '1996-01-01'""",
)
def stored_ingest(spark, sf):
    """Two snapshots as a stream: the second has no pins, and one feed delivers nothing."""
    folder = f"{shared_folder(spark)}/listings-{uuid.uuid4().hex}"
    df = fx.listings(spark, sf).withColumns({"geocode_status": F.lit("ok"), "location_specificity": F.lit("")})
    bare = {"lat": F.lit(None).cast("double"), "lng": F.lit(None).cast("double"), "geocode_status": F.lit("")}
    for k, part in enumerate((df.where("row_id % 2 = 0"), df.where("source <> 'Kingdom of ASIA' and row_id % 3 <> 0").withColumns(bare))):
        part = part.withColumn("fetched_at", F.lit(k))
        part.write.mode("append").parquet(f"{folder}/in")
        ingest_listings(spark, f"{folder}/in", part.schema, folder, df.select("source").distinct(), "1996-01-01")
    last = history(spark, folder).where("version = 1").groupBy("source").agg(F.max("finding").alias("finding"))
    return current_listings(spark, folder).join(last, "source").select("row_id", "lat", "geocode_status", "carried", "finding")


@query(
    "overlapping_listings",
    """, w AS (SELECT row_id, kingdom, title, calendar_type, CAST(start_ts AS DATE) AS s, CAST(end_ts AS DATE) AS e FROM listings WHERE title IN ('Lilies War', 'Gulf Wars XXXV'))
SELECT a.row_id, count(*) AS meets, sum(b.row_id) AS ids FROM w a JOIN w b ON a.kingdom = b.kingdom AND a.title = b.title AND a.s <= b.e AND a.e >= b.s WHERE a.calendar_type = 'baronial' AND b.calendar_type = 'kingdom' GROUP BY a.row_id""",
)
def overlapping_listings(spark, sf):
    """Local listings of large events, and the region's that run at the same time."""
    w = fx.listings(spark, sf).where("title in ('Lilies War', 'Gulf Wars XXXV')").select("row_id", "kingdom", "title", "calendar_type", F.to_date("start_ts").alias("first"), F.to_date("end_ts").alias("last"))
    side = lambda kind, name: w.where(f"calendar_type = '{kind}'").withColumnRenamed("row_id", name).drop("calendar_type")
    pairs = D.interval_overlap(side("baronial", "left_id"), side("kingdom", "right_id"), ["kingdom", "title"])
    return pairs.groupBy(F.col("left_id").alias("row_id")).agg(F.count("*").alias("meets"), F.sum("right_id").alias("ids"))


@query(
    "directory_kinds",
    """SELECT CASE CAST(page_id % 3 AS INT) WHEN 0 THEN 'Barony of Fell ' WHEN 1 THEN 'Shire of Fen ' ELSE 'Canton of Ford ' END || CAST(page_id AS VARCHAR) AS group_name,
 CASE WHEN page_id % 6 = 0 THEN 'Seat ' || CAST(page_id AS VARCHAR) WHEN page_id % 3 = 0 THEN 'Fell County, Ohio' WHEN page_id % 3 = 1 THEN 'Fen Town, TX' ELSE 'the Ford valley' END AS location, page_id,
 CASE WHEN page_id % 3 = 1 THEN '' ELSE 'https://group' || CAST(page_id AS VARCHAR) || '.example.net/' END AS website FROM pages""",
    raw=True,
)
def directory_kinds(spark, sf):
    """Three layouts by host: labels in a paragraph, a list with dashes, a table whose link has the name; half of the first have a seat."""
    k = "cast(page_id as string)"
    link = f"concat('<a href=\"https://group', {k}, '.example.net/\">')"
    entry = _case(
        "page_id",
        f"concat('<p><b>Barony of Fell ', {k}, '</b> Seneschal: Lady X. ', {link}, 'web</a> Located in: Fell County, Ohio. Ask us.</p>')",
        f"concat('<ul><li>Shire of Fen ', {k}, ' – Fen Town, TX</li></ul><p>See <a href=\"/own\">more</a></p>')",
        f"concat('<table><tr><td>', {link}, 'Canton of Ford ', {k}, '</a></td><td>covers the Ford valley</td></tr></table>')",
    )
    host = _case("page_id", "'https://one.example.org/groups'", "'https://two.example.org/groups'", "'https://three.example.org/groups'")
    pages = fx.table(spark, sf, "pages").select("page_id", host.alias("url"), F.concat(F.lit("<html><h1>Groups of the Barony and Shire kind</h1>"), entry).alias("html"))
    rules = spark.createDataFrame(
        [
            ("one.example.org", r"^({kind} of [\w' -]+?)\s+(?:Seneschal|Chatelain|Located in)\b", r"Located in[:\s]+([^.;\n]{4,200})"),
            ("two.example.org", r"^({kind} of [\w' -]+?)\s+[–-]\s", r"\s[–-]\s(.{4,200})$"),
            ("three.example.org", r"^({kind} of [\w' -]+?)\s+covers\b", r"\bcovers\s+(.{4,200})$"),
        ],
        "host string, name string, place string",
    )
    seats = fx.table(spark, sf, "pages").where("page_id % 6 = 0").select(F.expr(f"concat('barony of FELL ', {k})").alias("name"), F.expr(f"concat('Seat ', {k})").alias("seat"))
    return N.directory_groups(pages, rules, seats)


#: Latitudes and longitudes of listings as links write them; the first form has two pins, of which the surer counts.
_PIN_FORMS = [
    ("concat('https://www.google.com/maps/place/x/@1.5,2.5,17z/data=!3m1!3d', la, '!4d', ln)", "lat"),
    ("concat('https://maps.google.com/maps?daddr=', la, '%2C', ln)", "lat"),
    ("concat('https://www.openstreetmap.org/?mlat=', la, '&amp;mlon=', ln)", "lat"),
    ("concat('https://www.google.com/maps/@', la, ',', ln, ',12z')", "lat"),
    ("concat('https://www.openstreetmap.org/#map=9/', la, '/', ln)", "lat"),
    ("concat('https://x.example.org/?to=https%3A%2F%2Fmaps.google.com%2F%3Fq%3D', la, '%2C', ln)", "lat"),
    ("concat('https://maps.google.com/maps?q=99', la, ',', ln, '#map=9/', la, '/', ln)", "lat"),
    ("concat('https://www.google.com/maps/place/', la, '+', ln)", "NULL"),
    ("concat('https://maps.app.goo.gl/', CAST(row_id % 70 AS STRING))", "10 + row_id % 70"),
]


@query("map_link_pins", "SELECT row_id, round(CAST(CASE CAST(row_id % 9 AS INT) " + " ".join(f"WHEN {i} THEN {v}" for i, (_, v) in enumerate(_PIN_FORMS)) + " END AS DOUBLE), 4) AS pin_lat, CASE WHEN row_id % 9 = 7 THEN '' ELSE 'ok_published' END AS geocode_status FROM listings")
def map_link_pins(spark, sf):
    """Five ways to write a pin, also quoted within another link, beside one that is out of range, and behind a short link."""
    number = {"la": F.format_string("%.5f", "lat"), "ln": F.format_string("%.5f", "lng")}
    link = _case("row_id", *[f for f, _ in _PIN_FORMS])
    df = fx.listings(spark, sf).withColumns(number).select("row_id", F.concat(F.lit("Park, see ("), link, F.lit(")")).alias("location"), F.lit("").alias("description"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"), F.lit("").alias("geocode_status"))
    resolved = spark.range(70).select(F.concat(F.lit("https://maps.app.goo.gl/"), F.col("id").cast("string")).alias("short"), F.concat(F.lit("https://www.google.com/maps/@"), (F.col("id") + 10).cast("string"), F.lit(".0,5.0,9z")).alias("full"))
    return L.published_prepass(df, resolved).select("row_id", F.round("lat", 4).alias("pin_lat"), "geocode_status")


_LAYOUT_SQL = """WITH n AS (SELECT max(page_id) + 1 AS n FROM pages),
e AS (SELECT page_id, 'Fair ' || CAST(o_orderkey % 40 AS VARCHAR) || ' & more' AS title, CAST(o_orderdate AS DATE) AS d, 'Hall ' || CAST(o_orderkey % 7 AS VARCHAR) AS location FROM orders, n JOIN pages p ON p.page_id = o_orderkey % n)
SELECT layout, title, CAST(d AS VARCHAR) AS start_day, min(page_id) AS page_id, arg_min(location, (page_id, location)) AS location FROM e, (VALUES ('microdata'), ('plugin'), ('addlink')) AS t(layout) GROUP BY layout, title, d"""


@query("page_layouts", _LAYOUT_SQL, raw=True)
def page_layouts(spark, sf):
    """Pages of many events each in three layouts; an event that several pages list counts once, from the first of them."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    n = pages.agg(F.max("page_id")).first()[0] + 1
    e = spark.read.parquet(f"{sf}/orders.parquet").select((F.col("o_orderkey") % n).alias("page_id"), F.concat(F.lit("Fair "), (F.col("o_orderkey") % 40).cast("string"), F.lit(" &amp; more")).alias("t"), F.to_date("o_orderdate").alias("d"), F.concat(F.lit("Hall "), (F.col("o_orderkey") % 7).cast("string")).alias("p"))
    day = lambda f: F.date_format("d", f)
    forms = {
        "microdata": F.concat(F.lit('<div itemscope><span itemprop="name">'), "t", F.lit('</span><meta itemprop="startDate" content="'), day("yyyy-MM-dd"), F.lit('T00:00:00"><i itemprop="location">'), "p", F.lit("</i></div>")),
        "plugin": F.concat(F.lit('<article><h3 class="x event-title y"><a href="/e">'), "t", F.lit('</a></h3><time class="t" datetime="'), day("yyyy-MM-dd"), F.lit('">soon</time><b class="event-venue">'), "p", F.lit("</b></article>")),
        "addlink": F.concat(F.lit('<a href="https://calendar.google.com/calendar/render?action=TEMPLATE&text='), F.url_encode(F.replace("t", F.lit("&amp;"), F.lit("&"))), F.lit("&dates="), day("yyyyMMdd"), F.lit("&location="), F.url_encode("p"), F.lit('">add</a>')),
    }
    out = None
    for layout, form in forms.items():
        html = e.groupBy("page_id").agg(F.array_join(F.collect_list(form), "\n").alias("html"))
        events, _ = S.page_events(pages.join(html, "page_id").select("page_id", "url", "html"), layout)
        rows = events.select(F.lit(layout).alias("layout"), "title", F.to_date("start_ts").cast("string").alias("start_day"), "page_id", "location")
        out = rows if out is None else out.unionByName(rows)
    return out
