import datetime as dt
import hashlib

from pyspark.sql import functions as F

from fairweave.operators import discovery as N
from fairweave.operators import geo as G
from fairweave.operators import places as L
from fairweave.operators import privacy as X
from fairweave.operators import quality as H
from fairweave.operators import rules as C
from fairweave.operators import serve as Q
from fairweave.operators import state as J
from fairweave.plans.pipeline import refresh

from .test_dedup import frame, ids, row

SQUARE = [(1, "Outer", r, i, *map(float, e)) for r, ring in enumerate([[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]) for i, e in enumerate((*ring[k], *ring[(k + 1) % 4]) for k in range(4))]
EDGES = "poly_id int, kingdom string, ring int, edge int, x1 double, y1 double, x2 double, y2 double"


def fingerprint(text):
    w = text.lower().split()
    return hashlib.sha256("|".join(w).encode()).hexdigest(), len(w)


def test_polygons_with_holes(spark):
    edges = spark.createDataFrame(SQUARE + [(2, "Inner", 0, i, *map(float, e)) for i, e in enumerate([(4, 4, 5, 4), (5, 4, 5, 5), (5, 5, 4, 5), (4, 5, 4, 4)])], EDGES)
    points = spark.createDataFrame([(1.0, 1.0), (4.5, 4.5), (5.5, 5.5), (20.0, 1.0), (None, 1.0)], "lat double, lng double")
    got = {(r.lat, r.lng): r.territory for r in G.territory_join(points, edges).collect()}
    assert got == {(1.0, 1.0): "Outer", (4.5, 4.5): "Inner"}
    assert {r.poly_id for r in G.clip_polygons(edges, (7, 7, 20, 20)).collect()} == {1}


def test_delta_coded_polygons(spark):
    steps = spark.createDataFrame([(1, "A", [[(0.0, 0.0), (2.0, 0.0), (0.0, 2.0), (-2.0, 0.0), (0.0, -2.0)]])], "poly_id int, kingdom string, rings array<array<struct<dx:double,dy:double>>>")
    got = sorted((r.x1, r.y1, r.x2, r.y2) for r in G.territory_edges(steps).collect())
    assert got == [(0.0, 0.0, 2.0, 0.0), (0.0, 2.0, 0.0, 0.0), (2.0, 0.0, 2.0, 2.0), (2.0, 2.0, 0.0, 2.0)]
    t = spark.createDataFrame([("county", "123", "K", ""), ("state", "6", "K", "P")], "type string, id string, kingdom string, parent string")
    assert [(r.id, r.region) for r in G.territory_assignment(t).collect()] == [("00123", "K"), ("06", "P")]
    names = spark.createDataFrame([(1, None, "Utopia"), (2, "Nowhere", "None")], "poly_id int, a string, b string")
    assigned = G.assign_countries(names, spark.createDataFrame([("Utopia", "K")], "name string, region string"), ["a", "b"])
    assert {r.poly_id: r.region for r in assigned.collect()} == {1: "K", 2: None}


def test_private_phrases(spark):
    fp, n = fingerprint("12 hidden lane")
    rules = spark.createDataFrame([(fp, str(n), "R", "[private]", "40.0", "-80.0"), (fp, "x", "", "", "", ""), ("bad", "2", "", "", "", ""), (*map(str, fingerprint("secret hall")), "", "the secret hall", "99", "0")], "fingerprint string, words string, scope string, replace_with string, lat string, lng string")
    loaded = X.load_private(rules)
    assert [(r.words, r.lat) for r in loaded.collect()] == [(3, 40.0)]
    df = frame(spark, row(1, place="At 12 Hidden, Lane. and 12 hidden lane!"), row(2, place="12 hidden lane", kingdom="S"), row(3, place="12; hidden lane"), row(4, place=None)).withColumns({"lat": F.lit(1.0), "lng": F.lit(2.0)})
    got = {r.row_id: (r.clean_location, r.lat, r.privacy) for r in X.scrub_private(df, loaded, ["title", "clean_location"]).collect()}
    assert got == {1: ("At [private]. and [private]!", 40.0, "private"), 2: ("12 hidden lane", 1.0, ""), 3: ("12; hidden lane", 1.0, ""), 4: (None, 1.0, "")}
    again = X.scrub_private(X.scrub_private(df, loaded, ["clean_location"]).drop("privacy"), loaded, ["clean_location"])
    assert {r.row_id: r.clean_location for r in again.collect()}[1] == got[1][0]
    general = loaded.withColumn("scope", F.lit(""))
    cache = spark.createDataFrame([("12 hidden lane", "a"), ("k", "near 12 hidden lane x"), ("j", "b")], "key string, value string")
    assert sorted((r.key, r.value) for r in X.scrub_cache(cache, general, "key", "value").collect()) == [("j", "b"), ("k", "near [private] x")]


def test_rules(spark):
    raw = spark.createDataFrame([("event", "https://a.org/1", ""), ("event", "Feast", "R"), ("event", "Feast", ""), ("other", "x", "R"), ("event", "", ""), ("event", "# note", "")], "kind string, match string, source string")
    rules, rejects = C.load_rules(raw)
    assert rules.count() == 2 and sorted(r.reason for r in rejects.collect()) == ["a title needs a source", "names no event", "unknown kind"]


def test_carrying(spark):
    new = frame(spark, row(1, source="A"), row(2, source="B", title="X"))
    old = frame(spark, row(1, source="A"), row(3, source="B", title="X"), row(4, source="B", title="Y"), row(5, source="B", title="Z", day="2020-01-01"), row(6, source="C"))
    failed = spark.createDataFrame([("B",)], "source string")
    got = J.carry_forward(new, old, failed, "2026-01-01")
    assert sorted((r.row_id, r.carried) for r in got.collect()) == [(1, False), (2, False), (4, True)]
    assert ids(J.replace_partitions(old, new.where("source = 'B'"), ["source"])) == [1, 2, 6]
    cache = spark.createDataFrame([("u", "an old text of the page", None), ("v", "kept text of the page", 5)], "url string, text string, ts int")
    fresh = spark.createDataFrame([("u", "a new text of the page", 9), ("v", "short", 10)], "url string, text string, ts int")
    assert {r.url: r.text for r in J.upsert_cache(cache, fresh).collect()} == {"u": "a new text of the page", "v": "kept text of the page"}
    linked = frame(spark, row(1, text="TBA"), row(2, text="a real description")).withColumn("event_url", F.lit("u"))
    assert {r.row_id: r.description for r in J.enrich_descriptions(linked, cache, F.length("description") < 5).collect()} == {1: "an old text of the page", 2: "a real description"}
    pins = spark.createDataFrame([("g", None, None), ("h", 1.0, 2.0)], "k string, lat double, lng double")
    prior = spark.createDataFrame([("g", 3.0, 4.0), ("h", 9.0, 9.0)], "k string, lat double, lng double")
    assert {r.k: r.lat for r in J.adopt_prior_pins(pins, prior, ["k"]).collect()} == {"g": 3.0, "h": 1.0}


GROUPS = [(1, "Barony of Winter's Gate", "R", "Fairtown, TX", 30.0, -95.0), (2, "Shire of Oak", "R", "Oakville, TX", 31.0, -96.0)]
GROUP = "group_id int, group_name string, kingdom string, location string, lat double, lng double"


def test_location_cascade(spark):
    groups = spark.createDataFrame(GROUPS, GROUP)
    places = spark.createDataFrame([("TX", "Texas, USA"), ("Kingdom of the East", "New York")], "key string, place string")
    df = frame(
        spark,
        row(1, title="Fair"),
        row(2, title="Fair", text="held at 1 Oak Street, Town, TX 75001"),
        row(3, title="Fair (Shire of Oak)"),
        row(4, title="Winters Gate practice", kind="baronial"),
        row(5, title="Fair", kind="baronial"),
        row(6, title="Fair"),
        row(7, title="Fair", text="Hosted by Barony of Winter’s Gate | x"),
    )
    place = F.when(F.col("row_id") == 1, "Hall, 5 Elm Road, Town").when(F.col("row_id") == 6, "TX").otherwise("")
    got = {r.row_id: (r.address, r.step) for r in L.resolve_location(df.withColumn("location", place), groups, places).collect()}
    assert got == {1: ("5 Elm Road, Town", "own"), 2: ("1 Oak Street, Town, TX 75001", "description"), 3: ("Oakville, TX", "group"), 4: ("", "vague"), 5: ("", "vague"), 6: ("Texas, USA", "fallback"), 7: ("Fairtown, TX", "group")}
    seats = spark.createDataFrame([("Winters gate", "Fairtown")], "name string, seat string")
    named = spark.createDataFrame([("Winter’s Gate",), ("Else",)], "n string")
    assert [r.seat for r in L.lookup_seat(named, "n", seats, "none").collect()] == ["Fairtown", "none"]


def test_ladder_and_lookups(spark):
    df = frame(spark, row(1, place="Hall, 1 Oak St, Town, TX 75001"), row(2, place="Nowhere"), row(3, place="https://x.org")).withColumns({"lat": F.lit(None).cast("double"), "lng": F.lit(None).cast("double"), "geocode_status": F.lit("")})
    cache = spark.createDataFrame([("hall, 1 oak st, town, tx 75001", None, None), ("1 Oak St, Town, TX 75001", 50.0, 0.0), ("Town, TX 75001", 30.0, -95.0)], "query string, lat double, lng double")
    got = {r.row_id: (r.geo_lat, r.geo_status) for r in L.geocode_from_cache(df, cache, F.col("hit_lat") < 40).collect()}
    assert got == {1: (30.0, "ok_retry"), 2: (None, "failed"), 3: (None, "failed")}
    assert [r.query for r in L.geocode_worklist(df, cache, 10).collect()] == ["nowhere"]
    failed = df.withColumns({"geocode_status": F.lit("failed"), "description": F.lit("at 9 Elm Street, Town, TX 75002")})
    assert L.second_address(failed).first().second_address == "9 Elm Street, Town, TX 75002"
    told = df.withColumns({"location": F.when(F.col("row_id") == 1, "https://g.com/maps?q=40.5,-80.25").otherwise(""), "description": F.lit("GPS: 33.45 N, 84.10 W")})
    assert {r.row_id: r.lat for r in L.published_prepass(told).collect()} == {1: 40.5, 2: 33.45, 3: 33.45}
    sites = spark.createDataFrame([(7, 30.1, -95.0), (8, 31.0, -95.0)], "site_id int, lat double, lng double")
    points = spark.createDataFrame([(1, 30.0, -95.0), (2, 45.0, -95.0)], "row_id int, lat double, lng double")
    assert [(r.row_id, r.site_id) for r in L.nearest(points, sites, 80).collect()] == [(1, 7)]


def test_group_pins(spark):
    groups = spark.createDataFrame(GROUPS, GROUP)
    df = frame(spark, row(1, source="Shire of Oak", kind="baronial"), row(2, source="Unknown", kind="baronial")).withColumns({"lat": F.lit(0.0), "lng": F.lit(0.0), "geocode_status": F.lit(""), "location_specificity": F.lit("vague"), "event_url": F.lit("u")})
    got = {r.row_id: (r.lat, r.geocode_status, r.location_specificity) for r in L.pin_local_fallback(df, groups).collect()}
    assert got == {1: (31.0, "ok_fallback", "vague"), 2: (0.0, "", "")}
    organizers = spark.createDataFrame([("u", "Winter's Gate")], "url string, organizer string")
    assert {r.lat for r in L.organizer_pin(df, organizers, groups, (29, 31, -96, -94)).collect()} == {30.0}
    assert {r.lat for r in L.organizer_pin(df, organizers, groups, (50, 51, -96, -94)).collect()} == {0.0}


def test_health(spark):
    before = frame(spark, *[row(i, source="A", kind="baronial") for i in range(10)], *[row(20 + i, source="B") for i in range(10)], row(40, source="C"))
    now = frame(spark, *[row(20 + i, source="B") for i in range(4)], row(40, source="C"))
    registry = spark.createDataFrame([("A",), ("B",), ("D",), ("E",)], "source string")
    assert {r.source for r in H.zero_feeds(registry, now, ["E"]).collect()} == {"A", "D"}
    assert {(r.source, r.now) for r in H.feed_drop(now, before).collect()} == {("A", 0), ("B", 4)}
    assert H.total_drop(now, before).first().alarm
    assert [r.source for r in H.local_silent(now, before).collect()] == ["A"]
    status = now.withColumn("geocode_status", F.when(F.col("row_id") == 40, "failed").when(F.col("row_id") == 20, "skipped").otherwise("ok"))
    spike = H.failrate_spike(status).first()
    assert (spike.failed, spike.tried, spike.alarm) == (1, 4, True)
    assert {r.source: r.sample for r in H.samples(now, "source", 2).collect()} == {"B": ["Feast", "Feast"], "C": ["Feast"]}
    files = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), dt.datetime(2027, 1, 1)), ("b", dt.datetime(2026, 4, 20), dt.datetime(2026, 5, 5)), ("c", dt.datetime(2026, 4, 20), dt.datetime(2027, 1, 1))], "file string, stamp timestamp_ntz, start_ts timestamp_ntz")
    assert {r.file: r.reason for r in H.stale_files(files, "2026-05-01").collect()} == {"a": "not updated", "b": "runs out"}
    assert H.state_snapshot(now, "r1").count() == 2
    assert H.check_schema(now.select("row_id", "title"), ["row_id", "name", "x"]).count() == 2
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "x string, y string")
    assert [(r.x, r.y) for r in H.check_symmetric(pairs, "x", "y").collect()] == [("a", "c")]
    pins = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, None), (3, 91.0, 0.0), (4, None, None)], "row_id int, lat double, lng double")
    assert ids(H.check_coordinates(pins)) == [2, 3]


def test_serving(spark):
    df = frame(spark, row(1), row(2, online=True, kind="baronial", source="Barony of Winter's Gate"), row(3, online=True)).withColumns({"lat": F.lit(30.0), "lng": F.lit(-95.0)})
    groups = spark.createDataFrame(GROUPS, GROUP)
    assert ids(Q.search(df, "feast", online=True, kind="kingdom")) == [3]
    assert ids(Q.local_online_in_view(df, groups, (29, 31, -96, -94))) == [2, 3]
    assert ids(Q.local_online_in_view(df, groups, (50, 51, -96, -94))) == [3]
    assert [r.group_id for r in Q.groups_without_listings(groups, df).collect()] == [2]
    assert str(Q.coverage_horizon(df).first().through) == "2026-05-02"
    first, last = Q.default_window("2026-01-15")
    r = df.select(first.alias("a"), last.alias("b")).first()
    assert (str(r.a), str(r.b)) == ("2026-01-15", "2026-07-15")
    assert [r.group_id for r in G.nearest_groups(groups, (29, 30.5, -96, -94)).collect()] == [1]


def test_discovery(spark):
    import base64

    eid = base64.urlsafe_b64encode(b"ev1 club@g").decode().rstrip("=")
    cid = base64.urlsafe_b64encode(b"second@group.calendar.google.com").decode().rstrip("=")
    html = f'<iframe src="https://calendar.google.com/calendar/embed?ctz=x&amp;src=first%40group.calendar.google.com"></iframe><a href="https://x?cid={cid}">a</a><a href="https://www.google.com/calendar/event?eid={eid}">b</a><a href="https://calendar.google.com/calendar/ical/third%40gmail.com/public/basic.ics">c</a><link href="/wp-content/plugins/my-calendar/x.css">'
    pages = spark.createDataFrame([(1, "https://a.org/p", html)], "page_id int, url string, html string")
    got = [(r.kind, r.feed) for r in N.feed_candidates(pages).collect()]
    assert [f for k, f in got if k == "calendar"] == ["first@group.calendar.google.com", "second@group.calendar.google.com", "third@gmail.com", "club@group.calendar.google.com"]
    assert ("mycal", "https://a.org/p") in got
    keys = spark.createDataFrame([("https://calendar.google.com/calendar/ical/A%40b.org/public/basic.ics",), ("tribe:https://www.x.org/",), ("A@b.org",)], "c string")
    assert [r.v for r in keys.select(N.feed_key(F.col("c")).alias("v")).collect()] == ["a@b.org", "tribe:x.org", "a@b.org"]
    cand = spark.createDataFrame([(1, "f", "own", 5, 1), (1, "g", "own", 5, 2), (2, "g", "own", 9, 9), (3, "h", "empty", 0, 0)], "group_id int, feed string, verdict string, upcoming int, with_location int")
    assert {r.group_id: r.feed for r in N.best_feed(cand).collect()} == {1: "g", 2: "g"}
    assert {r.feed: r.group_id for r in N.assign_feeds(cand).collect()} == {"g": 1}
    info = spark.createDataFrame([(1, "u", "<p>The Shire of Oak is located in Oak County, Texas. More.</p>"), (2, "u", "<li>Shire of Pine: Pine Town, OH</li><li>Canton of Elm: dormant since 2001</li><li>Shire of Pine: Elsewhere</li>")], "page_id int, url string, html string")
    groups = spark.createDataFrame(GROUPS, GROUP)
    assert {r.group_id: r.location for r in N.group_regions(info, groups).collect()} == {2: "Oak County, Texas"}
    assert {r.group_name: r.location for r in N.directory_groups(info).collect()} == {"Shire of Pine": "Pine Town, OH"}


def test_refresh_end_to_end(spark):
    fp, n = fingerprint("12 hidden lane")
    private = spark.createDataFrame([(fp, n, "", "[private]", None, None)], "fingerprint string, words int, scope string, replace_with string, lat double, lng double")
    events = spark.createDataFrame([(1, "Big War", ["big war"], "H", "Big site", 6, 1, 6, 9)], "event_seq int, name string, keywords array<string>, host string, place string, from_month int, from_day int, to_month int, to_day int")
    pin = {"lat": F.lit(1.0), "lng": F.lit(1.0)}
    new = frame(spark, row(1, title="Award deadline"), row(2, title="Big War", day="2026-06-01", days=8), row(3, place="12 hidden lane"), row(4, title="Old", day="2020-01-01")).withColumns(pin)
    old = frame(spark, row(9, source="B", title="Kept")).withColumns(pin)
    out = refresh(new, old, spark.createDataFrame([("B",)], "source string"), events, spark.createDataFrame(SQUARE, EDGES), private, "2026-01-01")
    got = {r.row_id: r for r in out.collect()}
    assert sorted(got) == [2, 3, 9]
    assert (got[2].clean_location, got[2].war_host, got[3].clean_location, got[3].lat, got[9].host_kingdom) == ("Big site", "Outer", "[private]", None, "Outer")


def test_refresh_with_all_its_inputs(spark):
    """Addresses from descriptions and groups, rules, aggregator copies, series, page texts, and a large event's own site."""
    base = {"location": F.lit(""), "description": F.lit(""), "event_url": F.lit(""), "is_aggregator": F.lit(False), "lat": F.lit(1.0), "lng": F.lit(1.0), "geocode_status": F.lit("ok")}
    rows = frame(
        spark,
        row(1, title="Spring Fair", source="K"),
        row(2, title="Fair of spring", source="Agg"),
        *[row(10 + i, title="Fighter moot", source="K", day=f"2026-05-{1 + 7 * i:02d}") for i in range(4)],
        row(20, title="Big War", source="H", day="2026-06-01", days=8),
        row(21, title="Big War at last", source="G", day="2026-06-02", days=7),
        row(30, title="Crown feast", source="K", day="2026-07-01"),
    ).withColumns(base)
    place = F.when(F.col("row_id").isin(1, 2), "Hall, 5 Main Street, Town, TX 75001").when(F.col("row_id") < 20, "7 Oak Road, Town, TX 75001").otherwise("TBD")
    told = F.when(F.col("row_id") == 20, "short").when(F.col("row_id") == 21, "the fullest of all descriptions").when(F.col("row_id") == 30, "Meet at 9 Elm Street, Town, TX 75001 please").otherwise("No description yet")
    rows = rows.withColumns({"location": place, "description": told, "is_aggregator": F.col("source") == "Agg", "event_url": F.when(F.col("row_id") == 1, "https://fair.example.org/x").otherwise("")})
    events = spark.createDataFrame([(1, "Big War", ["big war"], "H", "Big site", 31.0, -89.0, "https://war.example.org")], "event_seq int, name string, keywords array<string>, host string, place string, lat double, lng double, website string")
    rules = spark.createDataFrame([(1, "", "K", "crown feast", None, "", 1.5, 1.5, "https://feast.example.org")], "rule_seq int, url string, source string, title string, on_date date, address string, lat double, lng double, link string")
    pages = spark.createDataFrame([("https://fair.example.org/x", "what the fair's own page says of it", 1)], "url string, text string, ts long")
    groups = spark.createDataFrame(GROUPS, GROUP)
    out = refresh(
        rows,
        rows.drop("is_aggregator").limit(0),
        spark.createDataFrame([], "source string"),
        events,
        spark.createDataFrame(SQUARE, EDGES),
        spark.createDataFrame([], "fingerprint string, words int, scope string, replace_with string, lat double, lng double"),
        "2026-01-01",
        series=True,
        page_texts=pages,
        eligible=F.col("event_url").contains("fair.example.org"),
        groups=groups,
        places=spark.createDataFrame([("TX", "Texas")], "key string, place string"),
        rules=rules,
    )
    got = {r.row_id: r for r in out.collect()}
    assert sorted(got) == [1, 10, 20, 30]
    assert (got[1].clean_location, got[1].description) == ("5 Main Street, Town, TX 75001", "what the fair's own page says of it")
    assert got[10].title == "Fighter moot (RECURRING)" and got[10].description.endswith("[RECURRING — also on: 1 May 2026, 8 May 2026, 15 May 2026, 22 May 2026]")
    war = got[20]
    assert (war.clean_location, war.lat, war.lng, war.geocode_status, war.event_url, war.description) == ("Big site", 31.0, -89.0, "override", "https://war.example.org", "the fullest of all descriptions")
    assert (got[30].clean_location, got[30].lat, got[30].event_url) == ("9 Elm Street, Town, TX 75001", 1.5, "https://feast.example.org")


def test_ladder_has_postal_and_simplified_rungs(spark):
    ladder = lambda text: {r["step"]: r["query"] for r in spark.createDataFrame([(text,)], "a string").select(L.query_ladder(F.col("a")).alias("x")).first().x}
    canada = ladder("17 Larch Rd, Telkwa, BC, V0J 2X2, Canada")
    assert (canada["postal"], canada["postal_area"], canada["city_tail"]) == ("V0J 2X2, Canada", "V0J, Canada", "Telkwa, BC, Canada")
    assert ladder("the city mundanely known as Lubbock, Texas")["simplified"] in ("Lubbock, Texas", "Lubbock")
    assert "Birmingham" in ladder("Greater Birmingham area and Shelby County")["simplified"]
    assert ladder("Madera, Fresno, Kings Counties")["simplified"] == "Madera"
