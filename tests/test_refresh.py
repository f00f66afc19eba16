from pyspark.sql import functions as F

from fairweave.functions.location import state_from_address
from fairweave.plans.pipeline import geocode, refresh, with_prior_pins

BOXES = "ord int, state string, lat_min double, lat_max double, lng_min double, lng_max double"
HOMES = "source string, states array<string>"
ROW = "row_id int, title string, source string, kingdom string, calendar_type string, is_virtual boolean, location string, clean_location string, description string, event_url string, lat double, lng double, geocode_status string, location_specificity string"


def rows(spark, *some):
    base = {"title": "Fair", "source": "K", "kingdom": "K", "calendar_type": "kingdom", "is_virtual": False, "location": "", "clean_location": "", "description": "", "event_url": "", "lat": None, "lng": None, "geocode_status": "", "location_specificity": ""}
    data = [tuple({"row_id": i, **base, **r}.values()) for i, r in some]
    day = F.to_timestamp_ntz(F.lit("2026-05-01 10:00:00"))
    return spark.createDataFrame(data, ROW).withColumns({"start_ts": day, "end_ts": day})


def around(spark):
    boxes = spark.createDataFrame([(1, "TX", 26.0, 36.0, -106.0, -94.0), (2, "OH", 38.0, 42.0, -84.0, -80.0)], BOXES)
    homes = spark.createDataFrame([("Shire of Oak", ["TX"]), ("K", ["TX"])], HOMES)
    return boxes, homes, state_from_address("clean_location", {"TX": "Texas", "OH": "Ohio"})


def test_prior_pins_are_checked(spark):
    now = rows(
        spark,
        (1, {"clean_location": "1 A St, Town, TX 75001"}),  # today's address is in Texas, the old pin in Ohio
        (2, {"clean_location": "2 A St, Town, TX 75001"}),  # set by hand: stays
        (3, {"source": "Shire of Oak", "calendar_type": "baronial", "clean_location": "The hall"}),  # not in its states
        (4, {"clean_location": "4 A St, Town, OH 44101"}),
        (5, {"clean_location": "sea"}),  # in no box: stays
        (6, {"clean_location": "new"}),
        (7, {"clean_location": "own", "lat": 30.0, "lng": -100.0, "geocode_status": "ok_published"}),
    )
    old = now.withColumns({"lat": F.when(F.col("row_id") == 5, 10.0).otherwise(40.0), "lng": F.when(F.col("row_id") == 5, 10.0).otherwise(-82.0), "geocode_status": F.when(F.col("row_id") == 2, "override").otherwise("ok")})
    homes = around(spark)[1].where("source <> 'K'")
    got = {r.row_id: (r.lat, r.geocode_status) for r in with_prior_pins(now, old.where("row_id <> 6"), around(spark)[0], homes, around(spark)[2]).collect()}
    assert got == {1: (None, "failed"), 2: (40.0, "override"), 3: (None, "failed"), 4: (40.0, "ok"), 5: (10.0, "ok"), 6: (None, ""), 7: (30.0, "ok_published")}


def test_rules_hold_for_carried_rows(spark):
    """A feed that failed: its rows of the last run get today's corrections, and a group's seat."""
    new = rows(spark, (1, {"title": "Here", "clean_location": "x"}))
    old = rows(spark, (10, {"title": "Crown", "source": "B", "clean_location": "old hall", "lat": 1.0, "lng": 1.0, "geocode_status": "ok"}), (11, {"title": "Moot at mill", "source": "B"}), (12, {"title": "Practice", "source": "Shire of Oak", "calendar_type": "baronial", "location_specificity": "vague"}), (13, {"title": "Gone", "source": "C"}))
    rules = spark.createDataFrame([(1, "", "B", "crown", None, "New hall, Town", None, None, "https://x.org")], "rule_seq int, url string, source string, title string, on_date date, address string, lat double, lng double, link string")
    keywords = spark.createDataFrame([(1, "B", "mill", 5.0, 6.0, "The mill")], "rule_seq int, source string, keyword string, lat double, lng double, address string")
    none = spark.createDataFrame([], "event_seq int, name string, keywords array<string>, host string")
    edges = spark.createDataFrame([], "poly_id int, kingdom string, ring int, edge int, x1 double, y1 double, x2 double, y2 double")
    private = spark.createDataFrame([], "fingerprint string, words int, scope string, replace_with string, lat double, lng double")
    seats = spark.createDataFrame([("Shire of Oak", 7.0, 8.0)], "group_name string, lat double, lng double")
    failed = spark.createDataFrame([("B",), ("Shire of Oak",)], "source string")
    out = {r.row_id: r for r in refresh(new, old, failed, none, edges, private, "2026-01-01", rules=rules, keywords=keywords, seats=seats).collect()}
    assert sorted(out) == [1, 10, 11, 12]
    assert (out[10].clean_location, out[10].lat, out[10].geocode_status, out[10].event_url) == ("New hall, Town", None, "", "https://x.org")
    assert (out[11].clean_location, out[11].lat, out[11].geocode_status) == ("The mill", 5.0, "override")
    assert (out[12].lat, out[12].geocode_status, out[12].location_specificity) == (7.0, "ok_fallback", "vague")


def test_cascade_from_address_to_pin(spark):
    df = rows(
        spark,
        (1, {"location": "see https://maps.app.goo.gl/abc", "clean_location": "1 A St, Town, TX 75001"}),
        (2, {"location": "at 40.12345, -82.12345", "clean_location": "2 A St, Town, TX 75001"}),  # stated, but in another state: the lookup counts
        (3, {"clean_location": "3 A St, Town, TX 75001"}),
        (4, {"clean_location": "4 A St, Town, TX 75001", "description": "Moved to 44 New Road, Town, TX 75001 this year"}),
        (5, {"title": "Fair (Shire of Oak)", "clean_location": "5 A St, Town, TX 75001"}),
        (6, {"clean_location": "6 A St, Town, TX 75001", "is_virtual": True}),
        (7, {"clean_location": "7 A St, Town, TX 75001", "lat": 1.0, "lng": 1.0, "geocode_status": "override"}),
        (8, {"clean_location": "8 A St, Town, TX 75001"}),  # never looked up: open
        (9, {"clean_location": "9 Somewhere", "event_url": "u9", "location_specificity": "vague"}),
        (10, {"clean_location": "far away"}),  # out of the region's states: taken last
    )
    cache = spark.createDataFrame(
        [(f"{i} A St, Town, TX 75001", lat, lng, "2026-01-01") for i, lat, lng in ((2, 31.0, -99.0), (3, 32.0, -99.0), (4, None, None), (5, None, None))]
        + [("44 New Road, Town, TX 75001", 33.0, -99.0, "2026-01-01"), ("75001", None, None, "2026-01-01"), ("A St, Town, TX 75001", None, None, "2026-01-01"), ("Town, TX 75001", None, None, "2026-01-01")]
        + [("9 Somewhere", None, None, "2026-01-01"), ("far away", 40.0, -82.0, "2026-01-01")],
        "query string, lat double, lng double, looked_up string",
    )
    groups = spark.createDataFrame([("K", "Shire of Oak", 34.0, -99.0)], "kingdom string, group_name string, lat double, lng double")
    resolved = spark.createDataFrame([("https://maps.app.goo.gl/abc", "https://www.google.com/maps/@30.5,-98.5,12z")], "short string, full string")
    organizers = spark.createDataFrame([("u9", "Oak")], "url string, organizer string")
    out = geocode(df, cache, groups, *around(spark), "2026-01-10", resolved=resolved, organizers=organizers)
    assert out.columns == df.columns
    got = {r.row_id: (r.lat, r.geocode_status) for r in out.collect()}
    assert got == {1: (30.5, "ok_published"), 2: (31.0, "ok"), 3: (32.0, "ok"), 4: (33.0, "ok"), 5: (34.0, "ok_group"), 6: (None, ""), 7: (1.0, "override"), 8: (None, ""), 9: (34.0, "ok_organizer"), 10: (40.0, "ok")}
