import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fairweave.sources import feeds as S
from fairweave.streaming.ingest import ingest_snapshots

from .test_dedup import SCHEMA, frame, ids, row

ICS = """BEGIN:VCALENDAR\r
BEGIN:VEVENT\r
UID:1\r
DTSTART;TZID=America/New_York:20260502T190000\r
DTEND:20260502T210000Z\r
SUMMARY:Fair\\, the first\r
LOCATION:1 Main St\\, To\r
 wn\r
RRULE:FREQ=WEEKLY;COUNT=4\r
EXDATE:20260509T190000\r
END:VEVENT\r
BEGIN:VEVENT\r
UID:2\r
SUMMARY:No start\r
END:VEVENT\r
BEGIN:VEVENT\r
UID:3\r
DTSTART;VALUE=DATE:20260601\r
SUMMARY:All day\r
END:VEVENT\r
END:VCALENDAR\r
"""


def test_calendar_files(spark, tmp_path):
    (tmp_path / "a.ics").write_text(ICS, newline="")
    (tmp_path / "b.ics").write_text("<html>blocked</html>")
    events, rejects = S.read_ics(spark, str(tmp_path))
    got = {r.uid: r for r in events.collect()}
    assert sorted(got) == ["1", "3"]
    assert (got["1"].title, got["1"].location, got["1"].start_ts) == ("Fair, the first", "1 Main St, Town", dt.datetime(2026, 5, 2, 19))
    assert got["3"].start_ts == dt.datetime(2026, 6, 1)
    assert sorted(r.reason for r in rejects.collect()) == ["no calendar", "no title or start"]
    days = S.expand_recurrence(events, "2026-01-01", "2026-12-31").where("uid = '1'")
    assert sorted(str(r.occurs_on) for r in days.collect()) == ["2026-05-02", "2026-05-16", "2026-05-23"]


def test_large_calendar_file_is_read_by_many_tasks(spark, tmp_path):
    """One file of many events: cut anywhere, each event is read once, and what holds for the file holds for all of them."""
    event = lambda i: f"BEGIN:VEVENT\r\nUID:{i}\r\nDTSTART:20260502T190000\r\nSUMMARY:Fair {i} &amp; m\r\n ore\r\nURL:https://x.org/?a={i}&amp;b=1\r\nEND:VEVENT\r\n"
    body = "BEGIN:VCALENDAR\r\nX-NAME:x\r\n" + "".join(map(event, range(6000))) + event(5) + "BEGIN:VEVENT\r\nUID:lost\r\nSUMMARY:never ends\r\nDTSTART:20260502\r\n" + event(6000) + "END:VCALENDAR\r\n"
    (tmp_path / "a.ics").write_text(f"<html><pre class=x>{body}</pre><p>tail</p></html>", newline="")
    (tmp_path / "b.ics").write_text("no calendar END:VEVENT BEGIN:VEVENT\nUID:9\nSUMMARY:x\nDTSTART:20260502\nEND:VEVENT", newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        events, rejects = S.read_ics(spark, str(tmp_path))
        assert spark.read.option("lineSep", "END:VEVENT").text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = events.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.uid for r in got) == sorted([*map(str, range(6001)), "lost"])
    assert len({r.row_id for r in got}) == 6002
    assert {(r.title, r.url) for r in got if r.uid == "77"} == {("Fair 77 & more", "https://x.org/?a=77&b=1")}
    assert [r.reason for r in rejects.collect()] == ["no calendar"]


def test_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n"1","x, ""y""","z"\n"2","short"\n"3","l","o","n, g"\n4,,\n')
    (tmp_path / "b.csv").write_text("a,b,c\n5,6,7\n")
    rows, ragged = S.read_listings(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted(tuple(r) for r in rows.collect()) == [("1", 'x, "y"', "z"), ("4", None, None), ("5", "6", "7")]
    assert sorted((r.line, r.fields) for r in ragged.collect()) == [('"2","short"', 2), ('"3","l","o","n, g"', 4)]


@pytest.mark.parametrize(
    ("rule", "start", "want"),
    [
        (None, "2026-01-05", ["2026-01-05"]),
        ("FREQ=DAILY;INTERVAL=2;COUNT=3", "2026-01-05", ["2026-01-05", "2026-01-07", "2026-01-09"]),
        ("FREQ=WEEKLY;BYDAY=MO,WE;UNTIL=20260115T000000Z", "2026-01-05", ["2026-01-05", "2026-01-07", "2026-01-12", "2026-01-14"]),
        ("FREQ=WEEKLY;INTERVAL=2;BYDAY=TU", "2026-01-08", ["2026-01-20", "2026-02-03", "2026-02-17"]),
        ("FREQ=MONTHLY", "2025-12-31", ["2026-01-31"]),
        ("FREQ=YEARLY", "2024-02-02", ["2026-02-02"]),
    ],
)
def test_recurrence(spark, rule, start, want):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(start), rule, [])], "start_ts timestamp_ntz, rrule string, exdates array<string>")
    assert [str(r.occurs_on) for r in S.expand_recurrence(df, "2026-01-01", "2026-02-28").orderBy("occurs_on").collect()] == want


def body(spark, value):
    return spark.createDataFrame([("src", json.dumps(value))], "source string, body string")


def test_json_records(spark):
    tribe = S.tribe_events(body(spark, {"events": [{"id": "7", "title": "A &amp; B", "description": "<b>x</b>", "start_date": "2026-05-02 10:00:00", "end_date": "2026-05-02 12:00:00", "url": "u", "venue": {"venue": "Hall", "address": "", "city": "Town", "state": "TX", "zip": "75001"}}]})).first()
    assert (tribe.title, tribe.location, tribe.start_ts) == ("A & B", "Hall, Town, TX, 75001", dt.datetime(2026, 5, 2, 10))
    texts = spark.createDataFrame([("https://example.org/event/9", "the page's text")], "url string, text string")
    calon = {r.uid: r for r in S.calon_events(body(spark, [{"id": "9", "name": "C", "start": "2026-05-02", "site_city": "Town"}, {"id": "8", "name": "D", "start": "2026-05-03", "host": "Oak", "website": "w"}]), texts).collect()}
    assert (calon["9"].description, calon["9"].end_ts, calon["8"].description) == ("the page's text", dt.datetime(2026, 5, 2), "Hosted by Oak | Website w")
    drach = S.drachenwald_events(body(spark, [{"type": "event", "status": "", "event-name": "E", "start-date": "2026-05-02", "site-name": "Hall", "town": "hall", "country": "X", "slug": "e"}, {"type": "event", "status": "Cancelled", "event-name": "F", "start-date": "2026-05-02"}, {"type": "news"}])).collect()
    assert [(r.title, r.location) for r in drach] == [("E", "Hall, X")]
    one = {"occur_id": "1", "occur_begin": "2026-05-02 10:00:00", "occur_end": "2026-05-02 11:00:00", "event_title": "G", "event_desc": "", "event_label": "Hall", "event_city": "Town", "event_approved": "1"}
    mycal = S.mycal_events(body(spark, {"2026-05-02": [one, dict(one)], "2026-05-03": [dict(one, occur_id="2", event_approved="0")]})).collect()
    assert [(r.uid, r.location) for r in mycal] == [("1", "Hall, Town")]


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", '<ul><li>2026-05-02: Fair</li><li>2026-05-03: Feast</li></ul>'), (2, "u", "nothing"), (3, "u", '<a href="https://c/calendar/render?action=T&text=Big%20Fair&dates=20260502T100000/x&location=Town">add</a>')], "page_id int, url string, html string")
    events, missed = S.page_events(pages, "list")
    assert sorted(r.title for r in events.collect()) == ["Fair", "Feast"] and sorted(r.page_id for r in missed.collect()) == [2, 3]
    (link,) = S.page_events(pages, "addlink")[0].collect()
    assert (link.title, link.start_ts, link.location) == ("Big Fair", dt.datetime(2026, 5, 2, 10), "Town")


@pytest.mark.parametrize(
    ("text", "want"),
    [("May 16 2026", ("2026-05-16", "2026-05-16")), ("December 19 - 21, 2026", ("2026-12-19", "2026-12-21")), ("Dec 19 2026 - Jan 2 2027", ("2026-12-19", "2027-01-02")), ("Feb 31 2026", None), ("soon", None)],
)
def test_date_ranges(spark, text, want):
    got = spark.createDataFrame([(text,)], "c string").select(S.parse_date_range("c").alias("v")).first().v
    assert (tuple(map(str, got)) if got else None) == want


def test_registry_and_summary(spark):
    regions = spark.createDataFrame([(" a ", "R", "Kingdom"), ("b", "S", "other"), ("none", "T", "kingdom")], "id string, source string, type string")
    locals_ = spark.createDataFrame([("c", "Shire", "Oak", None), ("", "Shire", "Elm", None)], "calendar_id string, type string, group string, is_aggregator boolean")
    got = S.feed_registry(regions, locals_)
    assert sorted((r.feed_id, r.source, r.calendar_type) for r in got.collect()) == [("a", "R", "kingdom"), ("c", "Shire of Oak", "baronial")]
    summary = {r.source: (r.events, r.online, r.unplaced) for r in S.fetch_summary(got, frame(spark, row(1), row(2, place="", online=True))).collect()}
    assert summary == {"R": (2, 1, 1), "Shire of Oak": (0, 0, 0)}
    urls = spark.createDataFrame([("https://calendar.google.com/calendar/embed?src=x%40y.org&z=1",), ("webcal://a.org/f.ics",), ("x@y.org",)], "c string")
    assert [r.v for r in urls.select(S.feed_url("c").alias("v")).collect()] == ["https://calendar.google.com/calendar/ical/x%40y.org/public/basic.ics", "https://a.org/f.ics", "https://calendar.google.com/calendar/ical/x%40y.org/public/basic.ics"]
    kinds = spark.createDataFrame([(ICS,), ('{"a":1}',), ("<html>",), (None,)], "c string")
    assert [(r.v.kind, r.v.events) for r in kinds.select(S.body_kind("c").alias("v")).collect()] == [("ics", 3), ("json", 0), ("html", 0), ("empty", 0)]


def test_sitemap(spark):
    body_ = spark.createDataFrame([("<url><loc>a</loc><lastmod>1</lastmod></url><url><loc>b</loc></url><url><loc>c</loc><lastmod>2</lastmod></url>",)], "body string")
    cache = spark.createDataFrame([("a", "1"), ("c", "1"), ("d", "1")], "url string, lastmod string")
    todo, kept = S.changed_pages(S.sitemap_rows(body_), cache)
    assert sorted(r.url for r in todo.collect()) == ["b", "c"] and sorted(r.url for r in kept.collect()) == ["a", "c"]


def test_sink(spark, tmp_path):
    df = frame(spark, row(1), row(2, kind="baronial")).withColumns({"lat": F.lit(1.0), "lng": F.lit(2.0)})
    S.write_listings(df, f"{tmp_path}/p")
    back = spark.read.parquet(f"{tmp_path}/p")
    assert sorted(back.columns) == sorted(S.SERVED) and ids(back.where("calendar_type = 'kingdom'")) == [1]
    S.write_listings(df, f"{tmp_path}/c", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").columns == S.SERVED
    assert S.static_practices(df, df.select("row_id", "title")).count() == 4


def test_snapshots_are_taken_once(spark, tmp_path):
    df = frame(spark, row(1), row(1), row(2, title="Else"))
    df.write.mode("append").parquet(f"{tmp_path}/in")
    got = []
    run = lambda: ingest_snapshots(spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/ck", lambda b, n: got.extend(r.row_id for r in b.collect()), keys=["row_id", "title", "start_ts"], event_time="start_ts")
    run()
    assert sorted(got) == [1, 2]
    frame(spark, row(2, title="Else"), row(3, title="New", day="2026-05-04")).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert sorted(got) == [1, 2, 3]
    assert SCHEMA
