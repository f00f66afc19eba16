import datetime as dt

import pytest
from pyspark.sql import functions as F

from fairweave.operators import dedup as D

SCHEMA = "row_id long, title string, start_ts timestamp_ntz, end_ts timestamp_ntz, source string, kingdom string, calendar_type string, is_virtual boolean, clean_location string, description string"


def row(i, title="Feast", day="2026-05-02", days=0, source="R", kingdom="R", kind="kingdom", online=False, place="1 Main St, Town, TX 75001", text=""):
    start = dt.datetime.fromisoformat(day) if day else None
    return (i, title, start, start + dt.timedelta(days) if start else None, source, kingdom, kind, online, place, text)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def ids(df):
    return sorted(r.row_id for r in df.select("row_id").collect())


def test_one_row_for_a_day_place_and_type(spark):
    df = frame(
        spark,
        row(1, title="Feast (OUT OF KINGDOM)"),
        row(2, source="Other"),
        row(3),
        row(4, kind="baronial"),
        row(5, online=True),
        row(6, place=""),
        row(7, day=None),
        row(8, place=" 1 MAIN st, Town, TX 75001 "),
        row(9, day="2026-05-03"),
    )
    assert ids(D.dedupe_listings(df)) == [3, 4, 5, 6, 7, 9]
    assert ids(D.dedupe_listings(D.dedupe_listings(df))) == [3, 4, 5, 6, 7, 9]
    hosts = spark.createDataFrame([("TX", "Other")], "state string, region string")
    assert ids(D.dedupe_listings(df, hosts)) == [2, 4, 5, 6, 7, 9]
    assert ids(D.dedupe_listings(df.repartition(7))) == [3, 4, 5, 6, 7, 9]


@pytest.mark.parametrize(
    ("gaps", "want"),
    [([7, 7, 7], True), ([7, 7, 14], True), ([28, 56, 28], True), ([3, 4, 10, 14, 4, 7, 3], True), ([7, 30, 7], False), ([1, 1, 1], False), ([35, 35, 35], False), ([7], True), ([3], False), ([], False)],
)
def test_cadences(spark, gaps, want):
    days = [dt.date(2026, 1, 1)]
    for g in gaps:
        days.append(days[-1] + dt.timedelta(g))
    df = spark.createDataFrame([(days,)], "d array<date>")
    assert df.select(D.is_recurring(F.col("d")).alias("v")).first().v is want


def test_series_become_one_row(spark):
    weekly = [row(i, title="Practice", day=f"2026-05-{1 + 7 * i:02d}") for i in range(4)]
    df = frame(spark, *weekly, row(10, title="Practice", day=None), row(11, title="Other"), row(12, title="Practice", place="elsewhere", day="2026-05-01"))
    got = {r.row_id: r for r in D.merge_series(df, shown=3).collect()}
    assert sorted(got) == [0, 10, 11, 12]
    assert got[0].title == "Practice (RECURRING)"
    assert got[0].series_dates == [dt.date(2026, 5, 1), dt.date(2026, 5, 8), dt.date(2026, 5, 15)]
    assert got[12].series_dates is None


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("", "x", True), ("12 Oak St", "Hall, 12 Oak St, Town", True), ("12 Oak Street", "12 Oak Avenue", True), ("12 Oak St", "13 Oak St", False), (None, "x", True), ("Park", "Hall", False)],
)
def test_same_venue(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(D.same_venue(F.coalesce("a", F.lit("")), F.col("b")).alias("v")).first().v is want


def test_copies(spark):
    df = frame(
        spark,
        row(1, title="Bacon Bash 2026"),
        row(2, title="Bacon Bash", kind="baronial", source="G"),
        row(3, title="CAM Youth Practice", kind="baronial", source="G"),
        row(4, title="Bacon Bash", kind="baronial", source="G", day="2026-05-03"),
        row(5, title="Bacon Bash", kind="baronial", source="G", place="99 Elm Rd, Town"),
        row(6, title="Bacon Bash", kind="baronial", source="G", online=True),
    )
    assert ids(D.drop_local_copies(df)) == [1, 3, 4, 5, 6]
    flagged = df.withColumn("is_aggregator", F.col("row_id").isin(2, 3))
    out = D.drop_aggregator_copies(flagged)
    assert "is_aggregator" not in out.columns
    assert 2 not in ids(out) and 3 in ids(out)


def test_large_events(spark):
    events = spark.createDataFrame([(1, "Big War", ["big war"], "H", "Big site", 6, 1, 6, 9)], "event_seq int, name string, keywords array<string>, host string, place string, from_month int, from_day int, to_month int, to_day int")
    df = frame(
        spark,
        row(1, title="Big War XX", day="2026-06-02", days=6, source="A"),
        row(2, title="Big War", day="2026-06-01", days=8, source="H"),
        row(3, title="the BIG WAR", day="2026-06-04", days=4, source="G", kind="baronial"),
        row(4, title="Big War", day="2026-09-01", days=4, source="G", kind="baronial"),
        row(5, title="Big War", day="2026-06-01", days=1, source="A"),
        row(6, title="Biggest War", day="2026-06-01", days=8, source="A"),
    )
    got = {r.row_id: r for r in D.marquee_merge(df, events).collect()}
    assert sorted(got) == [2, 4, 5, 6]
    assert (got[2].merged, got[2].sources, got[2].clean_location, got[2].source) == (3, 3, "Big site", "H")
    listed = spark.createDataFrame([(1, 2026)], "event_seq int, year int")
    assert [str(r.start_date) for r in D.placeholders(events, listed, "2026-03-01").collect()] == ["2027-06-01"]
    assert D.placeholders(events, listed.limit(0), "2026-06-20").count() == 1


def test_modal_dates_keep_ties(spark):
    df = frame(spark, row(1), row(2), row(3, day="2026-05-03"), row(4, day="2026-05-03"), row(5, day="2026-05-09"))
    assert D.modal_dates(df, ["kingdom"]).count() == 2


def test_pages_and_overlap(spark):
    df = frame(spark, row(1), row(2), row(3, title="Else"))
    assert ids(D.dedupe_across_pages(df, ["title", "start_ts"])) == [1, 3]
    shared = D.overlap_with_known(df.withColumn("feed_id", F.lit("f")), df.where("row_id = 1")).collect()
    assert [(r.feed_id, r.source, r.shared) for r in shared] == [("f", "R", 2)]
