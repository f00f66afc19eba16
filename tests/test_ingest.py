import datetime as dt

import pytest
from pyspark.sql import functions as F

from fairweave.streaming import ingest

ROW = "row_id int, title string, source string, kingdom string, calendar_type string, is_virtual boolean, clean_location string, lat double, lng double, geocode_status string, location_specificity string, fetched_at int"


def snapshot(spark, at, *some):
    """(row_id, title, source, lat) as of run ``at``."""
    rows = [(i, t, s, "K", "kingdom", False, "hall", lat, lat, "ok" if lat else "", "", at) for i, t, s, lat in some]
    day = F.to_timestamp_ntz(F.lit("2026-05-01 10:00:00"))
    return spark.createDataFrame(rows, ROW).withColumns({"start_ts": day, "end_ts": day})


def take_in(spark, folder, *snapshots):
    for s in snapshots:
        s.write.mode("append").parquet(f"{folder}/in")
        registry = spark.createDataFrame([("A",), ("B",), ("Z",)], "source string")
        ingest.ingest_listings(spark, f"{folder}/in", s.schema, folder, registry, dt.date(2026, 1, 1))


def table(spark, folder):
    return sorted((r.row_id, r.title, r.source, r.lat, r.carried) for r in ingest.current_listings(spark, folder).collect())


def steps(spark):
    first = snapshot(spark, 1, (1, "x", "A", 1.0), (2, "y", "A", 2.0), (3, "p", "B", 3.0), *[(10 + i, f"c{i}", "C", 1.0) for i in range(12)])
    second = snapshot(spark, 2, (21, "x", "A", None), (24, "new", "A", None), (30, "c0", "C", None))
    return first, second


WANT = [(3, "p", "B", 3.0, True), (21, "x", "A", 1.0, False), (24, "new", "A", None, False), (30, "c0", "C", 1.0, False)]


def test_table_follows_the_snapshots(spark, tmp_path):
    take_in(spark, tmp_path, *steps(spark))
    assert table(spark, tmp_path) == WANT
    found = {(r.version, r.source): (r.n, r.finding) for r in ingest.history(spark, str(tmp_path)).collect()}
    assert found == {(0, "A"): (2, ""), (0, "B"): (1, ""), (0, "C"): (12, ""), (0, "Z"): (0, "none"), (1, "A"): (2, ""), (1, "B"): (1, "failed"), (1, "C"): (1, "drop"), (1, "Z"): (0, "none")}


def test_only_the_newest_snapshot_of_a_batch_counts(spark, tmp_path):
    both = snapshot(spark, 1, (1, "old", "A", 1.0), (2, "kept", "B", 1.0)).unionByName(snapshot(spark, 2, (5, "new", "A", 2.0)))
    take_in(spark, tmp_path, both)
    assert [(r[0], r[1]) for r in table(spark, tmp_path)] == [(2, "kept"), (5, "new")]


@pytest.mark.parametrize("broken", ["counts", "history"])
def test_a_batch_that_breaks_off_is_run_again(spark, tmp_path, monkeypatch, broken):
    """The table has been written, or the history too, but the stream does not know yet."""
    first, second = steps(spark)
    take_in(spark, tmp_path, first)
    commit = ingest._commit

    def breaks(counts, store, n):
        if broken == "history":
            commit(counts, store, n)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_commit", breaks)
    with pytest.raises(Exception, match="lost"):
        take_in(spark, tmp_path, second)
    if broken == "counts":  # the version that broke off does not count
        assert len(table(spark, tmp_path)) == 15
    monkeypatch.setattr(ingest, "_commit", commit)
    registry = spark.createDataFrame([("A",), ("B",), ("Z",)], "source string")
    ingest.ingest_listings(spark, f"{tmp_path}/in", second.schema, str(tmp_path), registry, "2026-01-01")
    assert table(spark, tmp_path) == WANT
    assert ingest.history(spark, str(tmp_path)).select("version").distinct().count() == 2
