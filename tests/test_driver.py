"""Rows don't pass through the driver, however small their files are."""

from fairweave.operators import privacy as X
from fairweave.operators import state as J
from fairweave.operators.store import stored

from .test_operators import fingerprint


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_private_phrases_are_sent_to_the_rows(spark):
    rows = stored(spark.createDataFrame([(i, "at 7 Oak Lane" if i % 9 == 0 else "Park", "R", 1.0, 2.0) for i in range(2000)], "row_id long, place string, kingdom string, lat double, lng double"), "rows")
    rules = spark.createDataFrame([(*fingerprint("7 oak lane"), "", "[private]", None, None)], "fingerprint string, words int, scope string, replace_with string, lat double, lng double")
    out = X.scrub_private(rows, rules, ["place"])
    assert "Inner, BuildLeft" not in plan(out)
    assert out.where("place = 'at [private]' and privacy = 'private'").count() == 223


def test_the_new_run_is_not_broadcast(spark):
    shape = "row_id long, source string, title string, start_ts timestamp_ntz"
    new = stored(spark.sql("select id as row_id, 'A' as source, 'x' as title, timestamp_ntz'2026-01-01 10:00:00' as start_ts from range(1000)"), "new")
    prior = stored(spark.sql("select id + 5000 as row_id, 'A' as source, if(id = 1, 'y', 'x') as title, timestamp_ntz'2026-01-01 10:00:00' as start_ts from range(3)"), "prior")
    out = J.carry_forward(new, prior, spark.createDataFrame([("A",)], "source string"), "2026-01-01")
    assert "LeftAnti, BuildRight" not in plan(out)
    assert new.schema.simpleString() == spark.createDataFrame([], shape).schema.simpleString()
    assert [r.row_id for r in out.where("carried").collect()] == [5001]
