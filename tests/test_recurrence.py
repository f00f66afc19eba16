"""Occurrences of many rules, against a count day by day."""

import datetime as dt
import itertools

from fairweave.sources import feeds as S

DAYS = ["MO", "TU", "WE", "TH", "FR", "SA", "SU"]


def by_hand(start, rule, exdates, lo, hi):
    f = dict(x.split("=") for x in rule.split(";"))
    step, until = int(f.get("INTERVAL", 1)), dt.datetime.strptime(f["UNTIL"][:8], "%Y%m%d").date() if "UNTIL" in f else hi
    monday, out, x = start - dt.timedelta(start.weekday()), [], start
    while x <= min(until, hi):
        months = (x.year - start.year) * 12 + x.month - start.month
        ok = {
            "DAILY": (x - start).days % step == 0,
            "WEEKLY": (x - monday).days // 7 % step == 0 and DAYS[x.weekday()] in f.get("BYDAY", DAYS[start.weekday()]).split(","),
            "MONTHLY": x.day == start.day and months % step == 0,
            "YEARLY": x.day == start.day and months % (12 * step) == 0,
        }[f["FREQ"]]
        out += [x] if ok else []
        x += dt.timedelta(1)
    out = out[: int(f["COUNT"])] if "COUNT" in f else out
    return [x for x in out if x >= lo and x.strftime("%Y%m%d") not in exdates]


def test_windows_far_from_the_start(spark):
    starts = [dt.date(2019, 12, 31), dt.date(2020, 2, 29), dt.date(2025, 1, 8), dt.date(2026, 1, 31), dt.date(2026, 3, 1), dt.date(2027, 1, 1)]
    rules = [f"FREQ={f}{i}{c}" for f, i, c in itertools.product(["DAILY", "WEEKLY", "WEEKLY;BYDAY=MO,SU", "MONTHLY", "YEARLY"], ["", ";INTERVAL=3", ";INTERVAL=2000"], ["", ";COUNT=30", ";UNTIL=20260220T000000Z"])]
    rows = [(i, dt.datetime.combine(s, dt.time(10)), r, ["20260301"]) for i, (s, r) in enumerate(itertools.product(starts, rules))]
    df = spark.createDataFrame(rows, "i int, start_ts timestamp_ntz, rrule string, exdates array<string>")
    got = {}
    for r in S.expand_recurrence(df, "2026-01-10", "2026-06-30").collect():
        got.setdefault(r.i, []).append(r.occurs_on)
    lo, hi = dt.date(2026, 1, 10), dt.date(2026, 6, 30)
    for i, s, r, x in rows:
        assert sorted(got.get(i, [])) == by_hand(s.date(), r, x, lo, hi), (s, r)


def test_fields_of_a_rule_are_read_once(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1), "FREQ=DAILY", ["20260105"])], "start_ts timestamp_ntz, rrule string, exdates array<string>")
    plan = S.expand_recurrence(df, "2026-01-10", "2026-06-30")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") <= 12
