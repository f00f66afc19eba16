import datetime as dt
import random

import pytest

from fairweave.operators import dedup as D
from fairweave.operators import discovery as N


@pytest.mark.parametrize("days", [1, 7, 400])
def test_intervals_against_brute_force(spark, days):
    rng = random.Random(days)
    day = lambda n: dt.date(2026, 1, 1) + dt.timedelta(n)

    def some(n):
        out = []
        for i in range(n):
            a = rng.randrange(-50, 300)
            out.append((i, rng.choice("xy"), day(a) if rng.random() > 0.05 else None, day(a + rng.choice([0, 0, 3, 40, 200, -5])) if rng.random() > 0.1 else None))
        return out

    left, right = some(60), some(60) + [(99, None, day(0), day(9))]
    end = lambda r: max(r[2], r[3] or r[2])
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] and b[2] and a[2] <= end(b) and end(a) >= b[2])
    frame = lambda rows, own: spark.createDataFrame(rows, f"{own} int, k string, first date, last date")
    got = D.interval_overlap(frame(left, "left_id"), frame(right, "right_id"), ["k"], days)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_similar_titles_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{min(int(rng.expovariate(0.25)), 30)}" for _ in range(400)]
    title = lambda: tuple(sorted(set(rng.choices(words, k=rng.randint(1, 6)))))
    side = lambda n: sorted({(rng.randrange(3), title(), rng.choice(["", "1 oak st", "2 elm rd", "oak"])) for _ in range(n)})
    left, right = side(150), side(150)

    def alike(a, b):
        shared = len(set(a[1]) & set(b[1]))
        x, y = a[2], b[2]
        venue = not x or not y or x in y or y in x or (x[:1].isdigit() and x.split()[:2] == y.split()[:2])
        return a[0] == b[0] and shared and shared * 2 >= max(len(a[1]), len(b[1])) and venue

    frame = lambda rows: spark.createDataFrame([(d, list(t), v) for d, t, v in rows], "__day int, __tok array<string>, __loc string")
    got = D.similar_titles(frame(left), frame(right))
    assert sorted((r[0], tuple(r[1]), r[2]) for r in got.collect()) == [a for a in left if any(alike(a, b) for b in right)]


def test_common_words_are_looked_up_last(spark):
    titles = [["zz", *sorted(f"{c}{i}" for c in "ab")] for i in range(20)]
    df = spark.createDataFrame([(sorted(t),) for t in titles], "__tok array<string>")
    # in the order of letters "zz" is the last word; it is the last of ours because all titles have it
    assert all(r["__rare"][-1] == "zz" for r in D._rare_first(df).collect())
    common = spark.createDataFrame([(["aa", f"n{i}", f"o{i}", f"p{i}"],) for i in range(20)], "__tok array<string>")
    assert all(r["__rare"][-1] == "aa" for r in D._rare_first(common).collect())


def test_directory_entries(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://a.org/g", "<p>Barony of Oak Seneschal: x <a href='https://a.org/own'>o</a><a href='https://oak.org/'>w</a> Located in: Oak Town.</p><p>Shire of Elm Seneschal: y Located in: dormant</p>"),
            (2, "https://www.b.org/g", "<li>Shire of Fir: Fir Town, TX</li><li>Shire of Fir: twice</li>"),
            (3, "https://a.org/h", "<p>Barony of Oak Seneschal: z Located in: Later Town</p><p>no entry</p>"),
            (4, None, None),
        ],
        "page_id int, url string, html string",
    )
    rules = spark.createDataFrame([("a.org", r"^({kind} of [\w' -]+?)\s+Seneschal\b", r"Located in[:\s]+([^.;\n]{4,200})"), *N.DIRECTORY_RULES], "host string, name string, place string")
    seats = spark.createDataFrame([("SHIRE of fir", "Seat")], "name string, seat string")
    got = {r.group_name: (r.location, r.page_id, r.website) for r in N.directory_groups(pages, rules, seats).collect()}
    assert got == {"Barony of Oak": ("Oak Town", 1, "https://oak.org/"), "Shire of Fir": ("Seat", 2, "")}
