import random
import time

import pytest
from pyspark.sql import functions as F

from fairweave.operators import discovery as N
from fairweave.operators import places as L
from fairweave.operators.names import find_names, titles_with_names


def found(spark, texts, names, **options):
    t = spark.createDataFrame(list(enumerate(texts)), "text_id int, text string")
    n = spark.createDataFrame(list(enumerate(names)), "name_id int, name string")
    return sorted(tuple(r) for r in find_names(t, n, **options).collect())


@pytest.mark.parametrize("gram", [None, 3])
def test_against_brute_force(spark, gram):
    rng = random.Random(gram or 0)
    word = lambda: rng.choice(["oak", "elm", "of", "the", "barony", "oakelm", "a"])
    texts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    names = sorted({" ".join(word() for _ in range(rng.randint(1, 5))) for _ in range(40)} | {" ".join(texts[0].split()[:12]), ""})
    inside = lambda n, t: n and t and (f" {n} " in f" {t} " if gram is None else len(n) >= gram and n in t)
    assert found(spark, texts, names, gram=gram) == [(i, j) for i, t in enumerate(texts) for j, n in enumerate(names) if inside(n, t)]


def test_scope_and_repeated_words(spark):
    t = spark.createDataFrame([(1, "K", "moot of oak oak oak"), (2, "L", "moot of oak")], "text_id int, k string, text string")
    n = spark.createDataFrame([(1, "K", "oak"), (2, "K", "oak oak"), (3, "L", "oak oak")], "name_id int, k string, name string")
    assert sorted(tuple(r) for r in find_names(t, n, scope=["k"]).collect()) == [(1, 1), (1, 2)]


def test_titles_without_accents_and_blanks(spark):
    titles = spark.createDataFrame([("K", "Moot at St. Élan's Hall"), ("K", "Moot of Ban"), ("L", "St Elan")], "source string, title string")
    names = spark.createDataFrame([("K", "Saint"), ("K", "St Élan"), ("K", "Ban")], "source string, name string")
    assert [tuple(r) for r in titles_with_names(titles, names).collect()] == [("K", "Moot at St. Élan's Hall")]


GROUP = "group_id int, kingdom string, group_name string, lat double, lng double"


def test_host_groups(spark):
    long = "Barony of the Nine Wide Green Rolling Hills Beyond the Old River Bend"
    groups = spark.createDataFrame([(1, "K", "Shire of Oak", 1.0, 1.0), (2, "K", "Barony of Oak Hill", 2.0, 2.0), (3, "K", long, 3.0, 3.0), (4, "L", "Shire of Elm Wood", 4.0, 4.0)], GROUP)
    rows = [
        (1, "K", "Crown (Nowhere) (Oak Hill)", ""),  # the second pair of parentheses
        (2, "K", "Crown at Oak Hill", ""),
        (3, "K", "Crown", f"hosted by the {long.lower()}, all welcome"),
        (4, "K", "Crown", "in the shade of oak hill"),  # a short name in a description is just words
        (5, "K", "Crown (Oak Hill)", f"hosted by the {long}"),
        (6, "K", "Crown at Elm Wood", ""),  # of another region
        (7, "Shire of Elm Wood", "Crown (Oak Hill)", ""),
        (8, "K", "Crown of the " + long.removeprefix("Barony of the ") + " folk", ""),
    ]
    df = spark.createDataFrame([(i, "K", s, t, d, "failed", False) for i, s, t, d in rows], "row_id int, kingdom string, source string, title string, description string, geocode_status string, is_virtual boolean")
    got = {r.row_id: r.group_lat for r in L.pin_at_host_group(df, groups).collect()}
    assert got == {1: 2.0, 2: 2.0, 3: 3.0, 4: None, 5: 2.0, 6: None, 7: 4.0, 8: 3.0}


def test_online_listings_that_name_a_group(spark):
    df = spark.createDataFrame([(1, "K", "Moot at Oak-Hill", True), (2, "K", "Moot", True), (3, "K", "Oakhill", False), (4, "L", "Oakhill", True), (5, "K", None, True)], "row_id int, source string, title string, is_virtual boolean").withColumn("calendar_type", F.lit("kingdom"))
    groups = spark.createDataFrame([("K", "Shire of Oak Hill")], "region string, group_name string")
    assert {r.row_id: r.calendar_type for r in L.promote_local(df, groups).collect()} == {1: "baronial", 2: "kingdom", 3: "kingdom", 4: "kingdom", 5: "kingdom"}


def test_regions_of_groups_in_long_pages(spark):
    rng = random.Random(1)
    filler = " ".join(f"word{rng.randrange(5000)}" for _ in range(10_000))
    long = "Shire of the Seven Tall Silver Birches Beside the Slow Deep Western Sea"
    pages = [
        (1, f"<p>{filler}. Welcome to the Canton of Elm. We are based in Elm Town,\n Ohio, which is nice. {filler}</p>"),
        (2, f"<p>{long} encompasses Birch County and Sea Town; all of it.</p>"),
        (3, "<p>The Barony of Ash is part of the Kingdom of Trees. Find us in the Ash River Valley most days.</p>"),
        (4, "<p>Shire of Fir is located in the Kingdom of Trees and nowhere else.</p>"),
        (5, "<p>Barony of Ash is located in Ashford, Kent.</p>"),
    ]
    groups = spark.createDataFrame([(1, "K", "Canton of Elm", 0.0, 0.0), (2, "K", long, 0.0, 0.0), (3, "K", "Barony of Ash", 0.0, 0.0), (4, "K", "Shire of Fir", 0.0, 0.0), (5, "K", "Shire of Nobody", 0.0, 0.0)], GROUP)
    df = spark.createDataFrame(pages, "page_id int, html string")
    want = {1: "Elm Town, Ohio", 2: "Birch County and Sea Town", 3: "Ash River Valley"}
    assert {r.group_id: r.location for r in N.group_regions(df, groups).collect()} == want
    began = time.time()
    assert N.group_regions(df.where("page_id = 1"), groups).count() == 1
    assert time.time() - began < 15  # the cost of Spark's stages, not of the 20,000 words


def test_vague_places(spark):
    places = lambda text: spark.createDataFrame([(text,)], "a string").select(L.simplified_places(F.col("a")).alias("x")).first().x
    assert places("the region currently known as Elmstead, Texas") == ["Elmstead, Texas", "Elmstead"]
    assert places("Greater Oakham area, including Rutland") == ["Oakham"]
    assert places("Based near Ashford; some members in Kent") == ["Ashford"]
    assert places("Elm County") == ["Elm"]
    assert places("5 Main St, Town, TX") == [] and places("all over") == []
