import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairweave.operators import geo as G

EDGES = "poly_id int, kingdom string, ring int, edge int, x1 double, y1 double, x2 double, y2 double, layer int"


def ring(poly, kingdom, number, points, layer=0):
    return [(poly, kingdom, number, i, *map(float, a), *map(float, b), layer) for i, (a, b) in enumerate(zip(points, points[1:] + points[:1]))]


def wavy(n, x, y, radius, seed):
    """A ring of ``n`` edges around a point, its distance from it changing all the time."""
    rng = random.Random(seed)
    waves = [(rng.uniform(0.02, 0.1), rng.randint(2, 60), rng.uniform(0, 6)) for _ in range(6)]
    at = [2 * math.pi * i / n for i in range(n)]
    far = [radius * (1 + sum(a * math.sin(k * t + p) for a, k, p in waves) + rng.uniform(0, 0.002)) for t in at]
    return [(x + r * math.cos(t), y + r * math.sin(t)) for r, t in zip(far, at)]


def inside(e, x, y):
    over = (e[:, 1] > y) != (e[:, 3] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = x < (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0]
    return int((over & cross).sum()) % 2 == 1


def brute(polys, points):
    out, arrays = {}, [np.array([r[4:8] for r in rows]) for rows in polys]
    for x, y in points:
        hits = [(rows[0][8], rows[0][0], rows[0][1]) for rows, e in zip(polys, arrays) if rows[0][1] is not None and inside(e, x, y)]
        if hits:
            out[(y, x)] = min(hits)[2]
    return out


def looked_up(spark, polys, points):
    edges = spark.createDataFrame([r for rows in polys for r in rows], EDGES)
    spots = spark.createDataFrame([(y, x) for x, y in points], "lat double, lng double")
    return {(r.lat, r.lng): r.territory for r in G.territory_join(spots, edges, "layer").collect()}


def test_large_polygon_with_a_hole_and_layers(spark):
    big = ring(1, "Big", 0, wavy(100_000, -100.3, 40.2, 8.0, 1), 1) + ring(1, "Big", 1, wavy(3000, -99.0, 41.0, 2.0, 2), 1)
    small = ring(2, "Small", 0, wavy(40, -104.0, 38.0, 1.5, 3), 0)
    none = ring(3, None, 0, wavy(40, -102.0, 43.0, 1.5, 4), 0)  # not assigned: the layer below answers
    isles = ring(4, "Isles", 0, wavy(30, -80.0, 30.0, 0.7, 5)) + ring(4, "Isles", 1, wavy(30, -78.0, 30.5, 0.7, 6))
    rng = random.Random(7)
    points = [(rng.uniform(-112, -76), rng.uniform(28, 51)) for _ in range(3000)] + [(-80.0, 30.0), (-78.0, 30.5), (-99.0, 41.0)]
    polys = [big, small, none, isles]
    want = brute(polys, points)
    assert looked_up(spark, polys, points) == want
    assert {"Big", "Small", "Isles"} <= set(want.values()) and (41.0, -99.0) not in want


@pytest.mark.parametrize("seed", range(3))
def test_points_on_lines_and_corners(spark, seed):
    """Coordinates on a coarse lattice, so that edges, cells and points coincide; polygons that share borders don't overlap or gap."""
    rng = random.Random(seed)
    polys = [ring(10 * i + j, f"P{i}{j}", 0, [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]) for i in range(-2, 2) for j in range(3)]
    polys.append(ring(500, "Wide", 0, [(-3, -1), (0.5, -0.5), (3, -1), (2.5, 4), (0, 3.25), (-2.75, 4)], 1))
    points = [(rng.randint(-14, 14) / 4, rng.randint(-6, 18) / 4) for _ in range(300)]
    assert looked_up(spark, polys, points) == brute(polys, points)


def test_points_carry_no_edges(spark):
    edges = spark.createDataFrame(ring(1, "A", 0, wavy(50, 0, 0, 1, 1)), EDGES)
    plan = G.territory_join(spark.createDataFrame([(0.0, 0.0)], "lat double, lng double"), edges)._jdf.queryExecution().optimizedPlan()
    for line in plan.toString().splitlines():
        if "Aggregate [lat" in line:
            assert "collect_list" not in line


def test_regions_of_counties_and_states(spark):
    raw = [("county", "1001", "A", ""), ("state", "1", "B", ""), ("province", "CA-ON", "C", "D")]
    assignment = G.territory_assignment(spark.createDataFrame(raw, "type string, id string, kingdom string, parent string"))
    features = [(1, "county", "01001", "state", "01"), (2, "county", "01003", "state", "01"), (3, "cd", "3520", "province", "CA-ON"), (4, "county", "02001", "state", "02"), (5, "county", None, None, None)]
    df = spark.createDataFrame(features, "poly_id int, type string, id string, parent_type string, parent_id string")
    assert {r.poly_id: r.kingdom for r in G.layered_regions(df, assignment).collect()} == {1: "A", 2: "B", 3: "D", 4: None, 5: None}


def test_empty(spark):
    none = spark.createDataFrame([], EDGES)
    spots = spark.createDataFrame([(1.0, 1.0), (None, 2.0)], "lat double, lng double")
    assert G.territory_join(spots, none).collect() == []
    assert G.territory_join(spots.limit(0), spark.createDataFrame(ring(1, "A", 0, wavy(9, 0, 0, 1, 1)), EDGES)).collect() == []
