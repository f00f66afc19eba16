"""Territories, boxes and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweave.functions.predicates import event_days

CELL = 1.0


def territory_edges(topology: DataFrame) -> DataFrame:
    """G1: edges of delta-coded polygons.

    ``topology`` has poly_id, kingdom and rings: array of rings, each an array of struct(dx, dy) steps
    from the origin.  Rings after the first are holes.
    """
    ring = topology.select("poly_id", "kingdom", F.posexplode("rings").alias("ring", "steps"))
    zero = F.array().cast("array<struct<x:double,y:double>>")

    def walk(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        return F.concat(acc, F.array(F.struct((F.coalesce(last["x"], F.lit(0.0)) + s["dx"]).cast("double").alias("x"), (F.coalesce(last["y"], F.lit(0.0)) + s["dy"]).cast("double").alias("y"))))

    points = ring.withColumn("p", F.aggregate("steps", zero, walk))
    edge = points.select("poly_id", "kingdom", "ring", F.posexplode(F.transform("p", lambda a, i: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), F.get("p", F.pmod(i + 1, F.size("p")))["x"].alias("x2"), F.get("p", F.pmod(i + 1, F.size("p")))["y"].alias("y2")))).alias("edge", "e"))
    return edge.select("poly_id", "kingdom", "ring", "edge", "e.x1", "e.y1", "e.x2", "e.y2").where("x1 <> x2 or y1 <> y2")


def territory_assignment(df: DataFrame) -> DataFrame:
    """Padded ids and the effective region: a parent region wins."""
    width = {"county": 5, "state": 2, "cd": 4}
    padded = F.col("id")
    for kind, n in width.items():
        padded = F.when(F.col("type") == kind, F.lpad("id", n, "0")).otherwise(padded)
    return df.withColumns({"id": padded, "region": F.coalesce(F.nullif("parent", F.lit("")), "kingdom")})


def layered_regions(features: DataFrame, assignment: DataFrame) -> DataFrame:
    """G2 over layers: ``kingdom`` of each feature (type, id, parent_type, parent_id) from its own assignment, else its parent's.

    So a county that is not assigned by itself has its state's region, and a census division its province's;
    ``assignment`` is ``territory_assignment``'s.  A feature without either has no region and gives way to the next layer.
    """
    own = assignment.groupBy("type", "id").agg(F.min("region").alias("own"))
    above = own.select(F.col("type").alias("parent_type"), F.col("id").alias("parent_id"), F.col("own").alias("above"))
    out = features.join(own, ["type", "id"], "left").join(above, ["parent_type", "parent_id"], "left")
    return out.withColumn("kingdom", F.coalesce("own", "above")).drop("own", "above")


def _crosses(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """Whether a ray from (x, y) to the right crosses an edge."""
    return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)


def territory_index(edges: DataFrame, layer: str | None = None, *, per_slab: int = 16, deepest: int = 12) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(polygons, cells, strips) to look points up in.

    A polygon is cut into slabs of latitude, the thinner the more edges it has (about ``per_slab`` for each slab, at most
    2**deepest slabs to a degree), and slabs into cells.  A cell that no edge touches lies inside or outside as a whole, and only those
    inside are kept; the others are tested against the edges of their slab (``strips``).
    """
    order = F.col(layer) if layer else F.lit(0)
    e = edges.where("kingdom is not null").select("poly_id", "kingdom", order.alias("layer"), "x1", "y1", "x2", "y2")
    left, right, low, high = F.least("x1", "x2"), F.greatest("x1", "x2"), F.least("y1", "y2"), F.greatest("y1", "y2")
    polygons = e.groupBy("poly_id", "kingdom", "layer").agg(F.count("*").alias("n"), F.min(left).alias("xa"), F.max(right).alias("xb"), F.min(low).alias("ya"), F.max(high).alias("yb"))
    depth = F.ceil(F.log2(F.col("n") / (per_slab * F.greatest(F.col("yb") - F.col("ya"), F.lit(1e-6)))))
    polygons = polygons.withColumn("depth", F.least(F.greatest(depth, F.lit(0)), F.lit(deepest)).cast("int"))
    scale, across = F.pow(F.lit(2.0), "depth"), F.pow(F.lit(2.0), F.floor(F.col("depth") / 4))
    strips = e.join(polygons.select("poly_id", "kingdom", "layer", "depth"), ["poly_id", "kingdom", "layer"])
    strips = strips.select("poly_id", "depth", "x1", "y1", "x2", "y2", F.explode(F.sequence(F.floor(low * scale), F.floor(high * scale))).alias("slab"))
    # where an edge lies within its slab; the margin makes a cell touched rather than not
    bottom, top = F.col("slab") / scale, (F.col("slab") + 1) / scale
    at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    ends = [at(F.greatest(bottom, low)), at(F.least(top, high))]
    flat = F.col("y1") == F.col("y2")
    a, b = F.when(flat, left).otherwise(F.least(*ends)) - 1e-9, F.when(flat, right).otherwise(F.greatest(*ends)) + 1e-9
    touched = strips.select("poly_id", "slab", F.explode(F.sequence(F.floor(a * across), F.floor(b * across))).alias("cx"), F.lit(True).alias("touched"))
    # along the middle of a slab a polygon lies between the first and second edge, the third and fourth, ...
    middle = (F.col("slab") + 0.5) / scale
    crossing = strips.where((F.col("y1") > middle) != (F.col("y2") > middle)).groupBy("poly_id", "depth", "slab").agg(F.array_sort(F.collect_list(at(middle))).alias("xs"))
    span = F.explode(F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda i: F.struct(F.get("xs", i).alias("a"), F.get("xs", i + 1).alias("b")))).alias("s")
    # cells whose middle lies between them
    first, last = F.ceil(F.col("s.a") * across - 0.5), F.ceil(F.col("s.b") * across - 0.5) - 1
    none = F.array().cast("array<bigint>")
    within = crossing.select("poly_id", "depth", "slab", span).select("poly_id", "slab", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(none)).alias("cx"), F.lit(False).alias("touched"))
    cells = touched.unionByName(within).groupBy("poly_id", "slab", "cx").agg(F.max("touched").alias("touched"))
    return polygons, cells, strips.select("poly_id", "slab", "x1", "y1", "x2", "y2")


def territory_join(points: DataFrame, edges: DataFrame, layer: str | None = None) -> DataFrame:
    """(lat, lng, poly_id, territory) of the polygon that each point lies in.

    Points and the boxes of polygons share grid cells, an equi-join; within a polygon a point has one cell of
    ``territory_index``.  Whole cells need no further test; in the others the edges of the slab that a ray crosses are counted.  Inside: an
    odd count over all rings, so rings within a ring are holes.  Of several polygons the least (layer, poly_id) wins; those
    without a region don't count, so a lower layer answers in their place.  ``poly_id`` is unique over all layers.
    """
    polygons, cells, strips = territory_index(edges, layer)
    grid = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / CELL), F.floor(F.col(b) / CELL)))
    box = polygons.select("*", grid("xa", "xb").alias("gx")).select("*", grid("ya", "yb").alias("gy"))
    spot = points.select("lat", "lng").where("lat is not null and lng is not null").distinct()
    spot = spot.withColumns({"gx": F.floor(F.col("lng") / CELL), "gy": F.floor(F.col("lat") / CELL)})
    near = spot.join(box, ["gx", "gy"]).where(F.col("lng").between(F.col("xa"), F.col("xb")) & F.col("lat").between(F.col("ya"), F.col("yb")))
    slab = F.floor(F.col("lat") * F.pow(F.lit(2.0), "depth")).alias("slab")
    cx = F.floor(F.col("lng") * F.pow(F.lit(2.0), F.floor(F.col("depth") / 4))).alias("cx")
    placed = near.select("lat", "lng", "poly_id", "kingdom", "layer", slab, cx).join(cells, ["poly_id", "slab", "cx"])
    whole = placed.where("not touched").select("lat", "lng", "poly_id", "kingdom", "layer")
    ray = placed.where("touched").join(strips, ["poly_id", "slab"]).groupBy("lat", "lng", "poly_id", "kingdom", "layer")
    crossed = F.count_if(_crosses(*[F.col(c) for c in ("x1", "y1", "x2", "y2", "lng", "lat")]))
    tested = ray.agg(crossed.alias("n")).where("n % 2 = 1").drop("n")
    found = whole.unionByName(tested).groupBy("lat", "lng").agg(F.min(F.struct("layer", "poly_id", "kingdom")).alias("t"))
    return found.select("lat", "lng", "t.poly_id", F.col("t.kingdom").alias("territory"))


def host_region(df: DataFrame, edges: DataFrame, layer: str | None = None) -> DataFrame:
    """The region that contains each row's pin, '' if none; one lookup for a rounded coordinate."""
    keyed = df.withColumns({"__lat": F.round("lat", 4), "__lng": F.round("lng", 4)})
    found = territory_join(keyed.select(F.col("__lat").alias("lat"), F.col("__lng").alias("lng")), edges, layer)
    found = found.select(F.col("lat").alias("__lat"), F.col("lng").alias("__lng"), "territory")
    return keyed.join(found, ["__lat", "__lng"], "left").withColumn("host_kingdom", F.coalesce("territory", F.lit(""))).select(*df.columns, "host_kingdom")


def marquee_host(df: DataFrame, min_days: float = 5) -> DataFrame:
    """The host kept for a region's long events only."""
    big = (F.col("calendar_type") == "kingdom") & F.col("title").rlike(r"(?i)\bwars?\b") & (event_days(F.col("start_ts"), F.col("end_ts")) >= min_days)
    return df.withColumn("war_host", F.when(big, F.col("host_kingdom")).otherwise(""))


def clip_polygons(edges: DataFrame, box: tuple[float, float, float, float], polys: list[int] | None = None) -> DataFrame:
    """Polygons (of ``polys``, or all) whose box misses (x, y, x, y) go."""
    xa, ya, xb, yb = box
    bounds = edges.groupBy("poly_id").agg(F.min("x1").alias("a"), F.max("x1").alias("b"), F.min("y1").alias("c"), F.max("y1").alias("d"))
    meets = (F.col("b") >= xa) & (F.col("a") <= xb) & (F.col("d") >= ya) & (F.col("c") <= yb)
    listed = F.col("poly_id").isin(polys) if polys is not None else F.lit(True)
    return edges.join(bounds.where(meets | ~listed).select("poly_id"), "poly_id", "left_semi")


def assign_countries(polys: DataFrame, assignment: DataFrame, names: list[str]) -> DataFrame:
    """The region of a polygon by the first of its name fields that is assigned."""
    tried = polys.select("poly_id", F.posexplode(F.array(*[F.col(n) for n in names])).alias("i", "name"))
    hit = tried.join(assignment.select("name", "region"), "name")
    best = hit.groupBy("poly_id").agg(F.min_by("region", "i").alias("region"))
    return polys.join(best, "poly_id", "left")


def box_state(df: DataFrame, boxes: DataFrame) -> DataFrame:
    """The first box, in table order (``ord``), that holds a row's pin; null if none."""
    # boxes are listed under the cells of a grid, so that points have a key to join by
    listed = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / CELL), F.floor(F.col(b) / CELL)))
    b = boxes.where("lat_min <= lat_max and lng_min <= lng_max").select("ord", "state", "lat_min", "lat_max", "lng_min", "lng_max", listed("lat_min", "lat_max").alias("gy")).select("*", listed("lng_min", "lng_max").alias("gx"))
    spots = df.select("lat", "lng", F.floor(F.col("lat") / CELL).alias("gy"), F.floor(F.col("lng") / CELL).alias("gx")).distinct()
    hit = spots.join(b, ["gy", "gx"]).where(F.col("lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("lng").between(F.col("lng_min"), F.col("lng_max")))
    first = hit.groupBy("lat", "lng").agg(F.min_by("state", "ord").alias("box_state"))
    return df.join(first, ["lat", "lng"], "left").select(*df.columns, "box_state")


def _judged(df: DataFrame, boxes: DataFrame, homes: DataFrame, state: Column) -> DataFrame:
    """``df`` with box_state, ``__in_named`` (the pin lies in the box of the state that the address names) and ``__away``
    (its source has acceptable states, and the pin lies in none of them)."""
    placed = box_state(df, boxes).withColumn("__named", state)
    named = boxes.select(F.col("state").alias("__named"), F.struct("lat_min", "lat_max", "lng_min", "lng_max").alias("__box")).groupBy("__named").agg(F.min("__box").alias("__box"))
    out = placed.join(named, "__named", "left").join(homes.select("source", F.col("states").alias("__states")), "source", "left")
    in_named = F.col("lat").between(F.col("__box.lat_min"), F.col("__box.lat_max")) & F.col("lng").between(F.col("__box.lng_min"), F.col("__box.lng_max"))
    return out.withColumns({"__in_named": in_named, "__away": F.col("__states").isNotNull() & ~F.array_contains("__states", F.col("box_state"))})


def validate_pins(df: DataFrame, boxes: DataFrame, homes: DataFrame, state: Column) -> DataFrame:
    """``verdict`` accept, defer or reject for each pin.

    Reject: in no known box; in another state's box than the address names; or, for a local group, in
    none of its acceptable states (``homes``: source, states).  Defer: a region's row outside them.
    """
    out, away = _judged(df, boxes, homes, state), F.col("__away")
    verdict = F.when(F.col("box_state").isNull(), "reject").when(F.coalesce(~F.col("__in_named"), F.lit(False)), "reject").when(away & (F.col("calendar_type") == "baronial"), "reject").when(away, "defer").otherwise("accept")
    return out.withColumn("verdict", verdict).select(*df.columns, "box_state", "verdict")


#: Pins that were set on purpose, so that no later check may clear them.
DELIBERATE = ["override", "ok_published", "ok_organizer", "ok_fallback"]


def clear_stale_pins(df: DataFrame, boxes: DataFrame, homes: DataFrame, state: Column) -> DataFrame:
    """L14 for pins of an earlier run: those outside the state that the address now names, or in a state that is none of the
    source's, are cleared and marked as failed; a pin in no known box stays, as do deliberate ones."""
    out = _judged(df, boxes, homes, state)
    wrong = F.coalesce(~F.col("__in_named"), F.lit(False)) | (F.col("box_state").isNotNull() & F.col("__away"))
    bad = F.col("lat").isNotNull() & F.col("lng").isNotNull() & wrong & ~F.coalesce("geocode_status", F.lit("")).isin(DELIBERATE)
    new = {c: F.when(~bad, F.col(c)) for c in ("lat", "lng")} | {"geocode_status": F.when(bad, "failed").otherwise(F.col("geocode_status"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def nearest_groups(groups: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Groups in view: inside (lat, lat, lng, lng)."""
    return groups.where(F.col("lat").between(box[0], box[1]) & F.col("lng").between(box[2], box[3]))


def centroid_vote(chunks: DataFrame, lookups: DataFrame) -> DataFrame:
    """For each group the state with the most located chunks, and the centre of these.

    ``chunks`` has group_id, chunk and state; ``lookups`` has chunk, state, lat and lng.  Ties: the first state.
    """
    hit = chunks.join(lookups, ["chunk", "state"]).groupBy("group_id", "state").agg(F.count("*").alias("hits"), F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))
    best = F.row_number().over(Window.partitionBy("group_id").orderBy(F.desc("hits"), "state"))
    return hit.withColumn("__n", best).where("__n = 1").drop("__n")
