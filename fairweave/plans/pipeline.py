"""The refresh as one plan.

The order of steps has a meaning: duplicates go before pins are carried over, so that a pin is looked for by the row
that stays; pins of the last run are checked against today's addresses; rules come after carried rows, so that they
hold for these too; large events come after all pins, and private phrases after all texts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweave.functions.predicates import is_cancelled, is_non_event, needs_description, upcoming
from fairweave.functions.text import clean_description, strip_structured
from fairweave.operators.dedup import dedupe_listings, drop_aggregator_copies, drop_local_copies, marquee_merge, merge_series
from fairweave.operators.geo import clear_stale_pins, host_region, marquee_host, validate_pins
from fairweave.operators.places import geocode_from_cache, organizer_pin, pin_at_host_group, pin_local_fallback, promote_local, published_prepass, resolve_location, second_address
from fairweave.operators.privacy import scrub_private
from fairweave.operators.rules import apply_event_rules, apply_keyword_rules
from fairweave.operators.state import carry_forward, carry_pins, enrich_descriptions, url_backfill
from fairweave.operators.store import stored

#: Columns that the steps fill, added where a table lacks them.
STATE = {"lat": "double", "lng": "double", "geocode_status": "string", "location_specificity": "string"}


def real_listings(df: DataFrame, as_of: date | str) -> DataFrame:
    """Listings that are events, not cancelled, and not over."""
    description = df["description"] if "description" in df.columns else df["title"].substr(1, 0)
    return upcoming(df.where(~is_non_event("title") & ~is_cancelled("title", description)), as_of)


def with_state(df: DataFrame) -> DataFrame:
    """``df`` with the columns of ``STATE``; texts are empty where it lacks them."""
    lacking = {c: F.lit("" if t == "string" else None).cast(t) for c, t in STATE.items() if c not in df.columns}
    return df.withColumns(lacking) if lacking else df


def described(df: DataFrame, text_rules: DataFrame | None = None) -> DataFrame:
    """Descriptions cleaned, and blank links filled from them; ``text_rules`` are those of ``strip_structured``."""
    told = df.withColumn("__d", clean_description("description"))
    new = {"description": F.col("__d.description"), "event_url": F.coalesce(F.nullif(F.trim("event_url"), F.lit("")), "__d.event_url", F.lit("")), "facebook_url": F.coalesce("__d.facebook_url", F.lit(""))}
    out = told.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])
    return strip_structured(out, text_rules) if text_rules is not None else out


def clean(df: DataFrame, as_of: date | str, *, text_rules: DataFrame | None = None, groups: DataFrame | None = None, places: DataFrame | None = None, series: bool = False) -> DataFrame:
    """Raw rows to located and de-duplicated ones, with the columns of ``df`` but for ``is_aggregator``.

    With ``text_rules`` descriptions are cleaned.  With ``groups`` and ``places`` the address is resolved from ``location``
    and ``description``, rows of local groups without one are vague, and online rows of a region that name one of its groups
    become local.  Copies go, and with ``series`` recurring rows become one.
    """
    out = real_listings(df, as_of)
    if text_rules is not None:
        out = described(out, text_rules)
    if groups is not None:
        out = promote_local(out, groups.select(F.col("kingdom").alias("region"), "group_name"))
        if places is not None:
            located = resolve_location(out.drop("clean_location"), groups, places).withColumnRenamed("address", "clean_location")
            vague = F.when(F.col("step") == "vague", "vague").otherwise(F.col("location_specificity")) if "location_specificity" in df.columns else None
            out = (located.withColumn("location_specificity", vague) if vague is not None else located).select(df.columns)
    # the steps from here on look at the rows several times
    out = stored(out, "located")
    if "is_aggregator" in df.columns:
        out = stored(drop_aggregator_copies(out), "original")
    out = drop_local_copies(dedupe_listings(out))
    return merge_series(stored(out, "regional")).drop("series_dates") if series else out


def with_prior_pins(df: DataFrame, prior: DataFrame, boxes: DataFrame | None = None, homes: DataFrame | None = None, state: Column | None = None) -> DataFrame:
    """J1, then L14: rows without a pin take the prior run's; with ``boxes``, ``homes`` and ``state`` pins that today's address
    or source rules out are cleared."""
    pinned, own = carry_pins(df, prior), F.col("lat").isNotNull()
    new = {c: F.when(own, F.col(c)).otherwise(F.col(f"pin_{c}")) for c in ("lat", "lng")}
    new["geocode_status"] = F.when(own, F.col("geocode_status")).otherwise(F.coalesce("pin_status", "geocode_status"))
    out = pinned.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])
    return clear_stale_pins(out, boxes, homes, state) if boxes is not None else out


def geocode(df: DataFrame, cache: DataFrame, groups: DataFrame, boxes: DataFrame, homes: DataFrame, state: Column, as_of: date | str, *, resolved: DataFrame | None = None, organizers: DataFrame | None = None, organizer_box: tuple[float, float, float, float] = (-90, 90, -180, 180)) -> DataFrame:
    """The cascade from addresses to pins: published coordinates, cached lookups of the address, then of another address in the
    description, the organiser's pin, the host group's pin.  ``df`` has location, description and the columns of ``STATE``.

    A pin that a step finds is kept only if it is not rejected (``validate_pins``); one that is out of a region's own states comes
    last.  Online rows and rows with a pin are left as they are.
    """
    told = published_prepass(df, resolved)
    checked = validate_pins(told, boxes, homes, state)
    bad = (F.col("geocode_status") == "ok_published") & (F.col("verdict") == "reject")
    before = df.select("row_id", F.struct("lat", "lng", "geocode_status").alias("__was"))
    out = checked.join(before, "row_id").select(*[F.when(bad, F.col(f"__was.{c}")).otherwise(F.col(c)).alias(c) if c in ("lat", "lng", "geocode_status") else F.col(c) for c in df.columns])
    out = stored(out, "published")

    # a lookup is accepted, deferred or rejected for each row that asks for it
    judge = lambda hits: validate_pins(hits, boxes, homes, state)
    person = ~F.coalesce("is_virtual", F.lit(False)) & (F.trim(F.coalesce("clean_location", F.lit(""))) != "")
    out = stored(_adopted(out, geocode_from_cache(out.where((F.col("geocode_status") == "") & person), cache, judge, str(as_of))), "looked-up")
    second = second_address(out).where("second_address is not null and not coalesce(is_virtual, false)").withColumn("clean_location", F.col("second_address")).drop("second_address")
    out = _adopted(out, geocode_from_cache(stored(second, "second-addresses"), cache, judge, str(as_of)).where("geo_lat is not null"))
    if organizers is not None:
        out = organizer_pin(out, organizers, groups, organizer_box)
    out = stored(out, "organised")
    hosted = pin_at_host_group(out, groups)
    hit = F.col("group_status") == "ok_group"
    new = {"lat": F.when(hit, F.col("group_lat")).otherwise(F.col("lat")), "lng": F.when(hit, F.col("group_lng")).otherwise(F.col("lng")), "geocode_status": F.col("group_status"), "location_specificity": F.when(hit, "vague").otherwise(F.col("location_specificity"))}
    return hosted.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def _adopted(df: DataFrame, found: DataFrame) -> DataFrame:
    """``df`` with the pins and statuses of the rows in ``found`` (row_id, geo_lat, geo_lng, geo_status)."""
    out = df.join(found.select("row_id", "geo_lat", "geo_lng", "geo_status"), "row_id", "left")
    new = {"lat": F.coalesce("geo_lat", "lat"), "lng": F.coalesce("geo_lng", "lng"), "geocode_status": F.coalesce("geo_status", "geocode_status")}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def refresh(
    df: DataFrame,
    prior: DataFrame,
    failed: DataFrame,
    events: DataFrame,
    edges: DataFrame,
    private: DataFrame,
    as_of: date | str,
    *,
    layer: str | None = None,
    boxes: DataFrame | None = None,
    homes: DataFrame | None = None,
    state: Column | None = None,
    rules: DataFrame | None = None,
    keywords: DataFrame | None = None,
    seats: DataFrame | None = None,
    links: DataFrame | None = None,
    page_texts: DataFrame | None = None,
    eligible: Column | None = None,
    lookups: DataFrame | None = None,
    resolved: DataFrame | None = None,
    organizers: DataFrame | None = None,
    **inputs,
) -> DataFrame:
    """From raw rows and the prior run's table to the table that is served, with the columns of ``STATE``, host_kingdom, war_host and privacy.

    In order: ``clean`` (which ``inputs`` go to); pins of ``prior``, cleared where ``boxes``, ``homes`` and ``state`` rule them
    out; rows of ``failed`` feeds carried over; event ``rules`` and ``keywords``, for carried rows too; vague rows at their group's
    ``seats``; large events; private phrases; ``links`` for blank links; texts of pages for rows on an ``eligible`` host whose
    description is a placeholder; cached ``lookups`` (``geocode``); territories; private phrases of what came in since.
    Inputs that are left out leave their step out.  ``row_id`` is unique over ``df`` and ``prior`` together.
    """
    # Spark can size what it reads from a file: so the hand-kept tables meet the rows, and the rows don't pass through the driver
    failed, events, edges, private = stored(failed, "failed"), stored(events, "events"), stored(edges, "edges"), stored(private, "private")
    boxes, homes, rules, keywords, seats = (t if t is None else stored(t, "kept") for t in (boxes, homes, rules, keywords, seats))
    out, prior = clean(with_state(df), as_of, **inputs), with_state(prior)
    out = with_prior_pins(stored(out, "unique"), prior, boxes, homes, state)
    out = carry_forward(stored(out, "pinned"), prior, failed, as_of).drop("carried")
    columns = out.columns
    if rules is not None:
        out = apply_event_rules(stored(out, "carried"), rules).select(columns)
    if keywords is not None:
        out = apply_keyword_rules(stored(out, "ruled"), keywords).select(columns)
    if seats is not None:
        out = pin_local_fallback(out, seats)
    out = marquee_merge(stored(out, "corrected"), events).drop("merged", "sources")
    texts = [c for c in ("title", "location", "clean_location", "description") if c in columns]
    out = scrub_private(stored(out, "merged"), private, texts)
    if links is not None:
        out = url_backfill(out, links)
    if page_texts is not None and eligible is not None:
        out = enrich_descriptions(out, page_texts, needs_description("description", "event_url", eligible))
    if lookups is not None:
        # private places are not looked up
        out = stored(out, "scrubbed")
        hidden, out = out.where("privacy = 'private'"), geocode(out.where("privacy = ''"), lookups, inputs["groups"], boxes, homes, state, as_of, resolved=resolved, organizers=organizers)
        out = out.unionByName(hidden)
    out = stored(marquee_host(host_region(stored(out, "located"), edges, layer)), "tagged")
    # what pages told since may hold private phrases too
    again = scrub_private(out.drop("privacy"), private, texts)
    marked = again.join(out.select("row_id", F.col("privacy").alias("__before")).hint("merge"), "row_id")
    return marked.withColumn("privacy", F.when(F.col("privacy") == "", F.col("__before")).otherwise(F.col("privacy"))).drop("__before")
