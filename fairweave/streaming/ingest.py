"""Snapshots of raw listings, taken in as they arrive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fairweave.operators.quality import counts_by, feed_drop, zero_feeds
from fairweave.operators.state import carry_forward
from fairweave.plans.pipeline import with_prior_pins, with_state


def ingest_snapshots(spark: SparkSession, path: str, schema: StructType, checkpoint: str, each: Callable[[DataFrame, int], None], *, keys: list[str], event_time: str, late: str = "30 days") -> None:
    """Run ``each`` over all new rows below ``path``, every (keys) once within the watermark; returns when none are left.

    Rows older than the watermark are late and dropped, as past listings are.  State and progress lie in
    ``checkpoint``, so a restart goes on where the last run ended.  ``each`` gets a batch and its number, and
    has to write idempotently by that number.
    """
    stream = spark.readStream.schema(schema).parquet(path).withColumn("event_time", F.col(event_time).cast("timestamp"))
    stream = stream.withWatermark("event_time", late).dropDuplicatesWithinWatermark(keys)
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()


def _version(store: str, n: int) -> str:
    return f"{store}/table/version={n}"


def current_listings(spark: SparkSession, store: str) -> DataFrame:
    """The table of the last batch that is complete: of which the history has been written."""
    return spark.read.parquet(_version(store, spark.read.parquet(f"{store}/history").agg(F.max("version")).first()[0]))


def history(spark: SparkSession, store: str) -> DataFrame:
    """Counts of all runs: version, calendar_type, source, n and finding ('' or, for the source, none, failed or drop)."""
    return spark.read.parquet(f"{store}/history")


def upsert_snapshot(before: DataFrame, batch: DataFrame, as_of: date | str, fetched: str) -> tuple[DataFrame, DataFrame]:
    """(table, rows of feeds that delivered): the newest snapshot of each feed in ``batch`` takes the place of the feed's rows in
    ``before``, with their pins (J1); rows to come of feeds that delivered none are carried over (J2)."""
    newest = batch.groupBy("source").agg(F.max(fetched).alias(fetched))
    delivered = with_state(batch.join(newest, ["source", fetched], "left_semi").drop(fetched)).dropDuplicates(["row_id"])
    table = with_prior_pins(delivered, before).select(before.columns)
    failed = before.select("source").distinct().join(newest.select("source"), "source", "left_anti")
    return carry_forward(table, before, failed, as_of), delivered


def ingest_listings(spark: SparkSession, path: str, schema: StructType, store: str, registry: DataFrame, as_of: date | str, *, fetched: str = "fetched_at") -> None:
    """Take the snapshots below ``path`` into the stored table, batch by batch; returns when none are left.

    ``schema`` has the columns of listings and ``fetched``, when a feed's snapshot was taken.  Batch n reads version n - 1 of the
    table and overwrites version n, then its history: counts by source, feeds of ``registry`` without a listing (H1), feeds that
    delivered nothing, and feeds that lost most of their listings (H2).  A version without history does not count, so a batch that
    broke off anywhere is run again from the same input and gives the same table.
    """

    def each(batch: DataFrame, n: int) -> None:
        batch = batch.persist()
        try:
            before = spark.read.parquet(_version(store, n - 1)).drop("carried") if n else with_state(batch.drop(fetched)).limit(0)
            table, delivered = upsert_snapshot(before, batch, as_of, fetched)
            table.write.mode("overwrite").parquet(_version(store, n))
            now = spark.read.parquet(_version(store, n))
            findings = zero_feeds(registry, now).select("source", F.lit("none").alias("finding"))
            findings = findings.unionByName(now.where("carried").select("source", F.lit("failed").alias("finding")).distinct())
            findings = findings.unionByName(feed_drop(delivered, before).select("source", F.lit("drop").alias("finding")))
            counts = counts_by(now, "calendar_type", "source").join(findings.groupBy("source").agg(F.max("finding").alias("finding")), "source", "full_outer")
            counts = counts.select("calendar_type", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("finding", F.lit("")).alias("finding"))
            _commit(counts, store, n)
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(schema).parquet(path)
    stream.writeStream.option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).foreachBatch(each).start().awaitTermination()


def _commit(counts: DataFrame, store: str, n: int) -> None:
    counts.write.mode("overwrite").parquet(f"{store}/history/version={n}")
