"""Helpers shared by the operators: the shared folder, chunks and buckets."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent in local mode, as in tests, a fresh temporary folder is
    set for the session; on a cluster its absence is an error, as executors would not see
    a folder of the driver.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="fairweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over all cores where its scan has fewer partitions than that."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: Bytes, as JSON text, up to which a table is broadcast.
_BROADCAST_BYTES = 24 << 20


def fits(df: DataFrame) -> bool:
    """Whether all rows of ``df`` (a written table), written as JSON, are small enough for a broadcast."""
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= _BROADCAST_BYTES


def sized(df: DataFrame) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it ``fits``; else Spark shuffles the join."""
    return F.broadcast(df) if fits(df) else df


def lookup_join(df: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """``df`` inner joined with ``of`` (a written table) by broadcast if ``of`` ``fits``; else in a shuffle in which no key is
    frequent: how often ``df`` has each key is counted first."""
    if fits(of):
        return df.join(F.broadcast(of), key)
    return frequent_join(df, written(df.groupBy(key).agg(F.count("*").alias("times")).join(of, key), "frequencies"), key)


def frequent_join(df: DataFrame, of: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """``df`` (N rows) inner joined with ``of``, whose ``times`` says how often ``df`` has each key.

    Keys with over one in ``most`` of the rows, at most ``most`` of them, are joined by broadcast; the
    others meet in a shuffle, where no key is frequent.  ``key`` must not be null; both are written tables.
    """
    total = of.agg(F.sum("times")).first()[0] or 0
    often = of.where(F.col("times") * most > total).drop("times")
    rare = of.where(F.col("times") * most <= total).drop("times")
    hot = F.broadcast(often)
    return df.join(hot, key).unionByName(df.join(F.broadcast(often.select(key)), key, "left_anti").join(rare, key))


def remainder(doc_id: Column, n: int) -> Column:
    """``crc32`` of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


#: DuckDB SQL: a row whose list ``t`` is the table of the CRC-32 of bytes.
CRC_TABLE_SQL = """SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), list_transform(range(8), lambda k: CAST(0 AS UBIGINT))), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i))"""


def crc_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text, where ``t`` is the table of bytes."""
    code = f"hex(encode({text}))"
    octets = f"list_transform(range(length({code}) // 2), lambda i: CAST('0x' || {code}[2 * i + 1 : 2 * i + 2] AS UBIGINT))"
    step = "lambda x, y: xor(x >> 8, t[CAST((xor(x, y) & 255) + 1 AS BIGINT)])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {octets}), {step}), CAST(4294967295 AS UBIGINT))"


def hash_chunk(df: DataFrame, chunk_bytes: int, least: int = 48) -> tuple[DataFrame, int]:
    """Add ``chunk``: rows dealt by a hash of id and text into chunks of about ``chunk_bytes`` of text.

    So rows that share an id, or have none, are spread; only rows that repeat as a whole share a chunk.
    """
    total = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(least, math.ceil(total / chunk_bytes))
    return df.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))), n


def range_chunk(df: DataFrame, chunk_bytes: int, least: int = 48, most: int = 1_000_000) -> tuple[DataFrame, int]:
    """Add ``chunk``: numbers that rise with ``doc_id``, about ``chunk_bytes`` of text each.

    The chunks' first ids, found as approximate quantiles, are broadcast: 8 bytes for each of at most
    ``most`` chunks, which grow beyond ``chunk_bytes`` after that.  Rows without an id come after all
    others, dealt to chunks of their own by a hash of their text.
    """
    size = F.octet_length("text")
    total, nameless = (x or 0 for x in df.agg(F.sum(size), F.sum(F.when(F.col("doc_id").isNull(), size))).first())
    n = min(most, max(least, math.ceil(total / chunk_bytes)))
    edges = df.approxQuantile("doc_id", [i / n for i in range(1, n)], max(0.2 / n, 1e-6)) if total else []
    first = df.sparkSession.sparkContext.broadcast(np.array(sorted({int(x) for x in edges}), np.int64))
    rest = max(1, math.ceil(nameless / max(1, total) * n))

    @F.pandas_udf("long")
    def under(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(first.value, ids.to_numpy(), "right"))

    own = under(F.coalesce("doc_id", F.lit(0).cast("long")))
    last = F.lit(len(first.value) + 1) + F.pmod(F.xxhash64("text"), F.lit(rest))
    return df.withColumn("chunk", F.when(F.col("doc_id").isNull(), last).otherwise(own)), len(first.value) + 1 + rest
