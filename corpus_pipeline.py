"""The corpus pipeline: five stages over ``documents``, each an operator of ``fairweave.llm``.

Every stage takes the rows its predecessor kept; all but the last return the columns of
``documents``.  Documents are rejected by their id: of rows that share an id all go if one does,
and rows without an id can't be rejected and stay.  Null and empty texts stay; an empty table
gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairweave.llm._shared import written
from fairweave.llm.decontamination import find_contamination
from fairweave.llm.near_dedup import near_duplicates
from fairweave.llm.packing import pack
from fairweave.llm.secrets import redact_secrets
from fairweave.llm.toxicity import score_toxicity

#: Rejected ids up to which they are broadcast (8 bytes each).
_BROADCAST_ROWS = 500_000


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but for the ids in ``rejected``; rows of a null id stay."""
    ids = written(rejected.select("doc_id").where("doc_id is not null").distinct(), "rejected")
    if ids.count() <= _BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_anti").select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scored.where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity 0.8 or more) the document with the least id stays."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where("contaminated"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced, and n_chars follows the text."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: The stages learn, link and pack in ways that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
