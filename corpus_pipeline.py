"""A training corpus from ``documents`` in five stages, each an operator of ``hearth.llm``.

Every stage takes what its predecessor kept, written as Parquet and read
again, works on all of it, and returns the columns of ``documents``; the last one
returns token ids.  Empty and null texts pass through all stages; an empty
table stays empty; extra columns are carried along unread.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import containment, group_join, prefix_bpe, secret_ledger, toxicity
from hearth.llm.common import table
from hearth.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine takes for toxic go."""
    machine = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle similarity the one with the smallest doc_id stays."""
    return group_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return containment.decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; ``n_chars`` follows."""
    return secret_ledger.redact_documents(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, one row per document."""
    return prefix_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("byte_bpe", byte_bpe_stage),
]

#: The first stage is a trained machine, which SQL does not express; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for at, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return out
        path = f"{base}/{at}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    raise ValueError("no stages")
