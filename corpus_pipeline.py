"""Documents to tokens: the stages of the corpus pipeline, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import stages
from marquee.llm.common import table, written

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", stages.identify_language),
    ("near_dedup", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("secrets", stages.redact_secrets),
    ("tokens", stages.encode_tokens),
]

#: The first, second and fourth stage learn or iterate: no SQL says them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
