"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def create_table(df: DataFrame, name: str, fmt: str = "parquet", bucket_by: str | None = None,
                 buckets: int | None = None) -> None:
    """Create ``name`` from ``df``; fails if the table already exists.

    ``bucket_by``/``buckets`` store the table bucketed on its key, so later
    joins and aggregations on that key read it without a shuffle.
    """
    writer = df.write.mode("errorifexists").format(fmt)
    if bucket_by:
        writer = writer.bucketBy(buckets or 64, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
