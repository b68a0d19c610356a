"""Column merge of several tables by a shared row key (keyed upsert)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_by_key(key: str, *frames: DataFrame, written_at: str | None = None) -> DataFrame:
    """Full-outer merge of ``frames`` on ``key``, as cells written into one wide table.

    Every key of any frame appears once.  Each column takes its value from
    the *last* frame (argument order) that holds a non-NULL value for it at
    that key, so a later frame overwrites earlier cells and leaves other
    cells untouched; a cell nobody wrote is NULL.

    A column has the widest type of the frames that hold it.  Within one frame,
    rows that share a key are written in the order of ``written_at`` (a column of the frames, not of the result; NULL and
    missing come first): the last non-NULL cell of each column stays.  Rows of one time, or all without
    ``written_at``, go by their values: the greatest non-NULL cell stays.

    Planned as a tagged union plus one grouped aggregation, i.e. a single
    shuffle for any number of inputs (a chain of full outer joins would
    shuffle once per input, because a coalesced join key loses the
    partitioning).
    """
    if not frames:
        raise ValueError("merge_by_key needs at least one frame")
    # Common types as Spark's own union finds them: int and double meet in double, nothing is narrowed.
    typed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.limit(0) for f in frames]).schema
    columns = [f.name for f in typed.fields if f.name not in (key, written_at)]
    types = {f.name: f.dataType for f in typed.fields}
    key_type = types[key]

    def widen(i: int, f: DataFrame) -> DataFrame:
        cols = [F.col(key).cast(key_type).alias(key)]
        for c in columns:
            cols.append((F.col(c) if c in f.columns else F.lit(None)).cast(types[c]).alias(c))
        at = F.lit(None) if written_at is None or written_at not in f.columns else F.col(written_at)
        at = at.cast(types[written_at]) if written_at in types else at.cast("int")
        return f.where(F.col(key).isNotNull()).select(*cols, F.struct(F.lit(i).alias("frame"), at.alias("at")).alias("_src"))

    union = reduce(DataFrame.unionByName, [widen(i, f) for i, f in enumerate(frames)])

    def order(c: str):
        kind = union.schema[c].dataType.typeName()
        return F.struct("_src", c) if kind not in ("map", "variant") else F.col("_src")

    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order(c))).alias(c) for c in columns]
    return union.groupBy(key).agg(*aggs)


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Rows of ``updates`` written over ``target``: named cells replaced, others kept."""
    return merge_by_key(key, target, updates)
