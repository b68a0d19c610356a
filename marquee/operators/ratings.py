"""Fold logged votes into a rating table (average, number of votes)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Once |vote - average| / (n + 1) stays below this, a rounded step cannot
# move the average (it would need 0.05); the margin absorbs float error.
_STILL = 0.049
# Votes of one task, about: the number of tasks follows the votes, not the session's setting.
TASK_ROWS = 1_000_000


def update_ratings(ratings: DataFrame, votes: DataFrame, title: str = "tconst",
                   avg: str = "averageRating", n: str = "numVotes",
                   vote_title: str = "tconst", vote: str = "rating",
                   order: list[str] | None = None, rounded: bool = False) -> DataFrame:
    """``title, avg, n`` after adding every vote to its title's running mean.

    Titles without votes keep their row unchanged; a vote for an unrated
    title starts it at ``n = 0``.  Invalid votes (NULL id; NULL, NaN or
    infinite value) are ignored.

    ``rounded=False`` (default): the exact mean, ``(n·avg + Σv) / (n + k)``,
    a partial aggregate joined to the table with one full outer join.

    ``rounded=True``: the reference's fold, rounding the mean to one decimal
    (ties to even) after *every* vote, in ``order`` (default: the vote
    value) — order matters.  See ``_rounded_fold`` for how a title with a
    huge number of votes is kept bounded.
    """
    value = F.col(vote).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    v = votes.where(F.col(vote_title).isNotNull() & finite)
    if vote_title != title:
        v = v.withColumnRenamed(vote_title, title)
    base = ratings.select(title, avg, n).where(F.col(title).isNotNull())
    if rounded:
        return _rounded_fold(base, v, title, avg, n, vote, order or [vote])
    agg = v.groupBy(title).agg(F.sum(vote).alias("_s"), F.count(vote).alias("_k"))
    j = base.join(agg, title, "full")
    n0 = F.coalesce(F.col(n), F.lit(0)).cast("long")
    a0 = F.coalesce(F.col(avg), F.lit(0.0)).cast("double")
    new_avg = F.when(F.col("_k").isNull(), F.col(avg)).otherwise((n0 * a0 + F.col("_s")) / (n0 + F.col("_k")))
    new_n = n0 + F.coalesce(F.col("_k"), F.lit(0))
    return j.select(title, new_avg.cast("double").alias(avg), new_n.cast("long").alias(n))


def known_size(few: DataFrame) -> DataFrame:
    """A few rows, computed once and held by the plan, so Spark knows their size and broadcasts them only if it is small."""
    return few.sparkSession.createDataFrame(few.toArrow(), few.schema)


def _first_votes(v: DataFrame, limits: DataFrame, key: str, order: list[str], salt_buckets: int, tasks: int) -> DataFrame:
    """Votes with their title's ``_m, _s, _c`` (``limits``), less those that can't be among its first ``_m`` in ``order``.

    Cut per (title, bucket) of a hash of the order columns, so a title with very many votes is cut by many tasks; the
    first votes of a title are among the first of its buckets.  The limits of titles with more votes than a task takes (fewer than
    ``tasks``) are a table of known size, which Spark broadcasts when it is small.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salt_buckets))
    w = Window.partitionBy(key, "_salt").orderBy(*[F.asc(c) for c in order])
    hot = known_size(limits.where(F.col("_k") > TASK_ROWS))
    rest = v.join(hot.select(key), key, "left_anti").repartition(tasks, key).join(limits.repartition(tasks, key), key)
    both = rest.unionByName(v.join(hot, key).select(*rest.columns)).drop("_k")
    salted = both.withColumn("_salt", salt).repartition(tasks, key, "_salt").withColumn("_rn", F.row_number().over(w))
    return salted.where(F.col("_rn") <= F.col("_m")).drop("_rn", "_salt")


def _fold_stream(first: DataFrame, title: str, vote: str, order: list[str], tasks: int) -> DataFrame:
    """``title, _folded``: the rounded fold over each title's first ``_m`` votes, as one pass over sorted rows.

    A task holds one Arrow batch and the running mean of one title, whatever the title's votes and their range.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mean, n, left = None, 0.0, 0, 0
        for batch in batches:
            done, means = [], []
            for key, value, most, start, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if now is not None:
                        done.append(now)
                        means.append(mean)
                    now, mean, n, left = key, start, count, most
                if left > 0:
                    mean = round((n * mean + value) / (n + 1) * 10.0) / 10.0  # ties to even
                    n += 1
                    left -= 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done, batch.schema.field(0).type), pa.array(means, pa.float64())], names=[title, "_folded"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([mean], pa.float64())], names=[title, "_folded"])

    rows = first.repartition(tasks, title).sortWithinPartitions(title, *[F.asc(c) for c in order])
    kind = first.schema[title].dataType.simpleString()
    return rows.select(title, F.col(vote).cast("double"), "_m", "_s", "_c").mapInArrow(run, f"{title} {kind}, _folded double")


def _rounded_fold(base: DataFrame, v: DataFrame, title: str, avg: str, n: str,
                  vote: str, order: list[str], salt_buckets: int = 64) -> DataFrame:
    """The order-dependent rounded fold, exact and in bounded memory.

    After the first step the average sits on the 0.1 grid inside
    ``[lo - 0.1, hi + 0.1]`` (``lo``/``hi``: smallest/largest of the votes and
    the start value), so a step changes nothing once
    ``(hi - lo + 0.2) / (n + 1) < 0.049``.  Only the first ``m`` votes of a
    title (``m`` from its own ``n``, ``lo``, ``hi``) can move its average; the
    rest only add to the count.  Each title is cut at its own ``m`` and only
    there, so its result doesn't depend on which other titles there are;
    the plan is the same at every size.  The votes left are sorted by title and order and folded as a stream.
    """
    stats = v.groupBy(title).agg(
        F.count(vote).alias("_k"), F.min(vote).alias("_lo"), F.max(vote).alias("_hi"))
    j = base.join(stats, title, "full")
    n0 = F.coalesce(F.col(n), F.lit(0)).cast("long")
    a0 = F.coalesce(F.col(avg), F.lit(0.0)).cast("double")
    lo = F.when(F.col(avg).isNull(), F.col("_lo")).otherwise(F.least(F.col("_lo"), F.col(avg)))
    hi = F.when(F.col(avg).isNull(), F.col("_hi")).otherwise(F.greatest(F.col("_hi"), F.col(avg)))
    need = F.greatest(F.lit(1), F.ceil((hi - lo + F.lit(0.2)) / F.lit(_STILL)) - n0 + F.lit(1)).cast("long")
    j = j.select(title, avg, n, "_k", F.when(F.col("_k").isNotNull(), need).alias("_m"))

    limits = j.where(F.col("_k").isNotNull()).select(title, "_m", a0.alias("_s"), n0.alias("_c"), "_k")
    tasks = max(1, -(-v.count() // TASK_ROWS))
    folded = _fold_stream(_first_votes(v, limits, title, order, salt_buckets, tasks), title, vote, order, tasks)
    out = j.join(folded, title, "left")
    new_avg = F.when(F.col("_k").isNull(), F.col(avg)).otherwise(F.col("_folded"))
    new_n = n0 + F.coalesce(F.col("_k"), F.lit(0))
    return out.select(title, new_avg.cast("double").alias(avg), new_n.cast("long").alias(n))
