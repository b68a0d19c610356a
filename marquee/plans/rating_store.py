"""Running ratings as stored partial sums, fed from the vote log's batches.

    <root>/partials   title -> sum and number of its votes, in buckets (each fold writes the sums of its new votes only)
    <root>/applied    stream -> last log batch that is counted in

The ledger names batches of the log, not files, so the log can be compacted at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sinks.store import KeyedStore, all_rows, latest_row, sums

SEED = "initial ratings"


def vote_store(spark: SparkSession, root: str, title_type: str = "string") -> KeyedStore:
    """The logged votes, by the day of their window: ``tconst, rating, ts, w, log_batch``."""
    return KeyedStore(spark, root, f"tconst {title_type}, rating double, ts timestamp, w string, log_batch long", ["tconst"], all_rows,
                      F.coalesce(F.substring("w", 1, 10), F.lit("none")))


def _partials(spark: SparkSession, root: str, title_type: str) -> KeyedStore:
    return KeyedStore(spark, f"{root}/partials", f"tconst {title_type}, total double, votes long", ["tconst"], sums, buckets=64)


def _applied(spark: SparkSession, root: str) -> KeyedStore:
    return KeyedStore(spark, f"{root}/applied", "stream string, upto long, votes long", ["stream"], latest_row, buckets=1)


def _put(spark: SparkSession, root: str, title_type: str, votes: DataFrame, stream: str, upto: int) -> int:
    """Add sums and then the ledger's row under the same number: a run that broke off in between is replaced by the next one."""
    applied = _applied(spark, root)
    run = applied.last_batch() + 1
    partials = _partials(spark, root, title_type)
    partials.append(votes, run)
    n = partials.delta(run).agg(F.sum("votes")).first()[0] or 0
    applied.append(spark.createDataFrame([(stream, upto, n)], applied.schema), run)
    return n


def seed_ratings(spark: SparkSession, root: str, ratings: DataFrame) -> None:
    """Start a store from ``tconst, averageRating, numVotes``; refused where one has begun."""
    if _applied(spark, root).last_batch() >= 0:
        raise ValueError(f"{root} is a rating store already")
    kind = ratings.schema["tconst"].dataType.simpleString()
    rows = ratings.where("tconst IS NOT NULL").select(
        "tconst", (F.col("averageRating") * F.col("numVotes")).cast("double").alias("total"), F.col("numVotes").cast("long").alias("votes"))
    _put(spark, root, kind, rows, SEED, 0)


def fold_log(spark: SparkSession, root: str, log: KeyedStore, stream: str = "votes", compact_every: int = 10) -> int:
    """Count the log's new batches in; the number of votes added.  Running it again, or after a compaction of the log, adds nothing twice."""
    applied = _applied(spark, root)
    found = applied.read().where(F.col("stream") == stream).first()
    upto, last = (found["upto"] if found else -1), log.last_batch()
    if last <= upto:
        return 0
    kind = log.schema["tconst"].dataType.simpleString()
    rating = F.col("rating")
    good = F.col("tconst").isNotNull() & rating.isNotNull() & ~F.isnan(rating) & (F.abs(rating) < F.lit(float("inf")))
    new = log.since(upto, "log_batch").where((F.col("log_batch") <= last) & good)
    n = _put(spark, root, kind, new.groupBy("tconst").agg(F.sum("rating").alias("total"), F.count("rating").alias("votes")), stream, last)
    if (applied.last_batch() + 1) % compact_every == 0:
        _partials(spark, root, kind).compact()
    return n


def read_ratings_of(spark: SparkSession, root: str, title_type: T.DataType | str = "string") -> DataFrame:
    """``tconst, averageRating, numVotes``."""
    kind = title_type if isinstance(title_type, str) else title_type.simpleString()
    return _partials(spark, root, kind).read().select(
        "tconst", (F.col("total") / F.when(F.col("votes") > 0, F.col("votes"))).alias("averageRating"), F.col("votes").alias("numVotes"))
