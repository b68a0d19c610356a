"""Stream forms of the vote products, run to completion over the test tables.

Each callable streams ``events`` of ``sf_dir`` through the real streaming
query (file source, ``availableNow``), with sink and checkpoint under the
shared folder, and returns the written result as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.plans.movies import update_rating_store
from marquee.plans.rating_store import fold_log, read_ratings_of, seed_ratings, vote_store
from marquee.plans.roles import TS_TEXT, names, rating_base
from marquee.session import scratch_path
from marquee.sinks.files import read_current
from marquee.streaming.queries import read_sliding_top, read_trending, start_sliding_top, start_trending, start_vote_log, start_vote_store
from marquee.streaming.sources import file_vote_stream

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def event_votes(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    raw = file_vote_stream(spark, sf_dir, EVENTS, file_glob="events.parquet",
                           max_files_per_trigger=max_files_per_trigger)
    return raw.select(F.col("user_id").alias("tconst"), F.col("value").alias("rating"),
                      F.col("ts").cast("timestamp").alias("ts"))


def _run(query) -> None:
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()


def vote_log_stream(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "vote_log"), scratch_path(spark, "vote_log-ckpt")
    _run(start_vote_log(event_votes(spark, sf_dir), sink, ckpt))
    schema = T.StructType([T.StructField("tconst", T.LongType()), T.StructField("rating", T.DoubleType()),
                           T.StructField("ts", T.TimestampType()), T.StructField("w", T.StringType()),
                           T.StructField("d", T.StringType())])
    log = spark.read.schema(schema).parquet(sink)
    end = F.to_timestamp(F.col("w"), "yyyy-MM-dd_HH_mm")
    return log.select(
        "w",
        F.date_format(end - F.expr("INTERVAL 10 MINUTES"), TS_TEXT).alias("window_start"),
        F.date_format(end, TS_TEXT).alias("window_end"),
        "tconst", "rating", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


def sliding_top3_stream(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "sliding_top3"), scratch_path(spark, "sliding_top3-ckpt")
    _run(start_sliding_top(event_votes(spark, sf_dir), names(spark, sf_dir), sink, ckpt))
    out = spark.read.parquet(sink).drop("batch")
    return out.select(F.date_format("window_start", TS_TEXT).alias("window_start"),
                      F.date_format("window_end", TS_TEXT).alias("window_end"),
                      "rank", "tconst", "name", F.round("average", 6).alias("average"))


def _top_rows(spark, sink):
    return read_sliding_top(spark, sink).select(
        F.date_format("window_start", TS_TEXT).alias("window_start"), F.date_format("window_end", TS_TEXT).alias("window_end"),
        "rank", "tconst", "name", F.round("average", 6).alias("average"))


def sliding_top3_stream_open(spark, sf_dir):
    """All windows, those still open at the end of the input too."""
    sink, ckpt = scratch_path(spark, "sliding_top3-open"), scratch_path(spark, "sliding_top3-open-ckpt")
    _run(start_sliding_top(event_votes(spark, sf_dir), names(spark, sf_dir), sink, ckpt, open_windows=True))
    return _top_rows(spark, sink)


def _trending_rows(spark, sink):
    return read_trending(spark, sink).select(
        F.date_format("window_start", TS_TEXT).alias("window_start"), F.date_format("window_end", TS_TEXT).alias("window_end"),
        "tconst", "name", "votes")


def trending_15m_stream(spark, sf_dir):
    """All windows, those still open at the end of the input too."""
    sink, ckpt = scratch_path(spark, "trending"), scratch_path(spark, "trending-ckpt")
    _run(start_trending(event_votes(spark, sf_dir), names(spark, sf_dir), sink, ckpt))
    return _trending_rows(spark, sink)


def late_event_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events dealt at random into four files, read as four micro-batches: most votes of the later ones come days late."""
    path = scratch_path(spark, "late-events")
    spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").repartition(4, F.xxhash64("event_id")).write.parquet(path)
    raw = file_vote_stream(spark, path, EVENTS, file_glob="*.parquet", max_files_per_trigger=1)
    return raw.select(F.col("user_id").alias("tconst"), F.col("value").alias("rating"), F.col("ts").cast("timestamp").alias("ts"))


def sliding_top3_stream_late(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "sliding_top3-late"), scratch_path(spark, "sliding_top3-late-ckpt")
    _run(start_sliding_top(late_event_votes(spark, sf_dir), names(spark, sf_dir), sink, ckpt, open_windows=True, compact_every=2))
    return _top_rows(spark, sink)


def trending_15m_stream_late(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "trending-late"), scratch_path(spark, "trending-late-ckpt")
    _run(start_trending(late_event_votes(spark, sf_dir), names(spark, sf_dir), sink, ckpt, compact_every=2))
    return _trending_rows(spark, sink)


def ratings_update_from_stream_log(spark, sf_dir):
    """The whole chain: the stream logs the votes, the batch update folds the log into the rating store."""
    sink, ckpt, store = (scratch_path(spark, n) for n in ("rating_log", "rating_log-ckpt", "rating_store"))
    _run(start_vote_log(event_votes(spark, sf_dir), sink, ckpt))
    update_rating_store(spark, store, sink, initial=rating_base(spark, sf_dir), log_format="window")
    return read_current(spark, store, "ratings").withColumn("averageRating", F.round("averageRating", 6))


def ratings_store_from_compacted_log(spark, sf_dir):
    """Votes logged in four batches, folded, the log compacted, folded again: nothing is counted twice."""
    log, ckpt, store = (scratch_path(spark, n) for n in ("vote-store", "vote-store-ckpt", "rating-sums"))
    votes = vote_store(spark, log, "bigint")
    seed_ratings(spark, store, rating_base(spark, sf_dir))
    _run(start_vote_store(late_event_votes(spark, sf_dir), votes, ckpt))
    fold_log(spark, store, votes, compact_every=2)
    votes.compact()
    fold_log(spark, store, votes)
    return read_ratings_of(spark, store, "bigint").withColumn("averageRating", F.round("averageRating", 6))


STREAMS = {
    "ratings_store_from_compacted_log": ratings_store_from_compacted_log,
    "ratings_update_from_stream_log": ratings_update_from_stream_log,
    "vote_log_stream": vote_log_stream,
    "sliding_top3_stream": sliding_top3_stream,
    "sliding_top3_stream_open": sliding_top3_stream_open,
    "sliding_top3_stream_late": sliding_top3_stream_late,
    "trending_15m_stream": trending_15m_stream,
    "trending_15m_stream_late": trending_15m_stream_late,
}
