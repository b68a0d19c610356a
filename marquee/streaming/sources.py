"""Replayable vote sources (files); the socket source cannot replay, so it is not used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.votes import parse_vote_stream_lines


def file_vote_stream(spark: SparkSession, directory: str, schema: T.StructType,
                     file_glob: str | None = None, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the files arriving in ``directory``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(directory)


def text_vote_stream(spark: SparkSession, directory: str, file_glob: str | None = None) -> DataFrame:
    """Text lines ``tconst<TABs>rating[<TABs>event time]`` → ``tconst, rating, ts, valid``.

    Without a time field the arrival (micro-batch) time is used.  Invalid
    lines are kept with ``valid = false`` so a caller can route them to a
    reject sink instead of failing the query.
    """
    reader = spark.readStream.format("text")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    lines = reader.load(directory)
    third = F.try_element_at(F.split(F.col("value"), "\t+"), F.lit(3))
    with_ts = lines.withColumn(
        "ts", F.coalesce(F.trim(third).try_cast("timestamp"), F.current_timestamp()))
    return parse_vote_stream_lines(with_ts)


def kafka_vote_stream(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "latest") -> DataFrame:
    """Vote lines from a Kafka topic (replayable, unlike a socket).

    Needs Spark's Kafka connector on the classpath; the message value is a
    vote line as in ``text_vote_stream`` and the Kafka timestamp is the
    event time when the line carries none.
    """
    try:
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
        )
    except Exception as err:  # the data source is resolved here, before any connection
        if "kafka" in str(err).lower() and "find" in str(err).lower():
            raise RuntimeError(
                "kafka_vote_stream needs Spark's Kafka connector (spark-sql-kafka) on the classpath; "
                "use file_vote_stream or text_vote_stream otherwise") from err
        raise
    lines = raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("_kafka_ts"))
    third = F.try_element_at(F.split(F.col("value"), "\t+"), F.lit(3))
    with_ts = lines.withColumn("ts", F.coalesce(F.trim(third).try_cast("timestamp"), F.col("_kafka_ts"))).drop("_kafka_ts")
    return parse_vote_stream_lines(with_ts)
