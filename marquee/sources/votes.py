"""Votes: the logged form ``(tconst,rating)`` and the live line ``tconst<TABs>rating``.

Parsing never fails: a line that does not give an id and a number comes
out with ``valid = false`` (NULL rating), so callers can route it to a
reject output instead of killing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.constants import LIST_SEPARATOR, LOG_LINE_BRACKETS
from marquee.functions.text import parse_double


def _parsed(tconst: Column, rating_text: Column) -> list[Column]:
    rating = parse_double(rating_text)
    t = F.nullif(F.trim(tconst), F.lit(""))
    return [
        t.alias("tconst"),
        rating.alias("rating"),
        (t.isNotNull() & rating.isNotNull()).alias("valid"),
    ]


def parse_vote_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(tconst,rating)`` lines → ``tconst, rating, valid`` (+ other columns kept)."""
    body = F.regexp_replace(F.col(value), LOG_LINE_BRACKETS, "")
    parts = F.split(body, LIST_SEPARATOR)
    keep = [c for c in lines.columns if c != value]
    return lines.select(*keep, *_parsed(parts.getItem(0), F.try_element_at(parts, F.lit(2))))


def parse_vote_stream_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``tconst<one or more TABs>rating`` lines → ``tconst, rating, valid``."""
    parts = F.split(F.col(value), "\t+")
    keep = [c for c in lines.columns if c != value]
    return lines.select(*keep, *_parsed(parts.getItem(0), F.try_element_at(parts, F.lit(2))))


def read_vote_log(spark: SparkSession, root: str, file_glob: str = "part-*") -> DataFrame:
    """All vote-log files below ``root`` (any depth) → parsed votes.

    ``source_file`` records which log file a vote came from, for the
    processed-log ledger of the rating update; ``line_id`` increases with
    the line position inside a file (file order of the votes).
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_glob)
        .text(root)
        .select("value", F.col("_metadata.file_path").alias("source_file"),
                F.monotonically_increasing_id().alias("line_id"))
    )
    return parse_vote_log_lines(lines)


def read_window_log(spark: SparkSession, root: str) -> DataFrame:
    """The per-window log written by the vote-log stream or ``write_window_log`` → parsed votes.

    Read as a table, so the stream sink's commit metadata is respected (files
    of failed attempts are not seen).  ``source_file`` is the file of each vote, ``ts``
    its event time; a vote without id or with a NULL, NaN or infinite rating
    has ``valid = false``.
    """
    log = spark.read.parquet(root).select("*", F.col("_metadata.file_path").alias("source_file"))
    rating = F.col("rating").cast("double")
    ok = F.col("tconst").isNotNull() & rating.isNotNull() & ~F.isnan(rating) & (F.abs(rating) < F.lit(float("inf")))
    return log.select("tconst", rating.alias("rating"), F.coalesce(ok, F.lit(False)).alias("valid"), "ts", "source_file")


def vote_lines(votes: DataFrame, tconst: str = "tconst", rating: str = "rating") -> DataFrame:
    """Votes → their logged text form ``(tconst,rating)`` (column ``value``)."""
    return votes.select(
        F.concat(F.lit("("), F.col(tconst).cast("string"), F.lit(","),
                 F.col(rating).cast("string"), F.lit(")")).alias("value"),
        *[c for c in votes.columns if c not in (tconst, rating)],
    )
