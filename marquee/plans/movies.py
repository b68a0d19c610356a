"""Title products: the movies table (titles + rating) and the rating update."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.merge import merge_by_key
from marquee.operators.ratings import update_ratings
from marquee.sinks.files import has_versions, read_current, write_version
from marquee.sources.votes import read_vote_log, read_window_log

TITLE_COLUMNS = ["tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
                 "startYear", "endYear", "runtimeMinutes", "genres"]


def build_movies(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Titles and ratings merged by id: title columns + ``rating`` (votes dropped).

    A rated id without title row appears with NULL title cells, and an
    unrated title with a NULL rating (full outer, as two loads into one
    keyed table).
    """
    cols = [c for c in TITLE_COLUMNS if c in titles.columns]
    if "genre_list" in titles.columns:
        cols.append("genre_list")
    return merge_by_key("tconst", titles.select(*cols),
                        ratings.select("tconst", F.col("averageRating").alias("rating")))


def update_rating_store(spark: SparkSession, root: str, log_root: str | DataFrame,
                        initial: DataFrame | None = None, rounded: bool = False, log_format: str = "text") -> str:
    """Fold every *not yet applied* vote-log file into the rating store at ``root``.

    ``root`` holds versions with two parts: ``ratings`` and ``ledger`` (the
    log files already applied).  All new files are applied in one pass, the
    result and the extended ledger are written as a new version, and only
    then does ``_current`` move — so rerunning never applies a log twice,
    and a failure leaves the previous version current.  ``initial`` seeds
    an empty store; it is refused where versions exist without a pointer.
    ``log_root`` is a folder of ``(tconst,rating)`` text files
    (``log_format="text"``) or of the log that the vote stream writes
    (``"window"``), or a DataFrame of parsed votes with a ``source_file`` column.
    Votes that don't parse are kept as the version's ``rejects``.  New files
    without a single valid vote are an error: they are no vote log.
    Returns the new version name.
    """
    if log_format not in ("text", "window"):
        raise ValueError("log_format must be 'text' or 'window'")
    ratings = read_current(spark, root, "ratings")
    ledger = read_current(spark, root, "ledger")
    if ratings is None:
        if initial is None:
            raise ValueError(f"no rating store at {root} and no initial ratings given")
        if has_versions(spark, root):
            raise ValueError(f"{root} holds versions but no pointer to the current one; initial ratings are refused")
        ratings = initial.select("tconst", "averageRating", "numVotes")
    if ledger is None:
        ledger = spark.createDataFrame([], "source_file string")
    votes = log_root
    if isinstance(log_root, str):
        votes = (read_window_log if log_format == "window" else read_vote_log)(spark, log_root)
    fresh = votes.join(ledger, "source_file", "left_anti")
    new_votes, rejects = fresh.where("valid"), fresh.where("NOT valid")
    if new_votes.isEmpty() and not rejects.isEmpty():
        raise ValueError(f"no valid vote in the new files of {log_root if isinstance(log_root, str) else 'the log'}")
    order = ["ts", "rating"] if "ts" in new_votes.columns else ["source_file", "line_id"]
    updated = update_ratings(ratings, new_votes.select("tconst", "rating", *[c for c in order if c != "rating"]),
                             order=order, rounded=rounded)
    files = fresh.select("source_file").distinct()
    return write_version(spark, root, {"ratings": updated, "ledger": ledger.unionByName(files).distinct(),
                                       "rejects": rejects})
