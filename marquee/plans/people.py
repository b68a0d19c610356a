"""Person products: the people table (info, credit count, top titles, co-workers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.collaborators import collaborator_counts
from marquee.operators.merge import merge_by_key
from marquee.operators.ranking import top_titles, top_titles_text
from marquee.sinks.files import scratch_table


def person_parts(credits: DataFrame, ratings: DataFrame, n_top: int = 3,
                 collaborators_where: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(credit counts, top titles, co-worker counts) from one pass over the credits.

    The credits are grouped once by person and title and stored, with their number and whether any of them is
    of ``collaborators_where``; the three products read that table, which is no larger than the credits.
    """
    inside = F.lit(True) if collaborators_where is None else F.coalesce(collaborators_where, F.lit(False))
    grouped = (credits.where(F.col("nconst").isNotNull()).groupBy("nconst", "tconst")
               .agg(F.count(F.lit(1)).alias("_credits"), F.max(inside).alias("_in")))
    members = scratch_table(grouped, "person-titles")
    counts = members.groupBy("nconst").agg(F.sum("_credits").alias("total_movies"), F.count("tconst").alias("distinct_titles"))
    return counts, top_titles(members, ratings, n=n_top), collaborator_counts(members.where("_in"), unique=True)


def build_people(people: DataFrame, credits: DataFrame, ratings: DataFrame, n_top: int = 3,
                 collaborators_where: Column | None = None) -> DataFrame:
    """One row per person id seen in any input:

    ``nconst, primaryName, birthYear, deathYear`` (info) ·
    ``total_movies, distinct_titles`` (credit counts) ·
    ``top, top_text`` (best ``n_top`` rated titles) ·
    ``collaborators`` (number of distinct co-workers; filter with
    ``collaborators_where``, e.g. ``is_performer()`` for co-actors).

    A cell whose input has no row for the person is NULL (a person without
    credits has only info; a credited id missing from ``people`` has no
    name).  The co-worker *sets* themselves are ``collaborator_sets``: a
    set can be as large as the credits of its biggest title, so it is
    kept as bounded rows instead of one cell.
    """
    info = people.select("nconst", *[c for c in ("primaryName", "birthYear", "deathYear") if c in people.columns])
    counts, top, co = person_parts(credits, ratings, n_top, collaborators_where)
    return merge_by_key("nconst", info, counts, top_titles_text(top), co)
