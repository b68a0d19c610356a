"""Best-rated titles per person (top-N per group)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import TOP_TITLES_N
from marquee.functions.text import render_ranked_map


def scored_credits(credits: DataFrame, ratings: DataFrame, person: str = "nconst",
                   title: str = "tconst", score: str = "averageRating") -> DataFrame:
    """Inner join of credits with one score per title: ``person, title, score``.

    Titles without a score, and credits of unknown titles, drop out.  If a
    title is scored twice, the higher score is used.
    """
    c = credits.select(person, title).where(F.col(person).isNotNull() & F.col(title).isNotNull())
    r = (
        ratings.where(F.col(title).isNotNull() & F.col(score).isNotNull())
        .groupBy(title).agg(F.max(score).alias(score))
    )
    return c.join(r, title, "inner")


def top_titles(credits: DataFrame, ratings: DataFrame, person: str = "nconst",
               title: str = "tconst", score: str = "averageRating", n: int = TOP_TITLES_N,
               where: Column | None = None) -> DataFrame:
    """``person, rank, title, score``: each person's ``n`` best titles.

    Order: score descending, then title id ascending (a total order, so the
    result is deterministic).  A title credited twice to one person counts
    once.  ``dense_rank`` over (score, title) gives duplicates of one credit
    the same rank, so the rank filter is pushed below the shuffle as a
    per-partition group limit; the duplicates are dropped afterwards, inside
    the same partitioning.
    """
    c = credits if where is None else credits.where(where)
    joined = scored_credits(c, ratings, person, title, score)
    w = Window.partitionBy(person).orderBy(F.desc(score), F.asc(title))
    return (
        joined.withColumn("rank", F.dense_rank().over(w))
        .where(F.col("rank") <= F.lit(n))
        .dropDuplicates([person, title])
        .select(person, "rank", title, score)
    )


def top_titles_text(top: DataFrame, person: str = "nconst", title: str = "tconst",
                    score: str = "averageRating", value_format: str | None = None) -> DataFrame:
    """``person, top, top_text``: the ranked rows as an ordered list and as ``{t=r, …}``.

    Groups hold at most ``n`` rows, so collecting them is bounded.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col(title), F.col(score))))
    return (
        top.groupBy(person).agg(items.alias("_items"))
        .select(
            person,
            F.transform("_items", lambda x: F.struct(x[title].alias(title), x[score].alias(score))).alias("top"),
            render_ranked_map("_items", title, score, value_format).alias("top_text"),
        )
    )
