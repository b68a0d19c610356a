"""Per-person credit counts and most-credited people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.constants import TOP_PEOPLE_N


def credit_counts(credits: DataFrame, person: str = "nconst", title: str = "tconst") -> DataFrame:
    """``person, total_movies, distinct_titles``.

    ``total_movies`` counts credits, so one person credited twice on a title
    counts twice (the reference's total); ``distinct_titles`` counts titles.
    Both are partial (map-side) aggregates, so a person holding a large
    share of all credits is pre-reduced in every map task.
    """
    return (
        credits.where(F.col(person).isNotNull())
        .groupBy(person)
        .agg(F.count(F.lit(1)).alias("total_movies"),
             F.count_distinct(F.col(title)).alias("distinct_titles"))
    )


def top_people(credits: DataFrame, person: str = "nconst", where: Column | None = None,
               n: int = TOP_PEOPLE_N) -> DataFrame:
    """The ``n`` people with most credits: ``person, credits``; ties by id.

    Planned as partial count → final count → ``TakeOrderedAndProject``; no
    full sort of the counts.
    """
    df = credits if where is None else credits.where(where)
    return (
        df.where(F.col(person).isNotNull())
        .groupBy(person)
        .agg(F.count(F.lit(1)).alias("credits"))
        .orderBy(F.desc("credits"), F.asc(person))
        .limit(n)
    )
