"""Stored wide tables that loads write cells into: movies and people.

Each load is a batch of cells for some columns (the others NULL); the last cell that isn't NULL stands.  A load
writes its own rows only, and a compaction rewrites only the buckets that loads have touched since.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.collaborators import collaborator_counts
from marquee.operators.credits import credit_counts
from marquee.operators.ranking import top_titles_text
from marquee.plans.people import person_parts
from marquee.sinks.store import KeyedStore, latest_cells

MOVIES = ("tconst string, titleType string, primaryTitle string, originalTitle string, isAdult int, startYear int, endYear int, "
          "runtimeMinutes int, genres string, rating double")
PEOPLE = ("nconst string, primaryName string, birthYear int, deathYear int, total_movies long, distinct_titles long, "
          "top_text string, collaborators long")


def movies_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedStore:
    return KeyedStore(spark, root, MOVIES, ["tconst"], latest_cells, buckets=buckets)


def people_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedStore:
    return KeyedStore(spark, root, PEOPLE, ["nconst"], latest_cells, buckets=buckets)


def put_cells(table: KeyedStore, cells: DataFrame) -> int:
    """Upsert the columns that ``cells`` has (its key and any others of the table); the batch's number.

    Rows with a NULL key are left out; of several rows of one key in ``cells`` each column's greatest value that isn't NULL stands.
    """
    key = table.keys[0]
    unknown = set(cells.columns) - set(table.schema.names)
    if unknown:
        raise ValueError(f"the table has no columns {sorted(unknown)}")
    values = [c for c in cells.columns if c != key]
    one = cells.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(c).alias(c) for c in values]) if values else cells.distinct()
    batch = table.last_batch() + 1
    table.append(one.select(*[F.col(f.name) if f.name in one.columns else F.lit(None).cast(f.dataType).alias(f.name)
                              for f in table.schema.fields]), batch)
    return batch


def load_movie_cells(table: KeyedStore, titles: DataFrame | None = None, ratings: DataFrame | None = None) -> None:
    """Title cells, rating cells, or both (one batch each)."""
    if titles is not None:
        put_cells(table, titles.select(*[c for c in titles.columns if c in table.schema.names]))
    if ratings is not None:
        put_cells(table, ratings.select("tconst", F.col("averageRating").alias("rating")))


def load_people_cells(table: KeyedStore, people: DataFrame | None = None, credits: DataFrame | None = None,
                      ratings: DataFrame | None = None, n_top: int = 3, collaborators_where: Column | None = None,
                      value_format: str | None = None) -> None:
    """Info cells from ``people``; counts, co-workers and (with ``ratings``) top titles from ``credits``; one batch each."""
    if people is not None:
        put_cells(table, people.select("nconst", *[c for c in ("primaryName", "birthYear", "deathYear") if c in people.columns]))
    if credits is None:
        return
    if ratings is None:
        put_cells(table, credit_counts(credits))
        put_cells(table, collaborator_counts(credits, where=collaborators_where))
        return
    counts, top, co = person_parts(credits, ratings, n_top, collaborators_where)
    put_cells(table, counts)
    put_cells(table, co)
    put_cells(table, top_titles_text(top, value_format=value_format).select("nconst", "top_text"))
