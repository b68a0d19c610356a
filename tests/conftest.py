import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from marquee.session import local_session

    s = local_session(4, shuffle_partitions=8, app_name="marquee-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    """The micro-fixture of FIXTURES.md §3 as DataFrames."""
    titles = spark.createDataFrame(
        [("tt1", "movie", "Alpha", "Alpha", 0, 2000, None, 90, "Drama"),
         ("tt2", "movie", "Beta", "Beta", 0, 2001, None, 95, "Comedy,Drama"),
         ("tt3", "movie", "Gamma", "Gamma", 0, 2002, None, 100, None),
         ("tt4", "short", "Delta", "Delta", 0, 2003, None, 10, "Short")],
        "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult int, "
        "startYear int, endYear int, runtimeMinutes int, genres string")
    ratings = spark.createDataFrame(
        [("tt1", 8.0, 100), ("tt2", 9.0, 50), ("tt3", 7.0, 10), ("tt9", 5.0, 3)],
        "tconst string, averageRating double, numVotes long")
    people = spark.createDataFrame(
        [("nm1", "Ana", 1970, None), ("nm2", "Bo", 1980, None), ("nm3", "Cy", None, None),
         ("nm4", "Di", 1990, 2020), ("nm6", "Fay", 1960, None)],
        "nconst string, primaryName string, birthYear int, deathYear int")
    credits = spark.createDataFrame(
        [("tt1", 1, "nm1", "actor"), ("tt1", 2, "nm2", "actress"), ("tt1", 3, "nm3", "director"),
         ("tt2", 1, "nm1", "actor"), ("tt2", 2, "nm4", "voice_actor"),
         ("tt3", 1, "nm1", "actor"), ("tt3", 2, "nm1", "producer"),
         ("tt4", 1, "nm2", "actress"),
         ("tt5", 1, "nm5", "actor")],
        "tconst string, ordering int, nconst string, category string")
    log = spark.createDataFrame(
        [("tt1", 10.0, 1), ("tt1", 6.0, 2), ("tt3", 9.0, 3), ("tt7", 4.0, 4)],
        "tconst string, rating double, seq long")
    return {"titles": titles, "ratings": ratings, "people": people, "credits": credits, "log": log}
