"""StructTypes of the tab-separated inputs (positions as in the public dumps)."""

from pyspark.sql import types as T

from marquee.constants import HEADER_PERSON_KEY, HEADER_TITLE_KEY

TITLES = T.StructType([
    T.StructField("tconst", T.StringType()),
    T.StructField("titleType", T.StringType()),
    T.StructField("primaryTitle", T.StringType()),
    T.StructField("originalTitle", T.StringType()),
    T.StructField("isAdult", T.IntegerType()),
    T.StructField("startYear", T.IntegerType()),
    T.StructField("endYear", T.IntegerType()),
    T.StructField("runtimeMinutes", T.IntegerType()),
    T.StructField("genres", T.StringType()),
])

RATINGS = T.StructType([
    T.StructField("tconst", T.StringType()),
    T.StructField("averageRating", T.DoubleType()),
    T.StructField("numVotes", T.LongType()),
])

PEOPLE = T.StructType([
    T.StructField("nconst", T.StringType()),
    T.StructField("primaryName", T.StringType()),
    T.StructField("birthYear", T.IntegerType()),
    T.StructField("deathYear", T.IntegerType()),
    T.StructField("primaryProfession", T.StringType()),
    T.StructField("knownForTitles", T.StringType()),
])

CREDITS = T.StructType([
    T.StructField("tconst", T.StringType()),
    T.StructField("ordering", T.IntegerType()),
    T.StructField("nconst", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("job", T.StringType()),
    T.StructField("characters", T.StringType()),
])

# A parsed vote: title id, the rating given, and its event time.
VOTES = T.StructType([
    T.StructField("tconst", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])

# First header cell of each dump; a row whose key equals it is a header.
HEADER_KEYS = {"titles": HEADER_TITLE_KEY, "ratings": HEADER_TITLE_KEY, "people": HEADER_PERSON_KEY,
               "credits": HEADER_TITLE_KEY}
