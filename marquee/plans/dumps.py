"""The dump readers and the text hand-offs on the test tables.

Each query writes whole test tables as text under the shared folder, in the
form of the dumps, and reads them back with the readers of ``sources``.  Ids
are text there, as in the dumps.  Roles:

* movies: titles = ``part`` (name, type, size as year, brand and type as genres), ratings = ``orders``.
* people: people = ``part``, credits = ``lineitem``, ratings = ``orders``.
* vote log: ``events``, whose ``error`` events are bad lines; the base is ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import operators as ops
from marquee import schemas
from marquee.functions.text import encode_scored, render_ranked_map
from marquee.plans import roles, tables
from marquee.plans.movies import build_movies, update_rating_store
from marquee.plans.people import build_people
from marquee.session import scratch_path
from marquee.sinks.files import read_current, write_key_lists, write_tsv
from marquee.sources import tsv
from marquee.sources.votes import vote_lines

# Credits of one person that a hand-off line holds here: small, so that many lists take several lines.
LINE_ITEMS = 20


def _dump(spark: SparkSession, name: str, df: DataFrame, schema, **cells) -> str:
    """Writes ``cells`` (others NULL) in the columns of ``schema``; the path."""
    path = scratch_path(spark, name)
    write_tsv(df.select(*[F.lit(cells.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]), path)
    return path


def _orders_as_ratings(spark, d) -> DataFrame:
    path = _dump(spark, "dump-ratings", roles.table(spark, d, "orders"), schemas.RATINGS,
                 tconst=F.col("o_orderkey"), averageRating=F.col("o_totalprice"), numVotes=F.col("o_custkey"))
    return tsv.read_ratings(spark, path)


def load_movies(spark, d):
    path = _dump(spark, "dump-titles", roles.table(spark, d, "part"), schemas.TITLES,
                 tconst=F.col("p_partkey"), titleType=F.col("p_type"), primaryTitle=F.col("p_name"),
                 startYear=F.col("p_size"), genres=F.concat_ws(",", "p_brand", "p_type"))
    movies = build_movies(tsv.read_titles(spark, path), _orders_as_ratings(spark, d))
    return movies.withColumn("genre_list", F.array_join("genre_list", "|"))


def load_people(spark, d):
    people = _dump(spark, "dump-people", roles.table(spark, d, "part"), schemas.PEOPLE,
                   nconst=F.col("p_partkey"), primaryName=F.col("p_name"), birthYear=F.col("p_size"),
                   primaryProfession=F.col("p_type"))
    credits = _dump(spark, "dump-credits", roles.table(spark, d, "lineitem"), schemas.CREDITS,
                    tconst=F.col("l_orderkey"), ordering=F.col("l_linenumber"), nconst=F.col("l_partkey"),
                    category=F.col("l_returnflag"))
    out = build_people(tsv.read_people(spark, people), tsv.read_credits(spark, credits), _orders_as_ratings(spark, d))
    return out.withColumn("top_text", render_ranked_map("top", "tconst", "averageRating", "decimal(18,2)")).drop("top")


def credits_key_lists(spark, d):
    path = scratch_path(spark, "key-lists")
    lines = ops.list_lines(ops.positions(roles.credits(spark, d), "nconst", "tconst"), "nconst", "tconst", LINE_ITEMS)
    write_key_lists(lines, path, "nconst")
    back = tsv.read_key_lists(spark, path, "nconst", "tconst", "long")
    return back.withColumn("nconst", F.col("nconst").cast("long"))


def top3_scored_lists(spark, d):
    path = scratch_path(spark, "scored-lists")
    top = ops.top_titles(roles.credits(spark, d), roles.ratings(spark, d), n=3)  # three items a person
    pairs = top.groupBy("nconst").agg(F.collect_list(encode_scored("tconst", "averageRating")).alias("items"))
    write_key_lists(pairs, path, "nconst")
    back = tsv.read_scored_lists(spark, path)
    return back.select(F.col("nconst").cast("long").alias("nconst"), F.col("tconst").cast("long").alias("tconst"), "averageRating")


def ratings_update_from_text_log(spark, d):
    log, store = scratch_path(spark, "text-log"), scratch_path(spark, "text-log-store")
    vote_lines(roles.event_votes_with_errors(spark, d)).write.text(f"{log}/run")
    base = roles.rating_base(spark, d).withColumn("tconst", F.col("tconst").cast("string"))
    update_rating_store(spark, store, log, initial=base)
    out = read_current(spark, store, "ratings")
    return out.select(F.col("tconst").cast("long").alias("tconst"), F.round("averageRating", 6).alias("averageRating"), "numVotes")


def ratings_dump_rejects(spark, d):
    """``orders`` as a ratings dump with a header in every file; urgent orders lack a field, high ones have no number, medium
    ones a field too many.  All lines come back, accepted or rejected."""
    priority, cells = F.substring("o_orderpriority", 1, 1), ["o_orderkey", "o_totalprice", "o_custkey"]
    text = [F.col(c).cast("string") for c in cells]
    line = (F.when(priority == "1", F.concat_ws("\t", *text[:2])).when(priority == "2", F.concat_ws("\t", text[0], F.lit("n/a"), text[2]))
            .when(priority == "3", F.concat_ws("\t", *text, F.lit("more"))).otherwise(F.concat_ws("\t", *text)))
    lines, path = roles.table(spark, d, "orders").select(line.alias("value")), scratch_path(spark, "dump-bad-ratings")
    lines.write.text(f"{path}/lines")
    spark.range(1).select(F.lit("\t".join(schemas.RATINGS.names)).alias("value")).write.text(f"{path}/header")
    rows, rejects = tsv.split_dump(spark, [f"{path}/lines", f"{path}/header"], schemas.RATINGS, scratch_path(spark, "dump-split"),
                                   schemas.HEADER_KEYS["ratings"])
    return (rows.select("tconst", "averageRating", "numVotes", F.lit(None).cast("string").alias("reason"))
            .unionByName(rejects.select(F.substring_index("line", "\t", 1).alias("tconst"), F.lit(None).cast("double").alias("averageRating"),
                                        F.lit(None).cast("long").alias("numVotes"), "reason")))


def people_table_cells(spark, d):
    """The stored people table: loads of info, counts, co-workers and top titles, a compaction, then new names for the
    people of one size, read with their deltas."""
    table = tables.people_table(spark, scratch_path(spark, "people-table"), buckets=16)
    text = lambda c: F.col(c).cast("string").alias(c)
    people = roles.people(spark, d).select(text("nconst"), "primaryName")
    credits = roles.credits(spark, d).select(text("tconst"), text("nconst"), "category")
    tables.load_people_cells(table, people, credits, roles.ratings(spark, d).select(text("tconst"), "averageRating"),
                             value_format="decimal(18,2)")
    table.compact()
    renamed = roles.table(spark, d, "part").where("p_size = 1").select(
        F.col("p_partkey").cast("string").alias("nconst"), F.upper("p_name").alias("primaryName"))
    tables.put_cells(table, renamed)
    return table.read()


DUMPS = {
    "ratings_dump_rejects": ratings_dump_rejects,
    "people_table_cells": people_table_cells,
    "load_movies": load_movies,
    "load_people": load_people,
    "credits_key_lists": credits_key_lists,
    "top3_scored_lists": top3_scored_lists,
    "ratings_update_from_text_log": ratings_update_from_text_log,
}
