"""Command line: the three jobs of a credits-and-ratings deployment.

    python -m marquee.cli load     --titles T --ratings R --people P --credits C --out DIR [--tables DIR]
    python -m marquee.cli batch    --credits C --ratings-store DIR --logs DIR [--initial-ratings R] [--rounded]
    python -m marquee.cli stream   --votes DIR --titles T --out DIR [--once]

``load`` writes the movies and people tables, the co-worker and co-actor sets
(parquet, one row per place in a set) and the ten most-credited actors; with ``--tables`` it also writes
its cells into the stored wide tables there, over those of earlier loads, and keeps rejected lines; ``batch`` prints the top ten and folds new vote logs
into the rating store; ``stream`` runs the vote log, sliding top 3 and
trending streams over text vote files.  Checkpoints go below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from marquee import schemas
from marquee.functions.predicates import is_performer
from marquee.operators.collaborators import collaborator_sets
from marquee.operators.credits import top_people
from marquee.plans.movies import build_movies, update_rating_store
from marquee.plans.people import build_people
from marquee.plans.tables import load_movie_cells, load_people_cells, movies_table, people_table
from marquee.plans.votes import start_vote_products
from marquee.sources.tsv import read_credits, read_name_lookup, read_people, read_ratings, read_titles, split_dump
from marquee.streaming.sources import text_vote_stream


def load(spark: SparkSession, a) -> None:
    titles, ratings = read_titles(spark, a.titles), read_ratings(spark, a.ratings)
    people, credits = read_people(spark, a.people), read_credits(spark, a.credits)
    build_movies(titles, ratings).write.mode("errorifexists").parquet(f"{a.out}/movies")
    build_people(people, credits, ratings).write.mode("errorifexists").parquet(f"{a.out}/people")
    collaborator_sets(credits).write.mode("errorifexists").parquet(f"{a.out}/collaborators")
    collaborator_sets(credits, where=is_performer("category")).write.mode("errorifexists").parquet(f"{a.out}/co_actors")
    top_people(credits, where=is_performer("category")).write.mode("errorifexists").parquet(f"{a.out}/top10")
    if getattr(a, "tables", None):
        rows, rejects = split_dump(spark, a.ratings, schemas.RATINGS, f"{a.out}/ratings_checked", schemas.HEADER_KEYS["ratings"])
        rejects.write.mode("errorifexists").parquet(f"{a.out}/ratings_rejects")
        movies, persons = movies_table(spark, f"{a.tables}/movies"), people_table(spark, f"{a.tables}/people")
        load_movie_cells(movies, titles, rows)
        load_people_cells(persons, people, credits, rows)
        movies.compact()
        persons.compact()


def batch(spark: SparkSession, a) -> None:
    for row in top_people(read_credits(spark, a.credits), where=is_performer("category")).collect():
        print(f"{row['nconst']}\t{row['credits']}")
    initial = read_ratings(spark, a.initial_ratings) if a.initial_ratings else None
    version = update_rating_store(spark, a.ratings_store, a.logs, initial=initial, rounded=a.rounded,
                                  log_format=getattr(a, "log_format", "text"))
    print(f"ratings store version {version}")


def stream(spark: SparkSession, a) -> None:
    trigger = {"availableNow": True} if a.once else {"processingTime": "10 seconds"}
    ckpt = a.checkpoint or f"{a.out.rstrip('/')}/_checkpoints"  # belongs to this output, so a restart goes on
    # the names are kept as a table: the micro-batches don't parse the dump again
    read_name_lookup(read_titles(spark, a.titles)).write.mode("overwrite").parquet(f"{ckpt}/names")
    names = spark.read.parquet(f"{ckpt}/names")
    queries = start_vote_products(text_vote_stream(spark, a.votes), names, a.out, ckpt, trigger=trigger)
    try:
        while any(q.isActive for q in queries.values()):
            spark.streams.awaitAnyTermination()  # raises when any of them failed
            spark.streams.resetTerminated()
        for q in queries.values():
            q.awaitTermination()
    finally:
        for q in queries.values():
            if q.isActive:
                q.stop()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="marquee")
    sub = p.add_subparsers(dest="cmd", required=True)
    lp = sub.add_parser("load")
    for name in ("titles", "ratings", "people", "credits", "out"):
        lp.add_argument(f"--{name}", required=True)
    lp.add_argument("--tables")
    bp = sub.add_parser("batch")
    bp.add_argument("--credits", required=True)
    bp.add_argument("--ratings-store", required=True)
    bp.add_argument("--logs", required=True)
    bp.add_argument("--initial-ratings")
    bp.add_argument("--rounded", action="store_true")
    bp.add_argument("--log-format", choices=["text", "window"], default="text")
    sp = sub.add_parser("stream")
    for name in ("votes", "titles", "out"):
        sp.add_argument(f"--{name}", required=True)
    sp.add_argument("--checkpoint")
    sp.add_argument("--once", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"marquee-{a.cmd}").getOrCreate()
    started = time.time()
    {"load": load, "batch": batch, "stream": stream}[a.cmd](spark, a)
    print(f"elapsed {time.time() - started:.1f}s")


if __name__ == "__main__":
    main()
