"""The products of the library run on the driver's test tables.

The test tables are not IMDb dumps, so each role is mapped onto one of
them (column names are renamed to the IMDb names, so every operator runs
with its defaults):

* credits  = ``lineitem``: title ``l_orderkey``, person ``l_partkey``,
  category ``l_returnflag``; "acting" credits are those whose category
  contains ``A`` or ``R`` (the dumps' test is contains actor/actress).
* ratings  = ``orders``: title ``o_orderkey``, rating ``o_totalprice``.
* people   = ``part``: person ``p_partkey``, name ``p_name``, profession ``p_type``.
* votes    = ``events``: title ``user_id``, rating ``value``, time ``ts``.
* title names, and the rating base of the vote fold = ``customer``: title
  ``c_custkey``, name ``c_name``, average ``c_acctbal``, votes so far
  ``c_nationkey + 1``.
* two-source key merge = ``documents`` ⟗ ``labels`` on ``doc_id``.

Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import operators as ops
from marquee.functions.numeric import round_tenth_even
from marquee.functions.predicates import contains_any
from marquee.plans.people import person_parts
from marquee.sources.votes import parse_vote_log_lines, parse_vote_stream_lines, vote_lines

# Category letters that mark an acting credit in the test tables.
ACTING_LETTERS = ("A", "R")
TS_TEXT = "yyyy-MM-dd HH:mm:ss"
BAD_LINE_EVENT = "error"
# Sizes from which keys and titles count as heavy in the queries that show the heavy paths.
HOT_KEY_ITEMS = 1_000
HOT_TITLE_PEOPLE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def credits(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tconst"), F.col("l_partkey").alias("nconst"),
        F.col("l_returnflag").alias("category"))


def is_acting(category: str = "category"):
    return contains_any(category, ACTING_LETTERS)


def ratings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tconst"), F.col("o_totalprice").alias("averageRating"))


def people(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("nconst"), F.col("p_name").alias("primaryName"),
        F.col("p_type").alias("primaryProfession"))


def votes(spark, sf_dir) -> DataFrame:
    # ``ts`` is TIMESTAMP_NTZ in the files.  Batch windows work on it directly
    # (aligned on wall-clock time, whatever the session time zone); only the
    # stream forms cast to TIMESTAMP, which watermarks require.
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("tconst"), F.col("value").alias("rating"), F.col("ts"))


def names(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("tconst"), F.col("c_name").alias("name"))


def rating_base(spark, sf_dir, rounded: bool = False) -> DataFrame:
    avg = F.col("c_acctbal")
    if rounded:
        avg = round_tenth_even(avg)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("tconst"), avg.alias("averageRating"),
        (F.col("c_nationkey") + F.lit(1)).cast("long").alias("numVotes"))


def _ts_text(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.date_format(c, TS_TEXT))
    return df


# ---------------------------------------------------------------- queries

def top10_people(spark, d):
    return ops.top_people(credits(spark, d), where=is_acting(), n=10)


def person_credit_count(spark, d):
    return ops.credit_counts(credits(spark, d))


def title_positions_by_person(spark, d):
    return ops.positions(credits(spark, d), "nconst", "tconst")


def hot_credits(spark, d) -> DataFrame:
    """Three titles that hold all people between them."""
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("tconst"), F.col("l_partkey").alias("nconst"))


def person_positions_hot(spark, d):
    """People of three titles that hold all credits: every key is ranked by ranges."""
    return ops.positions(hot_credits(spark, d), "tconst", "nconst", heavy_size=HOT_KEY_ITEMS)


def titles_by_person(spark, d):
    return ops.list_text(title_positions_by_person(spark, d), "nconst", "tconst")


def persons_by_title(spark, d):
    return ops.list_text(ops.positions(credits(spark, d), "tconst", "nconst"), "tconst", "nconst")


def top3_by_person(spark, d):
    return ops.top_titles(credits(spark, d), ratings(spark, d), n=3)


def top3_map_text(spark, d):
    top = ops.top_titles(credits(spark, d), ratings(spark, d), n=3)
    return ops.top_titles_text(top, value_format="decimal(18,2)").select("nconst", "top_text")


def collaborator_pairs(spark, d):
    return ops.collaborator_pairs(credits(spark, d))


def collaborator_count(spark, d):
    return ops.collaborator_counts(credits(spark, d))


def collaborator_count_hot(spark, d):
    """Three titles that hold all people between them: every title is a hot one."""
    return ops.collaborator_counts(hot_credits(spark, d))


def collaborator_count_signatures(spark, d):
    """Orders as people, the nations of their suppliers as titles: few hot titles, thousands of different signatures on each."""
    nations = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("tconst"))
    orders = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("nconst"), "l_suppkey")
    return ops.collaborator_counts(orders.join(nations, "l_suppkey").select("tconst", "nconst"), heavy_size=HOT_TITLE_PEOPLE)


def co_actor_count(spark, d):
    return ops.collaborator_counts(credits(spark, d), where=is_acting()).withColumnRenamed(
        "collaborators", "co_actors")


def collaborator_sets(spark, d):
    return ops.set_text(ops.collaborator_sets(credits(spark, d)), "nconst", "other")


def co_actor_sets(spark, d):
    return ops.set_text(ops.collaborator_sets(credits(spark, d), where=is_acting()), "nconst", "other")


def person_info(spark, d):
    return people(spark, d)


def person_profile(spark, d):
    counts, top, co = person_parts(credits(spark, d), ratings(spark, d), 3, is_acting())
    text = ops.top_titles_text(top, value_format="decimal(18,2)").select("nconst", "top_text")
    info = people(spark, d).select("nconst", "primaryName")
    return ops.merge_by_key("nconst", info, counts, text, co.withColumnRenamed("collaborators", "co_actors"))


def merge_documents_labels(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return ops.merge_by_key("doc_id", docs, labels)


def ratings_update_exact(spark, d):
    out = ops.update_ratings(rating_base(spark, d), votes(spark, d))
    return out.withColumn("averageRating", F.round("averageRating", 6))


def ratings_update_rounded(spark, d):
    out = ops.update_ratings(rating_base(spark, d, rounded=True), votes(spark, d),
                             order=["ts", "rating"], rounded=True)
    return out.withColumn("averageRating", F.round("averageRating", 6))


def ratings_update_rounded_mixed(spark, d):
    """Narrow and wide titles side by side, over all of lineitem, from an empty base."""
    value = F.when(F.col("l_partkey") % 2 == 0, F.col("l_discount")).otherwise(F.col("l_quantity"))
    v = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("tconst"), value.alias("rating"), "l_shipdate", "l_orderkey", "l_linenumber")
    none = spark.createDataFrame([], "tconst long, averageRating double, numVotes long")
    out = ops.update_ratings(none, v, order=["l_shipdate", "l_orderkey", "l_linenumber", "rating"], rounded=True)
    return out.withColumn("averageRating", F.round("averageRating", 6))


def vote_log(spark, d):
    log = ops.vote_log(votes(spark, d), length="10 minutes")
    return _ts_text(log.select("w", "window_start", "window_end", "tconst", "rating", "ts"),
                    "window_start", "window_end").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def sliding_avg(spark, d):
    avgs = ops.window_averages(votes(spark, d), length="10 minutes", slide="1 minute")
    return _ts_text(avgs.withColumn("average", F.round("average", 6)), "window_start", "window_end")


def sliding_top3(spark, d):
    top = ops.sliding_top(votes(spark, d), names(spark, d), length="10 minutes", slide="1 minute", n=3)
    return _ts_text(top.withColumn("average", F.round("average", 6)), "window_start", "window_end")


def _trending(spark, d, length, mode):
    out = ops.trending(votes(spark, d), names(spark, d), length=length, mode=mode)
    return _ts_text(out, "window_start", "window_end")


def trending_15m(spark, d):
    return _trending(spark, d, "15 minutes", "reset")


def trending_1d(spark, d):
    return _trending(spark, d, "1 day", "reset")


def trending_growth_1d(spark, d):
    return _trending(spark, d, "1 day", "growth")


def event_votes_with_errors(spark, d) -> DataFrame:
    """Every event as a vote; those of one type hold its name where the rating belongs, as bad lines do."""
    value = F.when(F.col("event_type") == BAD_LINE_EVENT, F.col("event_type")).otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select(F.col("user_id").alias("tconst"), value.alias("rating"))


def vote_lines_parsed(spark, d):
    return parse_vote_log_lines(vote_lines(event_votes_with_errors(spark, d)))


def vote_stream_lines_parsed(spark, d):
    # The live form: id and rating separated by a run of TABs (two here).
    ev = votes(spark, d)
    lines = ev.select(F.concat(F.col("tconst").cast("string"), F.lit("\t\t"),
                               F.col("rating").cast("string")).alias("value"))
    return parse_vote_stream_lines(lines)


BATCH = {
    "top10_people": top10_people,
    "person_credit_count": person_credit_count,
    "title_positions_by_person": title_positions_by_person,
    "person_positions_hot": person_positions_hot,
    "titles_by_person": titles_by_person,
    "persons_by_title": persons_by_title,
    "top3_by_person": top3_by_person,
    "top3_map_text": top3_map_text,
    "collaborator_pairs": collaborator_pairs,
    "collaborator_count": collaborator_count,
    "collaborator_count_hot": collaborator_count_hot,
    "collaborator_count_signatures": collaborator_count_signatures,
    "co_actor_count": co_actor_count,
    "collaborator_sets": collaborator_sets,
    "co_actor_sets": co_actor_sets,
    "person_info": person_info,
    "person_profile": person_profile,
    "merge_by_key": merge_documents_labels,
    "ratings_update_exact": ratings_update_exact,
    "ratings_update_rounded": ratings_update_rounded,
    "ratings_update_rounded_mixed": ratings_update_rounded_mixed,
    "vote_log": vote_log,
    "sliding_avg": sliding_avg,
    "sliding_top3": sliding_top3,
    "trending_15m": trending_15m,
    "trending_1d": trending_1d,
    "trending_growth_1d": trending_growth_1d,
    "vote_lines_parsed": vote_lines_parsed,
    "vote_stream_lines_parsed": vote_stream_lines_parsed,
}
