"""Properties over the sf0.001 driver tables."""

import pytest
from pyspark.sql import functions as F

from marquee import operators as ops
from marquee.plans import roles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def credits(spark):
    return roles.credits(spark, SF).cache()


def test_credit_totals_equal_rows(credits):
    total = ops.credit_counts(credits).agg(F.sum("total_movies")).first()[0]
    assert total == credits.where(F.col("nconst").isNotNull()).count()


def test_top_n_at_most_n_per_person(spark, credits):
    top = ops.top_titles(credits, roles.ratings(spark, SF), n=3)
    per = top.groupBy("nconst").agg(F.count("*").alias("c"), F.max("rank").alias("r"))
    assert per.where((F.col("c") > 3) | (F.col("r") > 3) | (F.col("c") != F.col("r"))).count() == 0


def test_pairs_symmetric_and_irreflexive(credits):
    pairs = ops.collaborator_pairs(credits)
    assert pairs.where(F.col("nconst") == F.col("other")).count() == 0
    flipped = pairs.select(F.col("other").alias("nconst"), F.col("nconst").alias("other"))
    assert pairs.exceptAll(flipped).count() == 0


def test_counts_equal_set_sizes(credits):
    counts = ops.collaborator_counts(credits, heavy_size=3)  # forces the heavy-title path
    sizes = ops.collaborator_sets(credits).groupBy("nconst").agg(F.max("n_items").alias("n"), F.count("other").alias("rows"))
    assert sizes.where("n <> rows").count() == 0
    diff = counts.join(sizes, "nconst", "full").where(
        F.col("collaborators").isNull() | F.col("n").isNull() | (F.col("collaborators") != F.col("n")))
    assert diff.count() == 0
