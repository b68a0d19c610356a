import random

import pytest
from pyspark.sql import functions as F

from marquee import operators as ops
from marquee.plans.movies import build_movies, update_rating_store
from marquee.sinks.files import read_current


def as_map(df, key="tconst", *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


def test_build_movies(fx):
    out = as_map(build_movies(fx["titles"], fx["ratings"]), "tconst", "primaryTitle", "rating")
    assert out == {"tt1": ("Alpha", 8.0), "tt2": ("Beta", 9.0), "tt3": ("Gamma", 7.0),
                   "tt4": ("Delta", None), "tt9": (None, 5.0)}


def test_update_exact(fx):
    out = as_map(ops.update_ratings(fx["ratings"], fx["log"]), "tconst", "averageRating", "numVotes")
    assert out["tt1"] == (8.0, 102)
    assert out["tt2"] == (9.0, 50)
    assert out["tt3"][0] == pytest.approx(79.0 / 11) and out["tt3"][1] == 11
    assert out["tt7"] == (4.0, 1)  # vote for an unrated title starts at n = 0
    assert out["tt9"] == (5.0, 3)


def test_update_rounded(fx):
    out = as_map(ops.update_ratings(fx["ratings"], fx["log"], order=["seq"], rounded=True),
                 "tconst", "averageRating", "numVotes")
    assert out == {"tt1": (8.0, 102), "tt2": (9.0, 50), "tt3": (7.2, 11), "tt7": (4.0, 1), "tt9": (5.0, 3)}


def _fold(avg, n, votes):
    for v in votes:
        x = (n * avg + v) / (n + 1)
        avg = float(round(x * 10)) / 10  # Python round: half to even on the binary value
        n += 1
    return avg, n


@pytest.mark.parametrize("seed,lo,hi,base_n", [(1, 1.0, 10.0, 1), (2, 0.0, 3.0, 0), (3, 4.0, 6.0, 30)])
def test_rounded_fold_matches_sequential(spark, seed, lo, hi, base_n):
    """Differential: many votes per title, so the bounded (frozen-tail) path is taken."""
    rnd = random.Random(seed)
    base = [(f"t{i}", round(rnd.uniform(lo, hi), 1), base_n + rnd.randrange(3)) for i in range(6)]
    votes = []
    for i in range(8):  # t6, t7: no base row
        k = rnd.choice([1, 5, 40, 400, 1500])
        votes += [(f"t{i}", round(rnd.uniform(lo, hi), rnd.choice([0, 1, 2])), j) for j in range(k)]
    rnd.shuffle(votes)
    bdf = spark.createDataFrame(base, "tconst string, averageRating double, numVotes long")
    vdf = spark.createDataFrame(votes, "tconst string, rating double, seq long")
    got = as_map(ops.update_ratings(bdf, vdf, order=["seq"], rounded=True), "tconst", "averageRating", "numVotes")
    expect = {}
    by_title = {}
    for t, v, s in votes:
        by_title.setdefault(t, []).append((s, v))
    start = {t: (a, n) for t, a, n in base}
    for t in set(start) | set(by_title):
        a, n = start.get(t, (0.0, 0))
        seq = [v for _, v in sorted(by_title.get(t, []))]
        expect[t] = _fold(a, n, seq) if seq else (a, n)
    assert got == expect


def test_rating_store_applies_each_log_once(spark, tmp_path):
    logs = tmp_path / "logs"
    (logs / "00_10").mkdir(parents=True)
    (logs / "00_10" / "part-00000").write_text("(tt1,10.0)\n(tt1,6.0)\n(bad)\n")
    initial = spark.createDataFrame([("tt1", 8.0, 100)], "tconst string, averageRating double, numVotes long")
    root = str(tmp_path / "store")
    update_rating_store(spark, root, str(logs), initial=initial)
    first = as_map(read_current(spark, root, "ratings"), "tconst", "averageRating", "numVotes")
    assert first == {"tt1": (8.0, 102)}
    update_rating_store(spark, root, str(logs))  # rerun: nothing new
    assert as_map(read_current(spark, root, "ratings"), "tconst", "averageRating", "numVotes") == first
    (logs / "00_20").mkdir()
    (logs / "00_20" / "part-00000").write_text("(tt2,7.0)\n")
    update_rating_store(spark, root, str(logs))
    out = as_map(read_current(spark, root, "ratings"), "tconst", "averageRating", "numVotes")
    assert out == {"tt1": (8.0, 102), "tt2": (7.0, 1)}
    assert read_current(spark, root, "ledger").count() == 2


def test_votes_sum_after_update(spark):
    base = spark.range(50).select(F.col("id").cast("string").alias("tconst"),
                                  F.lit(5.0).alias("averageRating"), (F.col("id") % 7).alias("numVotes"))
    votes = spark.range(500).select((F.col("id") % 60).cast("string").alias("tconst"),
                                    (F.col("id") % 10).cast("double").alias("rating"))
    out = ops.update_ratings(base, votes)
    before = base.agg(F.sum("numVotes")).first()[0]
    assert out.agg(F.sum("numVotes")).first()[0] == before + 500


def test_create_table_refuses_existing(spark, fx):
    import pyspark.errors

    from marquee.sinks import create_table

    movies = build_movies(fx["titles"], fx["ratings"])
    create_table(movies, "movies_w2_test", bucket_by="tconst", buckets=4)
    assert spark.table("movies_w2_test").count() == 5
    with pytest.raises(pyspark.errors.AnalysisException):
        create_table(movies, "movies_w2_test")


def test_rounded_fold_salted_prefix_matches_sequential(spark):
    """Wide value range → prefix longer than the group-limit threshold → salted path."""
    from marquee.operators.ratings import _rounded_fold

    rnd = random.Random(7)
    votes = [("hot", round(rnd.uniform(0, 100), 1), j) for j in range(5000)]
    votes += [("cold", round(rnd.uniform(0, 100), 1), j) for j in range(30)]
    base = spark.createDataFrame([("hot", 50.0, 2), ("cold", 10.0, 1)],
                                 "tconst string, averageRating double, numVotes long")
    vdf = spark.createDataFrame(votes, "tconst string, rating double, seq long")
    got = as_map(_rounded_fold(base, vdf, "tconst", "averageRating", "numVotes", "rating", ["seq"],
                               salt_buckets=8), "tconst", "averageRating", "numVotes")
    expect = {"hot": _fold(50.0, 2, [v for _, v, _ in votes[:5000]]),
              "cold": _fold(10.0, 1, [v for _, v, _ in votes[5000:]])}
    assert got == expect


def test_failed_version_write_keeps_previous(spark, tmp_path):
    from marquee.sinks.files import write_version

    root = str(tmp_path / "store")
    good = spark.createDataFrame([("tt1", 8.0, 1)], "tconst string, averageRating double, numVotes long")
    first = write_version(spark, root, {"ratings": good})
    bad = spark.createDataFrame([("x",)], "s string").selectExpr("cast(s as int) as broken")  # fails when run
    with pytest.raises(Exception):
        write_version(spark, root, {"ratings": bad})
    from marquee.sinks.files import current_version

    assert current_version(spark, root) == first
    assert [tuple(r) for r in read_current(spark, root, "ratings").collect()] == [("tt1", 8.0, 1)]
