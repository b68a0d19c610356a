"""Regressions: rounded fold per title, log chain, merges, sinks."""

import random

import pytest

from marquee.operators.merge import merge_by_key
from marquee.operators.ratings import update_ratings
from marquee.plans.movies import update_rating_store
from marquee.sinks import files

RATINGS = "tconst string, averageRating double, numVotes long"


def fold(a, n, votes):
    for v in votes:
        a = round((n * a + v) / (n + 1) * 10) / 10
        n += 1
    return a, n


def test_rounded_fold_cuts_each_title_at_its_own_limit(spark):
    base = spark.createDataFrame([("A", 5.0, 1), ("B", 5.0, 1)], RATINGS)
    b = sorted(float((i * 7) % 11) for i in range(50))
    votes = spark.createDataFrame([("A", 5.0)] * 100 + [("B", x) for x in b], "tconst string, rating double")
    got = {r[0]: (r[1], r[2]) for r in update_ratings(base, votes, rounded=True).collect()}
    assert got["B"] == pytest.approx(fold(5.0, 1, b)) and got["A"] == (5.0, 101)


def test_rounded_fold_with_narrow_hot_and_wide_cold_titles(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for t in range(12):
        wide, hot = t % 2, t % 3 == 0
        votes = [round(rng.uniform(0, 10 if wide else 0.3), 2) for _ in range(900 if hot else rng.randint(1, 40))]
        rows += [(f"t{t}", v, i) for i, v in enumerate(votes)]
        want[f"t{t}"] = fold(0.0, 0, votes)
    v = spark.createDataFrame(rows, "tconst string, rating double, i int")
    got = {r[0]: (r[1], r[2]) for r in update_ratings(
        spark.createDataFrame([], RATINGS), v, order=["i"], rounded=True).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_rounded_fold_of_a_title_with_a_million_votes_that_count(spark):
    """Votes over a range of 50,000: more than 10^6 of them could move the average; no array of them is built."""
    from pyspark.sql import functions as F

    n = 1_000_000
    values = [(i * 7919) % 50_021 / 1.0 for i in range(n)]
    votes = spark.range(n).select(F.lit("hot").alias("tconst"), (F.col("id") * 7919 % 50_021).cast("double").alias("rating"), F.col("id").alias("i"))
    votes = votes.unionByName(spark.createDataFrame([("cold", 3.0, 1), ("cold", 4.0, 2)], votes.schema))
    out = update_ratings(spark.createDataFrame([("hot", 5.0, 3), ("still", 7.0, 1)], RATINGS), votes, order=["i"], rounded=True)
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got["hot"] == pytest.approx(fold(5.0, 3, values)) and got["cold"] == fold(0.0, 0, [3.0, 4.0]) and got["still"] == (7.0, 1)


def test_infinite_and_nan_votes_are_ignored(spark):
    base = spark.createDataFrame([("A", 5.0, 1)], RATINGS)
    votes = spark.createDataFrame([("A", float("inf")), ("A", float("nan")), ("A", 7.0)], "tconst string, rating double")
    for rounded in (False, True):
        assert [tuple(r) for r in update_ratings(base, votes, rounded=rounded).collect()] == [("A", 6.0, 2)]


def test_window_log_is_folded_and_a_foreign_folder_is_an_error(spark, tmp_path):
    log = spark.createDataFrame([("tt1", 10.0, "2024-01-01 00:00:00", "2024-01-01_00_10"),
                                 (None, 3.0, "2024-01-01 00:00:01", "2024-01-01_00_10")],
                                "tconst string, rating double, ts string, w string").selectExpr(
        "tconst", "rating", "CAST(ts AS timestamp) AS ts", "w")
    files.write_window_log(log, str(tmp_path / "log"))
    base = spark.createDataFrame([("tt1", 8.0, 1)], RATINGS)
    store = str(tmp_path / "store")
    with pytest.raises(ValueError, match="no valid vote"):
        update_rating_store(spark, store, str(tmp_path / "log"), initial=base)
    update_rating_store(spark, store, str(tmp_path / "log"), initial=base, log_format="window")
    update_rating_store(spark, store, str(tmp_path / "log"), log_format="window")  # applied once
    assert [tuple(r) for r in files.read_current(spark, store, "ratings").collect()] == [("tt1", 9.0, 2)]


def test_initial_is_refused_when_versions_lost_their_pointer(spark, tmp_path):
    base = spark.createDataFrame([("tt1", 8.0, 1)], RATINGS)
    votes = spark.createDataFrame([("tt1", 8.0, True, "f1", 1)], "tconst string, rating double, valid boolean, source_file string, line_id long")
    update_rating_store(spark, str(tmp_path), votes, initial=base)
    (tmp_path / files.POINTER).unlink()
    with pytest.raises(ValueError, match="refused"):
        update_rating_store(spark, str(tmp_path), votes, initial=base)


def test_empty_list_round_trip(spark, tmp_path):
    lists = spark.createDataFrame([("nm1", ["a", "b"]), ("nm5", [])], "nconst string, items array<string>")
    files.write_key_lists(lists, str(tmp_path / "lists"), "nconst")
    assert '"' not in "".join(p.read_text() for p in (tmp_path / "lists").glob("part-*"))


def test_merge_takes_the_wider_type_and_is_defined_for_repeated_keys(spark):
    a = spark.createDataFrame([(1, 1)], "k int, v int")
    b = spark.createDataFrame([(1, 2.7)], "k int, v double")
    assert [tuple(r) for r in merge_by_key("k", a, b).collect()] == [(1, 2.7)]
    twice = spark.createDataFrame([(1, 5), (1, 9), (1, None)], "k int, v int")
    assert [tuple(r) for r in merge_by_key("k", a, twice).collect()] == [(1, 9)]


def test_rows_of_one_frame_are_written_in_their_order(spark):
    a = spark.createDataFrame([(1, 9, "old", 1), (1, 5, None, 3), (1, None, "new", 2), (2, 1, "x", None), (2, 0, "w", 0)], "k int, v int, s string, at int")
    b = spark.createDataFrame([(2, 7)], "k int, v int")
    assert sorted(map(tuple, merge_by_key("k", a, b, written_at="at").collect())) == [(1, 5, "new"), (2, 7, "w")]


def test_co_worker_counts_over_many_signatures_of_hot_titles(spark):
    """A title that everyone is on, each person with another set of further hot titles; buckets of four."""
    from marquee.operators.collaborators import collaborator_counts

    rng = random.Random(5)
    credits = [("all", p) for p in range(60) if p % 3] + [(f"t{t}", p) for p in range(60) for t in range(9) if rng.random() < 0.2]
    on = {}
    for t, p in credits:
        on.setdefault(t, set()).add(p)
    want = {p: len(set().union(*[s for s in on.values() if p in s]) - {p}) for _, p in credits}
    df = spark.createDataFrame(credits, "tconst string, nconst long")
    for size in (4, 1000):
        assert dict(map(tuple, collaborator_counts(df, heavy_size=size).collect())) == want


def test_no_signature_meets_a_signature_in_the_plan(spark):
    """Unions of member bitmaps: joins are by title, person, chunk or signature, and no join compares arrays."""
    from marquee.operators.collaborators import _reach
    from marquee.operators.positions import range_numbered

    sig = spark.createDataFrame([(p, sorted({f"t{p % 3}", f"t{p % 7}"})) for p in range(200)], "nconst long, _sig array<string>")
    reach = _reach(range_numbered(sig, "_sig", "nconst"))
    plan = reach._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "arrays_overlap" not in plan and plan.count("Join") <= 3
    people = {p: {f"t{p % 3}", f"t{p % 7}"} for p in range(200)}
    for r in reach.collect():
        assert r["_reach"] == sum(bool(s & set(r["_sig"])) for s in people.values())


def test_a_sink_belongs_to_its_checkpoint(spark, tmp_path):
    files.claim_sink(spark, str(tmp_path / "out"), "ck1")
    files.claim_sink(spark, str(tmp_path / "out"), "ck1")
    with pytest.raises(ValueError, match="ck1"):
        files.claim_sink(spark, str(tmp_path / "out"), "ck2")
