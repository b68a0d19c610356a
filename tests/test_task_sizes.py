"""Pairs and rounded folds in many small tasks: their number follows the rows, and the rows stay the same."""

from pyspark.sql import functions as F

from marquee import operators as ops
from marquee.operators import collaborators, ratings

CREDITS = [(t, (t * k * 7) % 23) for t in range(40) for k in range(6)] + [(99, 5), (100, 77), (None, 3), (4, None)]


def _tables(spark):
    counts = ops.collaborator_counts(spark.createDataFrame(CREDITS, "tconst long, nconst long"))
    sets = ops.set_text(ops.collaborator_sets(spark.createDataFrame(CREDITS, "tconst long, nconst long")), "nconst", "other")
    return {r[0]: r[1] for r in counts.collect()}, {r[0]: r[1] for r in sets.collect()}


def test_pairs_of_small_tasks(spark, monkeypatch):
    want = {}
    for t, n in CREDITS:
        if t is not None and n is not None:
            want.setdefault(n, set()).update(o for u, o in CREDITS if u == t and o is not None and o != n)
    monkeypatch.setattr(collaborators, "TASK_ROWS", 20)
    counts, sets = _tables(spark)
    assert counts == {n: len(s) for n, s in want.items()}
    assert sets == {n: "[" + ", ".join(map(str, sorted(s))) + "]" for n, s in want.items()}


def test_sets_evaluate_the_pairs_once(spark):
    """No count of the pairs before they are placed: the bound comes from the titles' sizes."""
    credits = spark.createDataFrame(CREDITS, "tconst long, nconst long")
    plan = ops.collaborator_sets(credits)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1  # pairs and lone people, with no second pass for the sizes


def test_fold_of_small_tasks(spark, monkeypatch):
    votes = [(t, float((k * 13 + t) % 10), k) for t in range(5) for k in range(30 if t else 400)]
    v = spark.createDataFrame(votes, "tconst long, rating double, seq long")
    none = spark.createDataFrame([], "tconst long, averageRating double, numVotes long")
    monkeypatch.setattr(ratings, "TASK_ROWS", 50)
    got = {r[0]: (round(r[1], 6), r[2]) for r in ops.update_ratings(none, v, order=["seq"], rounded=True).collect()}
    for t in range(5):
        mean, n = 0.0, 0
        for _, x, _ in (r for r in votes if r[0] == t):
            mean, n = round((n * mean + x) / (n + 1) * 10.0) / 10.0, n + 1
        assert got[t] == (round(mean, 6), n)
    assert v.where(F.col("tconst") == 0).count() > ratings.TASK_ROWS
