"""Reach of signatures: people are weights of distinct signatures, so more people of the same signatures are no more unions."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import collaborators as co


def _people(n, seed=7):
    rnd = random.Random(seed)
    return [(k, tuple(sorted(rnd.sample("abcdefgh", rnd.randint(1, 4))))) for k in range(n)]


@pytest.mark.parametrize("bits", [14, 3])
def test_reach_counts_people_once(spark, monkeypatch, bits):
    monkeypatch.setattr(co, "BLOCK_BITS", bits)
    people = _people(3000)
    sig = spark.createDataFrame([(k, list(s)) for k, s in people], "nconst long, _sig array<string>")
    got = {tuple(r["_sig"]): r["_reach"] for r in co._reach(sig).collect()}
    want = {s for _, s in people} | {(t,) for t in "abcdefgh"}
    assert set(got) == want
    assert all(got[s] == sum(bool(set(s) & set(o)) for _, o in people) for s in want)


def test_unions_follow_the_distinct_signatures(spark, monkeypatch):
    """Ten times the people with the same signatures ask for the same unions."""
    asked, unions = [], co._unions

    def counted(wanted, bitmaps, *more):
        asked.append((wanted.count(), bitmaps.count(), bitmaps.agg(F.sum(F.bitmap_count("_people"))).first()[0]))
        return unions(wanted, bitmaps, *more)

    monkeypatch.setattr(co, "_unions", counted)
    for copies in (1, 10):
        rows = [(t, k * 1000 + c) for k, s in _people(300) for c in range(copies) for t in s]
        credits = spark.createDataFrame(rows, "tconst string, nconst long")
        co.collaborator_counts(credits, heavy_size=3).count()
    assert asked[0] == asked[1]
