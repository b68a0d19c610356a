import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from marquee import operators as ops
from marquee.functions.predicates import is_performer
from marquee.plans.people import build_people


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_credit_counts(fx):
    out = ops.credit_counts(fx["credits"])
    assert rows(out, "nconst", "total_movies", "distinct_titles") == [
        ("nm1", 4, 3), ("nm2", 2, 2), ("nm3", 1, 1), ("nm4", 1, 1), ("nm5", 1, 1)]


def test_top_people_acting_only(fx):
    out = ops.top_people(fx["credits"], where=is_performer("category"), n=10)
    assert [tuple(r) for r in out.collect()] == [("nm1", 3), ("nm2", 2), ("nm4", 1), ("nm5", 1)]


def test_top_people_limit_ties_by_id(fx):
    out = ops.top_people(fx["credits"], where=is_performer("category"), n=3)
    assert [r["nconst"] for r in out.collect()] == ["nm1", "nm2", "nm4"]


def test_top_titles(fx):
    out = ops.top_titles(fx["credits"], fx["ratings"], n=3)
    assert rows(out, "nconst", "rank", "tconst", "averageRating") == [
        ("nm1", 1, "tt2", 9.0), ("nm1", 2, "tt1", 8.0), ("nm1", 3, "tt3", 7.0),
        ("nm2", 1, "tt1", 8.0), ("nm3", 1, "tt1", 8.0), ("nm4", 1, "tt2", 9.0)]


def test_top_titles_text(fx):
    top = ops.top_titles(fx["credits"], fx["ratings"], n=3)
    text = {r["nconst"]: r["top_text"] for r in ops.top_titles_text(top).collect()}
    assert text["nm1"] == "{tt2=9.0, tt1=8.0, tt3=7.0}"
    assert text["nm4"] == "{tt2=9.0}"
    assert "nm5" not in text


def test_top_titles_at_most_n_per_person(fx):
    out = ops.top_titles(fx["credits"], fx["ratings"], n=2)
    counts = out.groupBy("nconst").count().agg(F.max("count")).first()[0]
    assert counts == 2


def _sets(df):
    """Sets from rows; places are 1, 2, … in order, and every row tells the size."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["pos"] or 0):
        own = out.setdefault(r["nconst"], [])
        if r["pos"] is not None:
            own.append(r["other"])
            assert r["pos"] == len(own)
    sizes = {(r["nconst"], r["n_items"]) for r in df.collect()}
    assert sizes == {(k, len(v)) for k, v in out.items()} and all(v == sorted(set(v)) for v in out.values())
    return out


def test_collaborator_sets(fx):
    sets = _sets(ops.collaborator_sets(fx["credits"]))
    assert sets == {"nm1": ["nm2", "nm3", "nm4"], "nm2": ["nm1", "nm3"], "nm3": ["nm1", "nm2"],
                    "nm4": ["nm1"], "nm5": []}


def test_co_actor_sets(fx):
    sets = _sets(ops.collaborator_sets(fx["credits"], where=is_performer("category")))
    assert sets == {"nm1": ["nm2", "nm4"], "nm2": ["nm1"], "nm4": ["nm1"], "nm5": []}


def test_collaborator_counts(fx):
    out = ops.collaborator_counts(fx["credits"])
    assert rows(out, "nconst", "collaborators") == [("nm1", 3), ("nm2", 2), ("nm3", 2), ("nm4", 1), ("nm5", 0)]


def test_pairs_symmetric_irreflexive(fx):
    pairs = ops.collaborator_pairs(fx["credits"])
    got = {(r["nconst"], r["other"]) for r in pairs.collect()}
    assert all(a != b for a, b in got)
    assert got == {(b, a) for a, b in got}


def test_list_text_keeps_repeats(fx):
    out = ops.list_text(ops.positions(fx["credits"], "nconst", "tconst"), "nconst", "tconst")
    assert {r["nconst"]: r["list_text"] for r in out.collect()}["nm1"] == "tt1,tt2,tt3,tt3"


def test_texts_of_people_without_co_workers(fx):
    sets = ops.collaborator_sets(fx["credits"])
    assert {r["nconst"]: r["set_text"] for r in ops.set_text(sets, "nconst", "other").collect()} == {
        "nm1": "[nm2, nm3, nm4]", "nm2": "[nm1, nm3]", "nm3": "[nm1, nm2]", "nm4": "[nm1]", "nm5": "[]"}


def test_build_people_profile(fx):
    out = {r["nconst"]: r for r in build_people(fx["people"], fx["credits"], fx["ratings"]).collect()}
    assert sorted(out) == ["nm1", "nm2", "nm3", "nm4", "nm5", "nm6"]
    assert out["nm5"]["primaryName"] is None and out["nm5"]["total_movies"] == 1
    assert out["nm5"]["top_text"] is None and out["nm5"]["collaborators"] == 0
    nm6 = out["nm6"]
    assert nm6["primaryName"] == "Fay"
    assert nm6["total_movies"] is None and nm6["top_text"] is None and nm6["collaborators"] is None
    assert out["nm1"]["top_text"] == "{tt2=9.0, tt1=8.0, tt3=7.0}" and out["nm1"]["collaborators"] == 3


def test_merge_by_key_last_write_wins(spark):
    a = spark.createDataFrame([(1, "x", 10), (2, "y", None)], "k int, s string, n int")
    b = spark.createDataFrame([(1, None, 11), (3, "z", 30)], "k int, s string, n int")
    out = ops.merge_by_key("k", a, b)
    assertDataFrameEqual(out, spark.createDataFrame(
        [(1, "x", 11), (2, "y", None), (3, "z", 30)], "k int, s string, n int"))


def _brute_counts(data):
    members = {}
    for t, p in data:
        members.setdefault(t, set()).add(p)
    out = {}
    for ms in members.values():
        for p in ms:
            out.setdefault(p, set()).update(ms - {p})
    return {p: len(s) for p, s in out.items()}


import random as _random


@pytest.mark.parametrize("seed,heavy", [(1, 2), (2, 3), (3, 5), (4, 1000)])
def test_collaborator_counts_heavy_titles_exact(spark, seed, heavy):
    rnd = _random.Random(seed)
    data = []
    for t in range(40):
        size = rnd.choice([1, 2, 3, 4, 8, 30])
        data += [(t, rnd.randrange(60)) for _ in range(size)]
    data += [(999, p) for p in range(0, 60, 2)]  # one hot title
    df = spark.createDataFrame(data, "tconst long, nconst long")
    got = {r["nconst"]: r["collaborators"] for r in ops.collaborator_counts(df, heavy_size=heavy).collect()}
    assert got == _brute_counts(data)


@pytest.mark.parametrize("heavy", [2, 3, 1000])
def test_collaborator_pairs_split_heavy_titles_exact(spark, heavy):
    rnd = _random.Random(11)
    data = [(t, rnd.randrange(40)) for t in range(30) for _ in range(rnd.choice([1, 2, 5, 12]))]
    data += [(999, p) for p in range(0, 40, 3)]
    df = spark.createDataFrame(data, "tconst long, nconst long")
    got = {(r["nconst"], r["other"]) for r in ops.collaborator_pairs(df, heavy_size=heavy).collect()}
    members = {}
    for t, p in data:
        members.setdefault(t, set()).add(p)
    expect = {(a, b) for ms in members.values() for a in ms for b in ms if a != b}
    assert got == expect
