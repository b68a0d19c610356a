import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marquee import operators as ops

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def votes_df(spark, rows):
    return spark.createDataFrame(rows, "tconst string, rating double, ts timestamp")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(f"tt{i}", f"Title {i}") for i in range(1, 10)], "tconst string, name string")


@pytest.fixture(scope="module")
def trending_votes(spark):
    counts = {"tt1": [2, 3, 3, 4, 1], "tt2": [5, 0, 4, 1, 0]}
    rows = []
    for t, cs in counts.items():
        for w, c in enumerate(cs):
            for j in range(c):
                rows.append((t, 5.0, T0 + dt.timedelta(minutes=15 * w, seconds=10 * j + 1)))
    return votes_df(spark, rows)


def _trend(df):
    return sorted((r["tconst"], int((r["window_start"] - T0).total_seconds() // 900), r["votes"])
                  for r in df.collect())


def test_trending_reset(trending_votes, names):
    out = ops.trending(trending_votes, names, length="15 minutes", mode="reset")
    assert _trend(out) == [("tt1", 0, 2), ("tt1", 1, 3), ("tt1", 3, 4), ("tt2", 0, 5), ("tt2", 3, 1)]


def test_trending_growth(trending_votes, names):
    out = ops.trending(trending_votes, names, length="15 minutes", mode="growth")
    assert _trend(out) == [("tt1", 0, 2), ("tt1", 1, 3), ("tt1", 3, 4), ("tt2", 0, 5), ("tt2", 2, 4)]


def _sequential(counts):
    out, state = [], None
    for w, v in counts:
        s = v if state is None or v > state else 0
        state = s
        if s:
            out.append((w, s))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trending_closed_form_matches_recurrence(spark, seed):
    rnd = random.Random(seed)
    data, expect = [], []
    for t in range(5):
        windows = sorted(rnd.sample(range(60), 30))
        counts = [(w, rnd.choice([1, 1, 2, 3, 4])) for w in windows]
        data += [(f"t{t}", w, c) for w, c in counts]
        expect += [(f"t{t}", w, s) for w, s in _sequential(counts)]
    df = spark.createDataFrame(data, "tconst string, w int, votes long").withColumn(
        "window_start", F.col("w").cast("timestamp"))
    got = ops.trending_flags(df, "tconst", "reset").where("live").collect()
    assert sorted((r["tconst"], r["w"], r["votes"]) for r in got) == sorted(expect)


def test_sliding_top3(spark, names):
    rows = [("tt1", 8.0, T0 + dt.timedelta(seconds=30)), ("tt2", 9.0, T0 + dt.timedelta(seconds=70)),
            ("tt3", 7.0, T0 + dt.timedelta(seconds=80)), ("tt4", 7.0, T0 + dt.timedelta(seconds=90)),
            ("tt1", 4.0, T0 + dt.timedelta(seconds=125))]
    out = ops.sliding_top(votes_df(spark, rows), names, length="10 minutes", slide="1 minute", n=3)
    by_window = {}
    for r in out.collect():
        by_window.setdefault(r["window_start"], []).append((r["rank"], r["tconst"], r["average"]))
    assert sorted(by_window[T0 + dt.timedelta(minutes=1)]) == [(1, "tt2", 9.0), (2, "tt3", 7.0), (3, "tt4", 7.0)]
    assert sorted(by_window[T0]) == [(1, "tt2", 9.0), (2, "tt3", 7.0), (3, "tt4", 7.0)]
    assert sorted(by_window[T0 - dt.timedelta(minutes=9)]) == [(1, "tt1", 8.0)]
    assert all(len(v) <= 3 for v in by_window.values())


def test_unknown_titles_not_ranked(spark, names):
    rows = [("tt99", 10.0, T0), ("tt1", 1.0, T0)]
    out = ops.sliding_top(votes_df(spark, rows), names, length="10 minutes", slide="10 minutes", n=3)
    assert [r["tconst"] for r in out.collect()] == ["tt1"]


def test_vote_log_labels(spark):
    rows = [("tt1", 1.0, dt.datetime(2024, 1, 1, 23, 55)), ("tt2", 2.0, dt.datetime(2024, 1, 2, 0, 5))]
    got = sorted((r["tconst"], r["w"]) for r in ops.vote_log(votes_df(spark, rows)).collect())
    assert got == [("tt1", "2024-01-02_00_00"), ("tt2", "2024-01-02_00_10")]


def test_window_start_time_offset(spark):
    rows = [("tt1", 1.0, dt.datetime(2024, 1, 1, 0, 4)), ("tt1", 3.0, dt.datetime(2024, 1, 1, 0, 6))]
    aligned = ops.window_counts(votes_df(spark, rows), length="10 minutes").collect()
    shifted = ops.window_counts(votes_df(spark, rows), length="10 minutes", start_time="5 minutes").collect()
    assert [r["votes"] for r in aligned] == [2]
    assert sorted(r["votes"] for r in shifted) == [1, 1]


def test_pane_averages_equal_direct(spark):
    from marquee.plans import roles

    v = roles.votes(spark, "/root/testdata/sf0.001")
    direct = ops.window_averages(v, length="10 minutes", slide="1 minute")
    panes = ops.window_averages(v, length="10 minutes", slide="1 minute", panes=True)
    key = ["window_start", "window_end", "tconst", "votes"]
    a = {tuple(r[c] for c in key): r["average"] for r in direct.collect()}
    b = {tuple(r[c] for c in key): r["average"] for r in panes.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("length,slide", [("10 minutes", "3 minutes"), ("2500 milliseconds", "500 milliseconds")])
def test_averages_where_panes_do_not_fit(spark, length, slide):
    rows = [(f"tt{i % 3}", float(i % 7), T0 + dt.timedelta(seconds=37 * i)) for i in range(60)]
    cols = ["window_start", "window_end", "tconst", "average", "votes"]
    panes, direct = (sorted(tuple(r) for r in ops.window_averages(
        votes_df(spark, rows), length=length, slide=slide, panes=p).select(*cols).collect()) for p in (True, False))
    assert panes == direct and panes
