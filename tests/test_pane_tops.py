"""The sliding top keeps a row per title and pane, and its tasks follow the rows."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from marquee import operators as ops
from marquee.streaming import queries, read_sliding_top, start_sliding_top

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)
VOTES = "tconst long, rating double, ts timestamp"


def _files(spark, folder, *batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, VOTES).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(VOTES).option("maxFilesPerTrigger", "1").parquet(str(folder))


def _rows(df):
    return sorted((r["window_start"], r["rank"], r["tconst"], r["name"], round(r["average"], 6)) for r in df.collect())


@pytest.fixture(scope="module")
def votes():
    return [(k * 7 % 5 if k % 50 else None, float(k % 11), T0 + timedelta(seconds=k * 37)) for k in range(400)]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(k, f"n{k}") for k in range(4)], "tconst long, name string")


@pytest.mark.parametrize("open_windows", [False, True])
def test_tops_of_many_small_tasks(spark, tmp_path, monkeypatch, votes, names, open_windows):
    monkeypatch.setattr(queries, "TASK_ROWS", 30)
    src = _files(spark, tmp_path / "src", votes[:200], votes[200:])
    start_sliding_top(src, names, str(tmp_path / "out"), str(tmp_path / "ck"), open_windows=open_windows, compact_every=2).awaitTermination()
    batch = ops.sliding_top(spark.createDataFrame(votes, VOTES), names)
    if open_windows:
        assert _rows(read_sliding_top(spark, str(tmp_path / "out"))) == _rows(batch)
        return
    passed = F.lit(max(v[2] for v in votes if v[0] is not None) - timedelta(minutes=10))
    assert _rows(spark.read.parquet(str(tmp_path / "out"))) == _rows(batch.where(F.col("window_end") <= passed))


def test_a_vote_is_stored_once(spark, tmp_path, votes, names):
    src = _files(spark, tmp_path / "src", votes)
    start_sliding_top(src, names, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    field = spark.createDataFrame([], VOTES).schema["tconst"]
    stored = queries._pane_store(spark, str(tmp_path / "ck" / "marquee" / "panes"), field).rows()
    good = sum(v[0] is not None for v in votes)
    assert stored.agg(F.sum("count")).first()[0] == good and 0 < stored.count() <= good


def test_votes_for_reported_windows_change_nothing(spark, tmp_path, names):
    """A batch that comes an hour late reaches only windows that are not reported yet; panes of past days are forgotten."""
    first = [(1, 5.0, T0 + timedelta(days=d, minutes=m)) for d in (0, 4) for m in range(30)]
    src = _files(spark, tmp_path / "src", first)
    run = lambda: start_sliding_top(src, names, str(tmp_path / "out"), str(tmp_path / "ck"), compact_every=1).awaitTermination()
    run()
    before = _rows(spark.read.parquet(str(tmp_path / "out")))
    _files(spark, tmp_path / "src", [(2, 9.0, T0 + timedelta(days=3, hours=23)), (2, 9.0, T0 + timedelta(days=4, minutes=21)),
                                     (1, 5.0, T0 + timedelta(days=4, hours=2))])
    run()
    after = _rows(spark.read.parquet(str(tmp_path / "out")))
    assert set(before) < set(after) and len(after) == len(set(after))
    got = {r[0].astimezone(timezone.utc) for r in after if r[2] == 2}
    at = T0 + timedelta(days=4, minutes=21)
    assert got == {at - timedelta(minutes=k) for k in range(10)}
    field = spark.createDataFrame([], VOTES).schema["tconst"]
    stored = queries._pane_store(spark, str(tmp_path / "ck" / "marquee" / "panes"), field).rows()
    assert stored.agg(F.min("pane")).first()[0].astimezone(timezone.utc) >= T0 + timedelta(days=2)
