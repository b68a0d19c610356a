"""Keyed stores, the wide tables, rating sums over a compacted log, dump rejects."""

import os
import random

import pytest
from pyspark.sql import functions as F

from marquee import schemas
from marquee.plans import rating_store, tables
from marquee.sinks.store import KeyedStore, all_rows, latest_cells, latest_row, sums
from marquee.sources import tsv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("merge", [latest_row, latest_cells, sums])
def test_reads_equal_a_plain_fold_through_compactions_and_repeats(spark, tmp_path, merge):
    store = KeyedStore(spark, str(tmp_path / "s"), "k string, a long, b long", ["k"], merge, buckets=4)
    assert rows(store.read()) == [] and store.compact() == 0 and store.last_batch() == -1
    rng, want = random.Random(1), {}
    for batch in range(9):
        new = {f"k{i}": (rng.choice([None, rng.randrange(9)]), rng.randrange(9)) for i in rng.sample(range(40), 12)}
        if batch == 5:
            store.append(spark.createDataFrame([("wrong", 1, 1)], store.schema), batch)  # the first try of the batch
        store.append(spark.createDataFrame([(k, *v) for k, v in new.items()], store.schema), batch)
        for k, v in new.items():
            old = want.get(k)
            if merge is latest_row or old is None:
                want[k] = v
            elif merge is latest_cells:
                want[k] = tuple(o if n is None else n for o, n in zip(old, v))
            else:
                want[k] = tuple(n if o is None else o if n is None else o + n for o, n in zip(old, v))
        if batch in (2, 3, 6):
            assert store.compact() <= 4
            store.append(spark.createDataFrame([("late", 1, 1)], store.schema), batch)  # merged already: stays as it is
        assert rows(store.read()) == sorted(((k, *v) for k, v in want.items()), key=str)
        assert store.last_batch() == batch
    assert rows(store.read(F.col("k") == "k3")) == [("k3", *want["k3"])]


def test_compaction_rewrites_touched_buckets_and_removes_what_it_replaced(spark, tmp_path):
    root = str(tmp_path / "s")
    store = KeyedStore(spark, root, "day string, n long", ["day"], sums, F.col("day"))
    days = [f"2024-01-{d:02}" for d in range(1, 11)]
    store.append(spark.createDataFrame([(d, 1) for d in days], store.schema), 0)
    assert store.compact() == 10
    before = store._state()[0]
    store.append(spark.createDataFrame([("2024-01-03", 5)], store.schema), 1)
    plan = store.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and rows(store.read())[2] == ("2024-01-03", 6)
    assert store.compact() == 1
    after = store._state()[0]
    assert {d for d in days if before[d] != after[d]} == {"2024-01-03"} and store.batches() == [1]
    for batch in range(2, 12):
        store.append(spark.createDataFrame([(days[batch % 3], 1)], store.schema), batch)
        store.compact()
    kept = sum(len(f) for _, _, f in os.walk(root) for f in [[x for x in f if x.endswith(".parquet")]])
    assert kept < 60 and rows(store.read().agg(F.sum("n"))) == [(25,)]


def test_cells_of_later_loads_stand(spark, tmp_path):
    table = tables.movies_table(spark, str(tmp_path / "movies"), buckets=4)
    titles = spark.createDataFrame([("tt1", "Alpha", 2000), ("tt2", "Beta", None), (None, "no key", 1)], "tconst string, primaryTitle string, startYear int")
    ratings = spark.createDataFrame([("tt1", 8.0, 3), ("tt9", 5.0, 1)], "tconst string, averageRating double, numVotes long")
    tables.load_movie_cells(table, titles, ratings)
    tables.put_cells(table, spark.createDataFrame([("tt2", "Beta II", None), ("tt2", None, 2001)], "tconst string, primaryTitle string, startYear int"))
    got = {r["tconst"]: (r["primaryTitle"], r["startYear"], r["rating"]) for r in table.read().collect()}
    assert got == {"tt1": ("Alpha", 2000, 8.0), "tt2": ("Beta II", 2001, None), "tt9": (None, None, 5.0)}
    table.compact()
    assert {r["tconst"]: (r["primaryTitle"], r["startYear"], r["rating"]) for r in table.read().collect()} == got
    with pytest.raises(ValueError, match="no columns"):
        tables.put_cells(table, titles.withColumn("colour", F.lit("red")))


def test_people_cells_equal_the_merged_profile(spark, fx, tmp_path):
    from marquee.plans.people import build_people

    table = tables.people_table(spark, str(tmp_path / "people"), buckets=4)
    tables.load_people_cells(table, fx["people"], fx["credits"], fx["ratings"])
    names = ["nconst", "primaryName", "total_movies", "distinct_titles", "top_text", "collaborators"]
    assert rows(table.read().select(*names)) == rows(build_people(fx["people"], fx["credits"], fx["ratings"]).select(*names))


def test_a_compacted_log_is_counted_once(spark, tmp_path):
    log = rating_store.vote_store(spark, str(tmp_path / "log"))
    root = str(tmp_path / "ratings")

    def put(batch, votes):
        df = spark.createDataFrame([(t, v, "2024-01-01_00_10") for t, v in votes], "tconst string, rating double, w string")
        log.append(df.withColumn("ts", F.lit(None).cast("timestamp")).withColumn("log_batch", F.lit(batch).cast("long")), batch)

    def ratings():
        return {r["tconst"]: (round(r["averageRating"], 6), r["numVotes"]) for r in rating_store.read_ratings_of(spark, root).collect()}

    seed = spark.createDataFrame([("a", 8.0, 1), ("b", 5.0, 2)], "tconst string, averageRating double, numVotes long")
    rating_store.seed_ratings(spark, root, seed)
    with pytest.raises(ValueError, match="already"):
        rating_store.seed_ratings(spark, root, seed)
    put(0, [("a", 10.0), ("c", 3.0), (None, 1.0), ("a", float("nan"))])
    put(1, [("a", 6.0)])
    assert rating_store.fold_log(spark, root, log) == 3
    assert ratings() == {"a": (8.0, 3), "b": (5.0, 2), "c": (3.0, 1)}
    log.compact()
    assert rating_store.fold_log(spark, root, log) == 0
    put(2, [("b", 8.0)])
    log.compact()
    put(3, [("b", 8.0)])
    # a run that wrote its sums and broke off before the ledger: the next run replaces them
    rating_store._partials(spark, root, "string").append(spark.createDataFrame([("b", 100.0, 1)], "tconst string, total double, votes long"), 2)
    assert rating_store.fold_log(spark, root, log, compact_every=1) == 2
    assert ratings() == {"a": (8.0, 3), "b": (6.5, 4), "c": (3.0, 1)} and rating_store.fold_log(spark, root, log) == 0
    untouched = rating_store._partials(spark, root, "string")._state()[0]
    put(4, [("b", 6.5)])
    rating_store.fold_log(spark, root, log, compact_every=1)
    now = rating_store._partials(spark, root, "string")._state()[0]
    assert sum(now[b] != untouched[b] for b in now) == 1  # only the bucket of the one title voted for


def test_dump_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.tsv").write_text("tconst\taverageRating\tnumVotes\ntt1\t8.1\t10\ntt2\tx\t3\ntt3\t7\ntt4\t6.0\t2\tmore\n\\N\t5.0\t1\ntt5\t\\N\t\\N\n")
    good, bad = tsv.split_dump(spark, str(tmp_path / "in"), schemas.RATINGS, str(tmp_path / "out"), "tconst")
    assert rows(good) == [("tt1", 8.1, 10), ("tt5", None, None)]
    got = {(r["line"], r["reason"]) for r in bad.collect()}
    assert got == {("tt2\tx\t3", "value"), ("tt3\t7", "fields"), ("tt4\t6.0\t2\tmore", "fields"), ("\\N\t5.0\t1", "key")}
    assert {r["source_file"].rpartition("/")[2] for r in bad.collect()} == {"a.tsv"}


def test_log_rows_of_any_batch_range(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "v string, at long", ["v"], all_rows, buckets=2)
    for b in range(5):
        store.append(spark.createDataFrame([(f"v{b}", b), (f"v{b}", b)], store.schema), b)
        if b == 2:
            store.compact()
    for since in range(-1, 5):
        assert rows(store.since(since, "at")) == sorted((f"v{b}", b) for b in range(since + 1, 5) for _ in range(2))
