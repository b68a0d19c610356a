"""End to end from tab-separated dumps: load, batch, stream (the three jobs)."""

import types

from marquee import cli
from marquee.plans import tables
from marquee.sinks.files import read_current

TITLES = ("tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
          "tt1\tmovie\tAlpha\tAlpha\t0\t2000\t\\N\t90\tDrama\ntt2\tmovie\tBeta\tBeta\t0\t2001\t\\N\t95\tComedy\n"
          "tt3\tmovie\tGamma\tGamma\t0\t2002\t\\N\t100\t\\N\ntt4\tshort\tDelta\tDelta\t0\t2003\t\\N\t10\tShort\n")
RATINGS = "tconst\taverageRating\tnumVotes\ntt1\t8.0\t100\ntt2\t9.0\t50\ntt3\t7.0\t10\ntt9\t5.0\t3\n"
PEOPLE = ("nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles\n"
          "nm1\tAna\t1970\t\\N\tactor\ttt1\nnm2\tBo\t1980\t\\N\tactress\ttt1\nnm3\tCy\t\\N\t\\N\tdirector\ttt1\n"
          "nm4\tDi\t1990\t2020\tactor\ttt2\nnm6\tFay\t1960\t\\N\tactress\t\\N\n")
CREDITS = ("tconst\tordering\tnconst\tcategory\tjob\tcharacters\n"
           "tt1\t1\tnm1\tactor\t\\N\t\\N\ntt1\t2\tnm2\tactress\t\\N\t\\N\ntt1\t3\tnm3\tdirector\t\\N\t\\N\n"
           "tt2\t1\tnm1\tactor\t\\N\t\\N\ntt2\t2\tnm4\tvoice_actor\t\\N\t\\N\n"
           "tt3\t1\tnm1\tactor\t\\N\t\\N\ntt3\t2\tnm1\tproducer\t\\N\t\\N\n"
           "tt4\t1\tnm2\tactress\t\\N\t\\N\ntt5\t1\tnm5\tactor\t\\N\t\\N\n")


def _dumps(tmp_path):
    paths = {}
    for name, body in (("titles", TITLES), ("ratings", RATINGS), ("people", PEOPLE), ("credits", CREDITS)):
        p = tmp_path / f"{name}.tsv"
        p.write_text(body)
        paths[name] = str(p)
    return paths


def test_load_job(spark, tmp_path):
    d = _dumps(tmp_path)
    with open(d["ratings"], "a") as f:
        f.write("tt2\tno number\t1\n")
    for out in ("out", "again"):  # the second load writes its cells over the first one's
        cli.load(spark, types.SimpleNamespace(out=str(tmp_path / out), tables=str(tmp_path / "tables"), **d))
    movies = {r["tconst"]: r["rating"] for r in spark.read.parquet(str(tmp_path / "out/movies")).collect()}
    assert movies == {"tt1": 8.0, "tt2": 9.0, "tt3": 7.0, "tt4": None, "tt9": 5.0}
    people = {r["nconst"]: r for r in spark.read.parquet(str(tmp_path / "out/people")).collect()}
    assert sorted(people) == ["nm1", "nm2", "nm3", "nm4", "nm5", "nm6"]
    assert people["nm1"]["total_movies"] == 4 and people["nm1"]["top_text"] == "{tt2=9.0, tt1=8.0, tt3=7.0}"
    top = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out/top10")).orderBy("credits", ascending=False).collect()]
    assert top[0] == ("nm1", 3)
    sets = {}
    for name in ("collaborators", "co_actors"):
        own = sets[name] = {}
        for r in spark.read.parquet(str(tmp_path / "out" / name)).collect():
            own.setdefault(r["nconst"], set()).update({r["other"]} - {None})
    assert set(sets["collaborators"]) <= set(people)
    assert all(len(s) == people[p]["collaborators"] for p, s in sets["collaborators"].items())
    assert all(s <= sets["collaborators"][p] for p, s in sets["co_actors"].items())
    stored = tables.people_table(spark, str(tmp_path / "tables/people")).read()
    assert {r["nconst"]: (r["total_movies"], r["top_text"], r["primaryName"]) for r in stored.collect()} == {
        k: (r["total_movies"], r["top_text"], r["primaryName"]) for k, r in people.items()}
    assert tables.movies_table(spark, str(tmp_path / "tables/movies")).read().count() == 5
    assert [r["line"] for r in spark.read.parquet(str(tmp_path / "out/ratings_rejects")).collect()] == ["tt2\tno number\t1"]


def test_batch_job(spark, tmp_path, capsys):
    d = _dumps(tmp_path)
    logs = tmp_path / "logs" / "00_10"
    logs.mkdir(parents=True)
    (logs / "part-00000").write_text("(tt1,10.0)\n(tt1,6.0)\n(tt3,9.0)\n(tt7,4.0)\n")
    store = str(tmp_path / "store")
    args = types.SimpleNamespace(credits=d["credits"], ratings_store=store, logs=str(tmp_path / "logs"),
                                 initial_ratings=d["ratings"], rounded=True)
    cli.batch(spark, args)
    assert capsys.readouterr().out.splitlines()[:4] == ["nm1\t3", "nm2\t2", "nm4\t1", "nm5\t1"]
    got = {r["tconst"]: (r["averageRating"], r["numVotes"]) for r in read_current(spark, store, "ratings").collect()}
    assert got == {"tt1": (8.0, 102), "tt2": (9.0, 50), "tt3": (7.2, 11), "tt7": (4.0, 1), "tt9": (5.0, 3)}


def test_stream_job(spark, tmp_path):
    d = _dumps(tmp_path)
    votes = tmp_path / "votes"
    votes.mkdir()
    (votes / "a.txt").write_text(
        "tt1\t8\t2024-01-01 00:00:30\ntt2\t\t9\t2024-01-01 00:01:10\ntt3\t7\t2024-01-01 00:01:20\n"
        "tt4\t7\t2024-01-01 00:01:30\ntt1\t4\t2024-01-01 00:02:05\nbroken line\n"
        "tt2\t5\t2024-01-01 01:00:00\n")
    args = types.SimpleNamespace(votes=str(votes), titles=d["titles"], out=str(tmp_path / "out"),
                                 checkpoint=str(tmp_path / "ck"), once=True)
    cli.stream(spark, args)
    log = spark.read.parquet(str(tmp_path / "out/log"))
    assert log.count() == 6
    top = spark.read.parquet(str(tmp_path / "out/top"))
    first = sorted((r["rank"], r["tconst"]) for r in top.collect()
                   if str(r["window_start"]).endswith("00:01:00"))
    assert first == [(1, "tt2"), (2, "tt3"), (3, "tt4")]
    rejects = spark.read.parquet(str(tmp_path / "out/rejects"))
    assert [r["tconst"] for r in rejects.collect()] == ["broken line"]
    assert spark.read.parquet(str(tmp_path / "out/trending/windows/deltas")).count() > 0
