import bz2

from pyspark.sql import functions as F

from marquee.sources import (
    parse_vote_log_lines,
    parse_vote_stream_lines,
    read_credits,
    read_key_lists,
    read_ratings,
    read_titles,
    read_vote_log,
)


def test_titles_header_nulls_quotes_short_rows(spark, tmp_path):
    p = tmp_path / "title.basics.tsv"
    p.write_text(
        "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
        "tt1\tmovie\tThe \"Quoted\tThe \"Quoted\t0\t1999\t\\N\t90\tDrama,Comedy\n"
        "tt2\tshort\tShort row\n"
        "tt3\tmovie\tBad year\tBad year\t0\tabc\t\\N\t\\N\t\\N\n")
    rows = {r["tconst"]: r for r in read_titles(spark, str(p)).collect()}
    assert sorted(rows) == ["tt1", "tt2", "tt3"]
    assert rows["tt1"]["primaryTitle"] == 'The "Quoted'
    assert rows["tt1"]["endYear"] is None and rows["tt1"]["startYear"] == 1999
    assert rows["tt1"]["genre_list"] == ["Drama", "Comedy"]
    assert rows["tt2"]["runtimeMinutes"] is None
    assert rows["tt3"]["startYear"] is None


def test_ratings_without_header_and_bz2(spark, tmp_path):
    p = tmp_path / "title.ratings.tsv.bz2"
    p.write_bytes(bz2.compress(b"tt1\t8.0\t100\ntt2\t9.0\t50\n"))
    q = tmp_path / "with_header.tsv"
    q.write_text("tconst\taverageRating\tnumVotes\ntt3\t7.0\t10\n")
    got = sorted(tuple(r) for r in read_ratings(spark, [str(p), str(q)]).collect())
    assert got == [("tt1", 8.0, 100), ("tt2", 9.0, 50), ("tt3", 7.0, 10)]


def test_credits_reader(spark, tmp_path):
    p = tmp_path / "title.principals.tsv"
    p.write_text("tconst\tordering\tnconst\tcategory\tjob\tcharacters\n"
                 "tt1\t1\tnm1\tactor\t\\N\t[\"A\"]\n")
    r = read_credits(spark, str(p)).first()
    assert (r["tconst"], r["nconst"], r["category"], r["job"]) == ("tt1", "nm1", "actor", None)


def test_key_lists_drop_empty_items(spark, tmp_path):
    p = tmp_path / "lists"
    p.write_text("nm1\ttt1,tt2,,tt3,\nnm2\ttt9,\nnm1\ttt4,\n")
    got = sorted(tuple(r) for r in read_key_lists(spark, str(p), "nconst", "tconst").collect())
    assert got == [("nm1", "tt1"), ("nm1", "tt2"), ("nm1", "tt3"), ("nm1", "tt4"), ("nm2", "tt9")]


def test_vote_log_parse_rejects(spark):
    lines = spark.createDataFrame([("(tt1,8.5)",), ("(tt2,bad)",), ("",), ("no comma",), ("(tt3, 7)",)], "value string")
    got = [(r["tconst"], r["rating"], r["valid"]) for r in parse_vote_log_lines(lines).collect()]
    assert got == [("tt1", 8.5, True), ("tt2", None, False), (None, None, False),
                   ("no comma", None, False), ("tt3", 7.0, True)]


def test_vote_stream_line_parse(spark):
    lines = spark.createDataFrame([("tt1\t\t9",), ("tt2\t7.5",), ("tt3",)], "value string")
    got = [(r["tconst"], r["rating"], r["valid"]) for r in parse_vote_stream_lines(lines).collect()]
    assert got == [("tt1", 9.0, True), ("tt2", 7.5, True), ("tt3", None, False)]


def test_read_vote_log_recursive(spark, tmp_path):
    for d, body in (("a/00_10", "(tt1,1.0)\n"), ("b/00_20", "(tt2,2.0)\n(tt2,3.0)\n")):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "part-00000").write_text(body)
        (tmp_path / d / "_SUCCESS").write_text("")
    df = read_vote_log(spark, str(tmp_path))
    assert df.count() == 3
    assert df.select(F.countDistinct("source_file")).first()[0] == 2


def test_scored_lists(spark, tmp_path):
    from marquee.sources import read_scored_lists

    p = tmp_path / "top3"
    p.write_text("nm1\ttt2#9.0,tt1#8.0,,tt3#x,\n")
    got = sorted(tuple(r) for r in read_scored_lists(spark, str(p)).collect())
    assert got == [("nm1", "tt1", 8.0), ("nm1", "tt2", 9.0), ("nm1", "tt3", None)]


def test_key_lists_round_trip(spark, fx, tmp_path):
    from marquee.operators import list_lines, positions
    from marquee.sinks import write_key_lists

    lists = list_lines(positions(fx["credits"], "nconst", "tconst"), "nconst", "tconst", line_items=2)
    assert [r["items"] for r in lists.where("nconst = 'nm1'").orderBy("line").collect()] == [["tt1", "tt2"], ["tt3", "tt3"]]
    write_key_lists(lists, str(tmp_path / "out"), "nconst")
    back = read_key_lists(spark, str(tmp_path / "out"), "nconst", "tconst")
    expect = fx["credits"].select("nconst", "tconst")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, expect.collect()))


def test_window_log_writer(spark, tmp_path):
    import datetime as dt

    from marquee.operators import vote_log
    from marquee.sinks import write_window_log

    votes = spark.createDataFrame(
        [("tt1", 1.0, dt.datetime(2024, 1, 1, 23, 55)), ("tt2", 2.0, dt.datetime(2024, 1, 2, 0, 5))],
        "tconst string, rating double, ts timestamp")
    write_window_log(vote_log(votes), str(tmp_path / "log"))
    back = spark.read.parquet(str(tmp_path / "log"))
    assert sorted((str(r["d"]), r["w"]) for r in back.collect()) == [
        ("2024-01-02", "2024-01-02_00_00"), ("2024-01-02", "2024-01-02_00_10")]


def test_scored_text_round_trip(spark):
    from marquee.functions import decode_scored, encode_scored

    df = spark.createDataFrame([("tt1", 8.5), ("tt2", None)], "t string, r double")
    text = df.select(encode_scored("t", "r").alias("x"))
    back = [tuple(r["d"]) for r in text.select(decode_scored("x").alias("d")).collect()]
    assert back == [("tt1", 8.5), ("tt2", None)]


def test_write_tsv_single_file(spark, tmp_path):
    from marquee.sinks import write_tsv

    df = spark.range(100).repartition(4).selectExpr("cast(id as string) as k", "id * 2 as v")
    write_tsv(df, str(tmp_path / "out"), single_file=True)
    parts = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    lines = parts[0].read_text().splitlines()
    assert len(lines) == 100 and all(len(ln.split("\t")) == 2 for ln in lines)
