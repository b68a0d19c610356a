"""The driver contract, and every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "customer supplier part orders lineitem events documents labels".split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 and df.columns == ["nconst", "credits"]


def own_queries():
    """The queries of the library itself; those of the optional subpackage are tested beside it."""
    return {**entry.roles.BATCH, **entry.dumps.DUMPS, **entry.stream_queries.STREAMS}


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(own_queries()) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) else
                         (None if r[i] is None else str(r[i])) for i in order))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(own_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(res.fetchall(), dcols)


def test_cluster_conf_sizes_partitions():
    from marquee.session import cluster_conf

    conf = cluster_conf(100 * 2**40, 8000)  # 100 TiB on 1000 executors x 8 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert cluster_conf(10**6, 8)["spark.sql.shuffle.partitions"] == "16"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
