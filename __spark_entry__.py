"""

``entry(spark)`` runs the flagship query (the ten most-credited people) on
``/root/testdata/sf0.001``.  ``queries()`` maps every implemented product to
a callable ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives, for each
of them that SQL can express, the same query for DuckDB over the parquet
views ``lineitem orders part events customer documents labels …``.
Column names are identical on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans import dumps, roles  # noqa: E402
from marquee.streaming import registered as stream_queries  # noqa: E402

try:  # the subpackage and the pipeline may be absent
    import corpus_pipeline  # noqa: E402
    from marquee.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return roles.top10_people(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per implemented product (batch forms, then stream forms)."""
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(roles.BATCH)
    out.update(dumps.DUMPS)
    out.update(stream_queries.STREAMS)
    if llm_queries is not None:
        out.update(llm_queries.QUERIES)
        out["pipeline"] = corpus_pipeline.run
    return out


# Shared SQL fragments -------------------------------------------------------

_CREDITS = "SELECT l_orderkey AS tconst, l_partkey AS nconst, l_returnflag AS category FROM lineitem"
_ACTING = "(contains(category, 'A') OR contains(category, 'R'))"
_VOTES = "SELECT user_id AS tconst, value AS rating, ts FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL AND ts IS NOT NULL"
_TS = "'%Y-%m-%d %H:%M:%S'"

_TOP3 = f"""
WITH c AS (SELECT DISTINCT nconst, tconst FROM ({_CREDITS}) WHERE nconst IS NOT NULL AND tconst IS NOT NULL),
     r AS (SELECT o_orderkey AS tconst, max(o_totalprice) AS averageRating FROM orders
           WHERE o_orderkey IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1),
     j AS (SELECT c.nconst, c.tconst, r.averageRating FROM c JOIN r ON r.tconst = c.tconst),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY nconst ORDER BY averageRating DESC, tconst) AS rn FROM j)
SELECT nconst, CAST(rn AS INTEGER) AS rank, tconst, averageRating FROM ranked WHERE rn <= 3
"""

_TOP3_TEXT = f"""
SELECT nconst,
       '{{' || string_agg(CAST(tconst AS VARCHAR) || '=' || CAST(CAST(averageRating AS DECIMAL(18,2)) AS VARCHAR), ', ' ORDER BY rank) || '}}' AS top_text
FROM ({_TOP3}) GROUP BY nconst
"""


def _collab_count(where: str, alias: str, credits: str = _CREDITS) -> str:
    return f"""
WITH m AS (SELECT DISTINCT tconst, nconst FROM ({credits}) WHERE tconst IS NOT NULL AND nconst IS NOT NULL AND {where}),
     p AS (SELECT a.nconst, b.nconst AS other FROM m a JOIN m b ON a.tconst = b.tconst AND a.nconst <> b.nconst)
SELECT k.nconst, count(DISTINCT p.other) AS {alias}
FROM (SELECT DISTINCT nconst FROM m) k LEFT JOIN p ON p.nconst = k.nconst
GROUP BY k.nconst
"""


def _collab_sets(where: str) -> str:
    return f"""
WITH m AS (SELECT DISTINCT tconst, nconst FROM ({_CREDITS}) WHERE tconst IS NOT NULL AND nconst IS NOT NULL AND {where}),
     p AS (SELECT DISTINCT a.nconst, b.nconst AS other FROM m a JOIN m b ON a.tconst = b.tconst AND a.nconst <> b.nconst)
SELECT k.nconst,
       CASE WHEN count(p.other) = 0 THEN '[]'
            ELSE '[' || string_agg(CAST(p.other AS VARCHAR), ', ' ORDER BY p.other) || ']' END AS set_text
FROM (SELECT DISTINCT nconst FROM m) k LEFT JOIN p ON p.nconst = k.nconst
GROUP BY k.nconst
"""


_CREDIT_COUNT = f"""
SELECT nconst, count(*) AS total_movies, count(DISTINCT tconst) AS distinct_titles
FROM ({_CREDITS}) WHERE nconst IS NOT NULL GROUP BY nconst
"""


def _list_text(key: str, item: str) -> str:
    return f"""
SELECT {key}, string_agg(CAST({item} AS VARCHAR), ',' ORDER BY {item}) AS list_text
FROM ({_CREDITS}) WHERE {key} IS NOT NULL AND {item} IS NOT NULL GROUP BY {key}
"""


def _positions(key: str, item: str, credits: str = _CREDITS) -> str:
    return f"""
SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY {item}) AS pos, {item}, count(*) OVER (PARTITION BY {key}) AS n_items
FROM ({credits}) WHERE {key} IS NOT NULL AND {item} IS NOT NULL
"""


_HOT_CREDITS = "SELECT l_returnflag AS tconst, l_partkey AS nconst FROM lineitem"

# Orders that share a supplier's nation; the nations of an order are the bits of one number.
_SIGNATURES = """
WITH m AS (SELECT l_orderkey AS nconst, bit_or(CAST(1 AS BIGINT) << s_nationkey) AS sig
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_orderkey IS NOT NULL AND s_nationkey IS NOT NULL GROUP BY 1),
     s AS (SELECT sig, count(*) AS n FROM m GROUP BY sig),
     r AS (SELECT a.sig, sum(b.n) AS reach FROM s a JOIN s b ON (a.sig & b.sig) <> 0 GROUP BY a.sig)
SELECT m.nconst, CAST(r.reach - 1 AS BIGINT) AS collaborators FROM m JOIN r ON r.sig = m.sig
"""


def _fold_sql(rounded: bool) -> str:
    """Rating update. Exact: closed form. Rounded: the vote-by-vote fold as a recursive CTE."""
    base_avg = "round_even(c_acctbal * 10, 0) / 10" if rounded else "c_acctbal"
    base = f"SELECT c_custkey AS tconst, {base_avg} AS a, CAST(c_nationkey + 1 AS BIGINT) AS n FROM customer WHERE c_custkey IS NOT NULL"
    if not rounded:
        return f"""
WITH b AS ({base}),
     v AS (SELECT tconst, sum(rating) AS s, count(rating) AS k FROM ({_VOTES}) GROUP BY tconst)
SELECT coalesce(b.tconst, v.tconst) AS tconst,
       round(CASE WHEN v.k IS NULL THEN b.a
                  ELSE (coalesce(b.n, 0) * coalesce(b.a, 0.0) + v.s) / (coalesce(b.n, 0) + v.k) END, 6) AS averageRating,
       CAST(coalesce(b.n, 0) + coalesce(v.k, 0) AS BIGINT) AS numVotes
FROM b FULL OUTER JOIN v ON b.tconst = v.tconst
"""
    return f"""
WITH RECURSIVE
  b AS ({base}),
  v AS (SELECT tconst, rating, row_number() OVER (PARTITION BY tconst ORDER BY ts, rating) AS rn FROM ({_VOTES})),
  k AS (SELECT tconst, count(*) AS k FROM v GROUP BY tconst),
  start AS (SELECT coalesce(b.tconst, k.tconst) AS tconst, coalesce(b.a, 0.0) AS a, coalesce(b.n, 0) AS n,
                   b.a AS a0, k.k AS k
            FROM b FULL OUTER JOIN k ON b.tconst = k.tconst),
  fold AS (
    SELECT tconst, CAST(a AS DOUBLE) AS a, CAST(n AS BIGINT) AS n, 0 AS step FROM start WHERE k IS NOT NULL
    UNION ALL
    SELECT f.tconst, round_even((f.n * f.a + v.rating) / (f.n + 1) * 10, 0) / 10, f.n + 1, f.step + 1
    FROM fold f JOIN v ON v.tconst = f.tconst AND v.rn = f.step + 1
  ),
  last AS (SELECT tconst, arg_max(a, step) AS a, max(n) AS n FROM fold GROUP BY tconst)
SELECT s.tconst,
       round(CASE WHEN s.k IS NULL THEN s.a0 ELSE l.a END, 6) AS averageRating,
       CAST(CASE WHEN s.k IS NULL THEN s.n ELSE l.n END AS BIGINT) AS numVotes
FROM start s LEFT JOIN last l ON l.tconst = s.tconst
"""


_ROUNDED_MIXED = """
WITH RECURSIVE
  v AS (SELECT l_partkey AS tconst, CASE WHEN l_partkey % 2 = 0 THEN l_discount ELSE l_quantity END AS rating,
               l_shipdate, l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IS NOT NULL),
  r AS (SELECT tconst, rating, row_number() OVER (PARTITION BY tconst ORDER BY l_shipdate, l_orderkey, l_linenumber, rating) AS rn
        FROM v WHERE rating IS NOT NULL),
  fold AS (
    SELECT tconst, round_even(rating * 10, 0) / 10 AS a, CAST(1 AS BIGINT) AS n FROM r WHERE rn = 1
    UNION ALL
    SELECT f.tconst, round_even((f.n * f.a + r.rating) / (f.n + 1) * 10, 0) / 10, f.n + 1
    FROM fold f JOIN r ON r.tconst = f.tconst AND r.rn = f.n + 1)
SELECT tconst, round(arg_max(a, n), 6) AS averageRating, max(n) AS numVotes FROM fold GROUP BY tconst
"""


def _window(length_min: int) -> str:
    return f"time_bucket(INTERVAL '{length_min} minutes', ts)"


_VOTE_LOG = f"""
SELECT strftime({_window(10)} + INTERVAL '10 minutes', '%Y-%m-%d_%H_%M') AS w,
       strftime({_window(10)}, {_TS}) AS window_start,
       strftime({_window(10)} + INTERVAL '10 minutes', {_TS}) AS window_end,
       tconst, rating, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM (SELECT user_id AS tconst, value AS rating, ts FROM events WHERE ts IS NOT NULL)
"""

_SLIDING = f"""
WITH s AS (SELECT v.tconst, v.rating, time_bucket(INTERVAL '1 minute', v.ts) - r.k * INTERVAL '1 minute' AS ws
           FROM ({_VOTES}) v CROSS JOIN range(0, 10) r(k))
SELECT ws, tconst, avg(rating) AS average, count(rating) AS votes FROM s GROUP BY ws, tconst
"""

_SLIDING_AVG = f"""
SELECT strftime(ws, {_TS}) AS window_start, strftime(ws + INTERVAL '10 minutes', {_TS}) AS window_end,
       tconst, round(average, 6) AS average, votes
FROM ({_SLIDING})
"""

_SLIDING_TOP3 = f"""
WITH a AS ({_SLIDING}),
     named AS (SELECT a.*, c.c_name AS name FROM a JOIN customer c ON c.c_custkey = a.tconst),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY average DESC, tconst) AS rn FROM named)
SELECT strftime(ws, {_TS}) AS window_start, strftime(ws + INTERVAL '10 minutes', {_TS}) AS window_end,
       CAST(rn AS INTEGER) AS rank, tconst, name, round(average, 6) AS average
FROM ranked WHERE rn <= 3
"""


def _trending_sql(length: str, mode: str) -> str:
    """Trending, written as the reference's per-title state recurrence (recursive CTE)."""
    counts = f"""SELECT time_bucket(INTERVAL '{length}', ts) AS ws, tconst, count(*) AS votes
                 FROM ({_VOTES}) GROUP BY 1, 2"""
    if mode == "growth":
        body = f"""
WITH c AS ({counts}),
     p AS (SELECT c.*, coalesce(prev.votes, 0) AS prev FROM c
           LEFT JOIN c prev ON prev.tconst = c.tconst AND prev.ws + INTERVAL '{length}' = c.ws)
SELECT ws, tconst, votes FROM p WHERE votes > prev
"""
    else:
        body = f"""
WITH RECURSIVE
  c AS (SELECT *, row_number() OVER (PARTITION BY tconst ORDER BY ws) AS i FROM ({counts})),
  s AS (SELECT tconst, i, ws, votes, votes AS state FROM c WHERE i = 1
        UNION ALL
        SELECT c.tconst, c.i, c.ws, c.votes, CASE WHEN c.votes > s.state THEN c.votes ELSE 0 END
        FROM s JOIN c ON c.tconst = s.tconst AND c.i = s.i + 1)
SELECT ws, tconst, votes FROM s WHERE state <> 0
"""
    return f"""
SELECT strftime(t.ws, {_TS}) AS window_start, strftime(t.ws + INTERVAL '{length}', {_TS}) AS window_end,
       t.tconst, c.c_name AS name, t.votes
FROM ({body}) t JOIN customer c ON c.c_custkey = t.tconst
"""


TOP_DELAY = "10 minutes"


def _closed(sql: str, delay: str) -> str:
    """The rows whose window the watermark (largest event time less the delay) has passed."""
    return f"""SELECT * FROM ({sql})
        WHERE strptime(window_end, {_TS}) <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"""


_PROFILE = f"""
WITH info AS (SELECT p_partkey AS nconst, p_name AS primaryName FROM part WHERE p_partkey IS NOT NULL),
     cnt AS ({_CREDIT_COUNT}),
     top AS ({_TOP3_TEXT}),
     co AS ({_collab_count(_ACTING, "co_actors")}),
     k AS (SELECT nconst FROM info UNION SELECT nconst FROM cnt UNION SELECT nconst FROM top UNION SELECT nconst FROM co)
SELECT k.nconst, info.primaryName, cnt.total_movies, cnt.distinct_titles, top.top_text, co.co_actors
FROM k LEFT JOIN info ON info.nconst = k.nconst LEFT JOIN cnt ON cnt.nconst = k.nconst
       LEFT JOIN top ON top.nconst = k.nconst LEFT JOIN co ON co.nconst = k.nconst
"""


# The dump queries have text ids, so titles of one score rank by text.
_TEXT_CREDITS = ("SELECT CAST(l_orderkey AS VARCHAR) AS tconst, CAST(l_partkey AS VARCHAR) AS nconst, "
                 "l_returnflag AS category FROM lineitem")


def _text_ids(sql: str) -> str:
    return sql.replace(_CREDITS, _TEXT_CREDITS).replace("o_orderkey AS tconst", "CAST(o_orderkey AS VARCHAR) AS tconst")


_LOAD_MOVIES = """
SELECT coalesce(CAST(p_partkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)) AS tconst, p_type AS "titleType",
       p_name AS "primaryTitle", CAST(NULL AS VARCHAR) AS "originalTitle", CAST(NULL AS INTEGER) AS "isAdult",
       CAST(p_size AS INTEGER) AS "startYear", CAST(NULL AS INTEGER) AS "endYear", CAST(NULL AS INTEGER) AS "runtimeMinutes",
       CASE WHEN p_partkey IS NOT NULL THEN concat_ws(',', p_brand, p_type) END AS genres,
       CASE WHEN p_partkey IS NOT NULL THEN concat_ws('|', p_brand, p_type) END AS genre_list, o_totalprice AS rating
FROM (SELECT * FROM part WHERE p_partkey IS NOT NULL) FULL OUTER JOIN (SELECT * FROM orders WHERE o_orderkey IS NOT NULL)
     ON p_partkey = o_orderkey
"""

_LOAD_PEOPLE = _text_ids(f"""
WITH info AS (SELECT CAST(p_partkey AS VARCHAR) AS nconst, p_name AS primaryName, p_size AS birthYear FROM part
              WHERE p_partkey IS NOT NULL),
     cnt AS ({_CREDIT_COUNT}),
     top AS ({_TOP3_TEXT}),
     co AS ({_collab_count("TRUE", "collaborators")}),
     k AS (SELECT nconst FROM info UNION SELECT nconst FROM cnt)
SELECT k.nconst, info.primaryName, CAST(info.birthYear AS INTEGER) AS birthYear, CAST(NULL AS INTEGER) AS deathYear,
       cnt.total_movies, cnt.distinct_titles, top.top_text, co.collaborators
FROM k LEFT JOIN info ON info.nconst = k.nconst LEFT JOIN cnt ON cnt.nconst = k.nconst
       LEFT JOIN top ON top.nconst = k.nconst LEFT JOIN co ON co.nconst = k.nconst
""")


_PEOPLE_TABLE = f"""
SELECT nconst, CASE WHEN p_size = 1 THEN upper("primaryName") ELSE "primaryName" END AS "primaryName",
       CAST(NULL AS INTEGER) AS "birthYear", "deathYear", total_movies, distinct_titles, top_text, collaborators
FROM ({_LOAD_PEOPLE}) LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = nconst
"""

_RATINGS_DUMP = """
SELECT CAST(o_orderkey AS VARCHAR) AS tconst, CASE WHEN ok THEN o_totalprice END AS "averageRating",
       CASE WHEN ok THEN CAST(o_custkey AS BIGINT) END AS "numVotes",
       CASE WHEN p IN ('1', '3') THEN 'fields' WHEN p = '2' THEN 'value' END AS reason
FROM (SELECT *, o_orderpriority[1] AS p, o_orderpriority[1] NOT IN ('1', '2', '3') AS ok FROM orders)
"""


def oracle_sql() -> dict[str, str]:
    """Equivalent DuckDB SQL per query (stream forms whose result differs from batch are omitted)."""
    sql = {
        "top10_people": f"""
            SELECT nconst, count(*) AS credits FROM ({_CREDITS})
            WHERE nconst IS NOT NULL AND {_ACTING}
            GROUP BY nconst ORDER BY credits DESC, nconst LIMIT 10""",
        "person_credit_count": _CREDIT_COUNT,
        "title_positions_by_person": _positions("nconst", "tconst"),
        "person_positions_hot": _positions("tconst", "nconst", _HOT_CREDITS),
        "titles_by_person": _list_text("nconst", "tconst"),
        "persons_by_title": _list_text("tconst", "nconst"),
        "top3_by_person": _TOP3,
        "top3_map_text": _TOP3_TEXT,
        "collaborator_pairs": f"""
            WITH m AS (SELECT DISTINCT tconst, nconst FROM ({_CREDITS}) WHERE tconst IS NOT NULL AND nconst IS NOT NULL)
            SELECT DISTINCT a.nconst, b.nconst AS other FROM m a JOIN m b ON a.tconst = b.tconst AND a.nconst <> b.nconst""",
        "collaborator_count": _collab_count("TRUE", "collaborators"),
        "collaborator_count_hot": _collab_count("TRUE", "collaborators", _HOT_CREDITS),
        "collaborator_count_signatures": _SIGNATURES,
        "co_actor_count": _collab_count(_ACTING, "co_actors"),
        "collaborator_sets": _collab_sets("TRUE"),
        "co_actor_sets": _collab_sets(_ACTING),
        "person_info": "SELECT p_partkey AS nconst, p_name AS primaryName, p_type AS primaryProfession FROM part",
        "person_profile": _PROFILE,
        "merge_by_key": """
            SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
            FROM (SELECT * FROM documents WHERE doc_id IS NOT NULL) d
            FULL OUTER JOIN (SELECT * FROM labels WHERE doc_id IS NOT NULL) l ON d.doc_id = l.doc_id""",
        "ratings_update_exact": _fold_sql(rounded=False),
        "ratings_update_rounded": _fold_sql(rounded=True),
        "ratings_update_rounded_mixed": _ROUNDED_MIXED,
        "ratings_update_from_stream_log": _fold_sql(rounded=False),
        "vote_log": _VOTE_LOG,
        "sliding_avg": _SLIDING_AVG,
        "sliding_top3": _SLIDING_TOP3,
        "trending_15m": _trending_sql("15 minutes", "reset"),
        "trending_1d": _trending_sql("1 day", "reset"),
        "trending_growth_1d": _trending_sql("1 day", "growth"),
        "vote_lines_parsed": """
            WITH l AS (SELECT '(' || CAST(user_id AS VARCHAR) || ',' ||
                              CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END || ')' AS line
                       FROM events),
                 p AS (SELECT string_split(regexp_replace(line, '[()]', '', 'g'), ',') AS parts FROM l)
            SELECT nullif(trim(parts[1]), '') AS tconst, TRY_CAST(trim(parts[2]) AS DOUBLE) AS rating,
                   (nullif(trim(parts[1]), '') IS NOT NULL AND TRY_CAST(trim(parts[2]) AS DOUBLE) IS NOT NULL) AS valid
            FROM p""",
        "vote_stream_lines_parsed": """
            WITH l AS (SELECT CAST(user_id AS VARCHAR) || chr(9) || chr(9) || CAST(value AS VARCHAR) AS line FROM events),
                 p AS (SELECT regexp_split_to_array(line, '\t+') AS parts FROM l)
            SELECT nullif(trim(parts[1]), '') AS tconst, TRY_CAST(trim(parts[2]) AS DOUBLE) AS rating,
                   (nullif(trim(parts[1]), '') IS NOT NULL AND TRY_CAST(trim(parts[2]) AS DOUBLE) IS NOT NULL) AS valid
            FROM p""",
        "load_movies": _LOAD_MOVIES,
        "people_table_cells": _PEOPLE_TABLE,
        "ratings_dump_rejects": _RATINGS_DUMP,
        "ratings_store_from_compacted_log": _fold_sql(rounded=False),
        "load_people": _LOAD_PEOPLE,
        "credits_key_lists": f"SELECT nconst, tconst FROM ({_CREDITS}) WHERE nconst IS NOT NULL AND tconst IS NOT NULL",
        "top3_scored_lists": f"SELECT nconst, tconst, averageRating FROM ({_TOP3})",
        "ratings_update_from_text_log": _fold_sql(rounded=False).replace(
            _VOTES, f"{_VOTES} AND event_type IS DISTINCT FROM 'error'"),
        # A stream reports a window once the watermark has passed its end.
        "sliding_top3_stream": _closed(_SLIDING_TOP3, TOP_DELAY),
        "sliding_top3_stream_open": _SLIDING_TOP3,
        "sliding_top3_stream_late": _SLIDING_TOP3,
        "trending_15m_stream": _trending_sql("15 minutes", "reset"),
        "trending_15m_stream_late": _trending_sql("15 minutes", "reset"),
        # The stream form of the log is stateless, so it must equal the batch log exactly.
        "vote_log_stream": _VOTE_LOG,
    }
    if llm_queries is not None:
        sql.update(llm_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {k: v for k, v in sql.items() if k in queries()}
