"""The registered queries of this package and, where SQL can say it, their DuckDB text."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (alignment, bloom_lm, bpe, chat, html_text, language_id, licenses, minhash, pq_dedup, resampling, secrets,
                         tiling, warc)
from marquee.llm.common import table


def tokenizer_path(variable: str = "MARQUEE_TOKENIZER", name: str = "word_bpe_49k.json") -> str:
    """A tokenizer file of the registered queries (the environment variable overrides it)."""
    if variable in os.environ:
        return os.environ[variable]
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "value", "probability")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.conversations(chat.chains(rows)))


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"), bloom_lm.crc_held_out())


def op7_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.TextModel.fit(docs), ["doc_id"])


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fusion over web pages: visible text, the html element's lang, host and address suffix."""
    model = language_id.TextModel.fit(table(spark, sf_dir, "documents"))
    pages = language_id.page_evidence(table(spark, sf_dir, "pages"))
    return language_id.identify(pages, model, ["page_id", "url"], "visible", "declared", "host", "suffix")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("MARQUEE_TOKENIZER_A", "byte_bpe_50k.json"),
                              tokenizer_path("MARQUEE_TOKENIZER_B", "piece_bpe_32k.model"))
    return docs


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_index(spark, warc.archive_pages(table(spark, sf_dir, "pages")))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_html_text": op2_html_text,
    "op3_minhash": op3_minhash,
    "op4_secrets": op4_secrets,
    "op5_chat": op5_chat,
    "op6_bloom_lm": op6_bloom_lm,
    "op7_tiling": op7_tiling,
    "op8_language_id": op8_language_id,
    "pages_language_id": pages_language_id,
    "op9_bpe": op9_bpe,
    "op10_pq_dedup": op10_pq_dedup,
    "op11_alignment": op11_alignment,
    "op12_resampling": op12_resampling,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    # exact intersections of all 2-word shingle sets
    "op3_minhash": r"""
WITH RECURSIVE
  w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
  s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g
        FROM w, unnest(range(1, greatest(len(ws), 2))) AS t(i) WHERE len(ws) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)),
  reach AS (SELECT doc_id AS root, doc_id AS x FROM documents UNION SELECT r.root, e.v FROM reach r JOIN e ON e.u = r.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT root, min(x) AS component_id FROM reach GROUP BY root) c ON c.root = d.doc_id""",
    "op5_chat": r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
  f AS (SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\h'), '<', '\l') AS body FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(4 + length(role) + 2 + length(body) + 9) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id""",
    "op10_pq_dedup": """
WITH RECURSIVE
  v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
  ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
  l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        AND list_cosine_similarity(a.e, b.e) >= 0.98),
  reach AS (SELECT vec_id AS root, vec_id AS x FROM embeddings UNION SELECT r.root, l.v FROM reach r JOIN l ON l.u = r.x)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT u, count(*) AS n FROM l GROUP BY u) n ON n.u = v.vec_id
JOIN (SELECT root, min(x) AS component_id FROM reach GROUP BY root) c ON c.root = v.vec_id""",
    "op13_warc": """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
  f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f""",
}
