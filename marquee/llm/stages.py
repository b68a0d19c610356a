"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of their input.  Every row is a document of its own in every stage: rows that
share an id, or have none, are judged by their own texts, and only rows that are rejected, copies or leaks
themselves go.  NULL texts count as empty.  Empty tables pass through.

A stage numbers the rows of its input by file and place in the file (64-bit hashes: two rows share a number with a
chance of 2^-64), so they have the same numbers whenever and however the table is read; only a frame that isn't
read from files is numbered by partitions.  What a stage writes on the way is removed
before it returns, up to the small tables that its result still reads.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, language_id, minhash, secrets, tiling
from marquee.llm.common import bounded_batches, marked, marks_of, scope, table, without, written

ROW = "_row"


def _numbered(docs: DataFrame) -> DataFrame:
    try:
        return docs.withColumn(ROW, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:
        return docs.withColumn(ROW, F.monotonically_increasing_id())


def _drop(rows: DataFrame, gone: DataFrame, docs: DataFrame) -> DataFrame:
    return without(rows, ROW, gone).select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't accepted go."""
    rows = _numbered(docs)
    with scope(spark):
        found = language_id.identify(rows, language_id.TextModel.fit(docs), [ROW])
        gone = written(found.where("NOT accepted").select(ROW), "pipeline-rejected", outer=True)
    return _drop(rows, gone, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays: the smallest id's first row.

    A row without an id counts as the last of its group.
    """
    rows = _numbered(docs)
    with scope(spark):
        found = minhash.near_duplicates(rows, shingle_words=5, percent=80, id_col=ROW)
        linked = written(found.select(F.col("doc_id").alias(ROW), "component_id"), "pipeline-components")
        named = linked.join(rows.select(ROW, "doc_id").hint("merge"), ROW)
        order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
        # map-side minima, and a join by row: no task gets all rows of a large group
        first = named.groupBy("component_id").agg(F.min(order)[ROW].alias(ROW)).select(ROW).withColumn("_first", F.lit(True))
        gone = linked.join(first.hint("merge"), ROW, "left").where("_first IS NULL").select(ROW)
        gone = written(gone, "pipeline-copies", outer=True)
    return _drop(rows, gone, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item go."""
    rows = _numbered(docs)
    with scope(spark):
        leaks = tiling.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col=ROW)
        gone = written(leaks.select(F.col("doc_id").alias(ROW)).distinct(), "pipeline-leaks", outer=True)
    return _drop(rows, gone, docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; ``n_chars`` of the changed rows is their new length."""
    rows = _numbered(docs)
    with scope(spark):
        found = written(secrets.scan(rows, id_col=ROW), "pipeline-secrets", outer=True)
    near, far = marked(rows, ROW, written(marks_of(found.select("doc_id").distinct()), "marks"))
    clean = secrets.redact(near.withColumn("_old", F.col("text")), found, id_col=ROW)
    clean = clean.withColumn("n_chars", F.when(F.col("text") != F.col("_old"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns).unionByName(far.select(*docs.columns))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document left."""
    from marquee.llm.queries import tokenizer_path

    bounded_batches(spark)
    return bpe.digests(docs, tokenizer_path())
