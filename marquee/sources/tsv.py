"""Tab-separated dump readers (plain or compressed, header optional).

The dumps use TAB as separator, no quoting, and ``\\N`` for NULL.  Every
reader reads *without* a header and drops the row whose key equals the
header word, so the same reader accepts files with and without a header
(a rewritten ratings file has none).  Rows that are short or carry bad
numbers are read PERMISSIVE: missing or unparsable cells become NULL.
Compression (``.bz2``, ``.gz``) is chosen by the file extension and bz2
input stays splittable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas
from marquee.constants import FIELD_SEPARATOR, NULL_MARKER, PAIR_SEPARATOR
from marquee.functions.text import decode_scored, nonempty_split


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             header_key: str | None = None) -> DataFrame:
    """Read a TAB-separated dump with an explicit schema."""
    df = (
        spark.read.option("sep", FIELD_SEPARATOR)
        .option("header", "false")
        .option("quote", "")
        .option("nullValue", NULL_MARKER)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )
    if header_key is not None:
        key = schema.fieldNames()[0]
        df = df.where(F.col(key).isNotNull() & (F.col(key) != F.lit(header_key)))
    return df


def split_dump(spark: SparkSession, path: str | list[str], schema: T.StructType, out: str,
               header_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected lines) of a dump, from one scan of it.

    The scan writes both below ``out``; the frames returned read their part.  Rejected: a line with too few or too many
    fields (``reason`` ``fields``), with a cell that isn't of its type (``value``), or without a key (``key``), each with its
    whole ``line`` and ``source_file``.  Header lines are neither.
    """
    wide = T.StructType([*schema.fields, T.StructField("_line", T.StringType())])
    key, n = schema.fieldNames()[0], len(schema.fields)
    df = (spark.read.option("sep", FIELD_SEPARATOR).option("header", "false").option("quote", "").option("nullValue", NULL_MARKER)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").schema(wide).csv(path))
    if header_key is not None:
        first = F.coalesce(F.substring_index("_line", FIELD_SEPARATOR, 1), F.col(key))
        df = df.where(first.isNull() | (first != F.lit(header_key)))
    fields = F.size(F.split("_line", FIELD_SEPARATOR, -1))
    reason = (F.when(F.col("_line").isNotNull(), F.when(fields != n, "fields").otherwise("value"))
              .when(F.col(key).isNull(), "key"))
    shown = F.concat_ws(FIELD_SEPARATOR, *[F.coalesce(F.col(f.name).cast("string"), F.lit(NULL_MARKER)) for f in schema.fields])
    marked = df.select(*schema.fieldNames(), F.coalesce("_line", F.when(F.col(key).isNull(), shown)).alias("line"),
                       F.col("_metadata.file_path").alias("source_file"), reason.alias("reason"))
    marked.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(out)
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("line", T.StringType()), T.StructField("source_file", T.StringType()),
                                              T.StructField("reason", T.StringType()), T.StructField("rejected", T.BooleanType())])).parquet(out)
    return (written.where("NOT rejected").select(*schema.fieldNames()), written.where("rejected").select("line", "source_file", "reason"))


def read_titles(spark: SparkSession, path) -> DataFrame:
    """``title.basics``; adds ``genre_list`` (array) next to the text ``genres``."""
    df = read_tsv(spark, path, schemas.TITLES, schemas.HEADER_KEYS["titles"])
    return df.withColumn("genre_list", nonempty_split("genres", ","))


def read_ratings(spark: SparkSession, path) -> DataFrame:
    return read_tsv(spark, path, schemas.RATINGS, schemas.HEADER_KEYS["ratings"])


def read_people(spark: SparkSession, path) -> DataFrame:
    return read_tsv(spark, path, schemas.PEOPLE, schemas.HEADER_KEYS["people"])


def read_credits(spark: SparkSession, path) -> DataFrame:
    return read_tsv(spark, path, schemas.CREDITS, schemas.HEADER_KEYS["credits"])


def read_name_lookup(titles: DataFrame, title: str = "tconst",
                     name: str = "primaryTitle") -> DataFrame:
    """Title id → display name, from a titles DataFrame (header never included)."""
    return titles.select(F.col(title), F.col(name).alias("name")).where(F.col(title).isNotNull())


def read_key_lists(spark: SparkSession, path, key: str = "key", item: str = "item",
                   item_type: str = "string") -> DataFrame:
    """Hand-off files ``key<TAB>v1,v2,`` → one ``(key, item)`` row per list item.

    Empty items (trailing or doubled commas) are dropped.  Several lines for
    one key (a long list written in parts) simply add rows.
    """
    raw = (
        spark.read.option("sep", "\t").option("quote", "").option("header", "false")
        .schema(T.StructType([T.StructField(key, T.StringType()),
                              T.StructField("_list", T.StringType())]))
        .csv(path)
    )
    return (
        raw.where(F.col(key).isNotNull())
        .select(F.col(key), F.explode(nonempty_split("_list", ",")).alias(item))
        .withColumn(item, F.col(item).cast(item_type))
    )


def read_scored_lists(spark: SparkSession, path, key: str = "nconst", item: str = "tconst",
                      score: str = "averageRating", sep: str = PAIR_SEPARATOR) -> DataFrame:
    """Hand-off files ``key<TAB>t1#8.0,t2#7.5,`` → ``(key, item, score)`` rows.

    Empty items are dropped; an item whose score is not a number keeps a
    NULL score instead of failing the read.
    """
    pairs = read_key_lists(spark, path, key, "_pair")
    d = decode_scored("_pair", sep)
    return pairs.select(key, d["item"].alias(item), d["score"].alias(score))
