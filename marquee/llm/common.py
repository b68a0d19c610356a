"""Small helpers of this package."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

#: Bits (32 MiB) of the map that tells most rows without a partner before a shuffle.
MARKS = 1 << 28

_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "67108864", "64MB")
BATCH_BYTES = 4 << 20

_open: list[list[str]] = []


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python hold about ``BATCH_BYTES`` of rows, however long texts are, unless the session sets the bound itself."""
    if spark.conf.get(_BATCH_CONF, _BATCH_DEFAULT[0]) in _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors, keeps columns prunable.

    Inside a ``scope`` the table goes when the scope ends; with ``outer`` it belongs to the scope around that one.
    """
    bounded_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    depth = 2 if outer else 1
    if len(_open) >= depth:
        _open[-depth].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside are removed at the end, and the shuffle files of what is no longer referenced.

    What leaves a scope must be written with ``outer``: a DataFrame that still reads the scope's tables can't be
    evaluated afterwards.
    """
    _open.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _open.pop():
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        jvm.System.gc()  # Spark drops the shuffle files of unreachable plans when the driver collects its garbage


def marks_of(ids: DataFrame) -> DataFrame:
    """The only column of ``ids``, hashed into at most ``MARKS`` bits: rows of 4 KiB, at most 32 MiB in all."""
    bit = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(MARKS))
    at = F.bitmap_bit_position("_bit").cast("int")
    return (ids.select(bit.alias("_bit")).select(F.bitmap_bucket_number("_bit").alias("_bucket"), at.alias("_at"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits")))


def marked(df: DataFrame, key: str, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the marked ids, all other rows), both read without a shuffle.

    Every row of a marked id is in the first part, with some others; a NULL key is in the second.
    """
    bit = F.pmod(F.xxhash64(F.col(key)), F.lit(MARKS))
    at = F.bitmap_bit_position("_bit").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    looked = (df.withColumn("_bit", F.when(F.col(key).isNotNull(), bit)).withColumn("_bucket", F.bitmap_bucket_number("_bit"))
              .join(F.broadcast(marks), "_bucket", "left").withColumn("_hit", F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))))
    return (looked.where("_hit").select(*df.columns), looked.where("NOT _hit").select(*df.columns))


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key isn't among ``ids`` (one column; NULL keys stay).

    Only rows that the marks let through are shuffled, by the same merge join at every size.
    """
    ids = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    near, far = marked(df, key, written(marks_of(ids), "marks"))
    # an outer join: Spark would push an anti-join below the marks
    found = near.join(ids.withColumn("_there", F.lit(True)).hint("merge"), key, "left")
    return found.where(F.col("_there").isNull()).select(*df.columns).unionByName(far)


def most_frequent(counted: DataFrame, most: int, count: str = "n") -> DataFrame:
    """At most ``most`` rows of the highest counts, cut where the logarithm of the count falls: no sort, no single task."""
    level = F.floor(F.log2(count) * 8).cast("int")
    seen, least = 0, None
    for r in sorted(counted.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        seen += r["count"]
        if seen > most:
            break
        least = r["level"]
    return counted.where(level >= least) if least is not None else counted.limit(0)
