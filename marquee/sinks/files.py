"""File outputs.

``write_version`` / ``read_current`` replace a table without ever
overwriting a path that is being read: each write goes to a new version
folder and only then is the small ``_current`` pointer replaced (write to
a temporary name, then rename).  Readers always follow the pointer, so a
failed or half-written version is never seen, and a rerun starts from the
last complete one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

POINTER = "_current"
OWNER = "_owner"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: one evaluation, kept when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """``key<TAB>value…`` text (no quoting, ``\\N`` for NULL, no header).

    ``single_file`` funnels the output through one task (the reference's
    one-part output); leave it off for large outputs.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("sep", "\t").option("quote", "").option("nullValue", "\\N")
     .option("emptyValue", "").option("header", "false").csv(path))


def write_key_lists(lists: DataFrame, path: str, key: str, mode: str = "errorifexists") -> None:
    """Rows of ``list_lines`` → ``key<TAB>i1,i2,…`` lines."""
    text = lists.select(F.col(key).cast("string"),
                        F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))
    write_tsv(text, path, mode)


def write_window_log(log: DataFrame, path: str, folders: str = "day", mode: str = "append",
                     fmt: str = "parquet") -> None:
    """Batch form of the per-window vote log (rows of ``operators.vote_log``).

    ``folders="day"`` → ``<path>/d=<yyyy-MM-dd>/`` with ``w`` as a column;
    ``folders="window"`` → ``<path>/w=<label>/`` (one folder per window).
    No shuffle: each task writes its own file into every folder it has
    rows for (a ``repartition`` by folder would put a whole day, or a hot
    window, into one task).
    """
    if folders == "day":
        out, part = log.withColumn("d", F.substring("w", 1, 10)), "d"
    elif folders == "window":
        out, part = log, "w"
    else:
        raise ValueError("folders must be 'day' or 'window'")
    out.write.mode(mode).format(fmt).partitionBy(part).save(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def current_version(spark: SparkSession, root: str) -> str | None:
    """Name of the current version folder of ``root`` (None if never written)."""
    fs, _, jvm = _fs(spark, root)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    return _read_line(fs, pointer, jvm)


def _read_line(fs, path, jvm) -> str | None:
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine().strip()
    finally:
        stream.close()


def claim_sink(spark: SparkSession, root: str, owner: str) -> None:
    """Bind ``root`` to ``owner`` (a stream's checkpoint); an error where it belongs to another.

    Streams write ``batch=<id>`` folders with overwrite, so a second checkpoint,
    whose ids start again at 0, would replace the first one's rows.
    """
    fs, _, jvm = _fs(spark, root)
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{OWNER}")
    held = _read_line(fs, path, jvm)
    if held is None:
        out = fs.create(path, False)
        try:
            out.write(bytearray(owner.encode("utf-8")))
        finally:
            out.close()
    elif held != owner:
        raise ValueError(f"{root} belongs to the stream with the checkpoint {held}")


def write_version(spark: SparkSession, root: str, parts: dict[str, DataFrame], fmt: str = "parquet") -> str:
    """Write ``parts`` (name → DataFrame) as a new version of ``root``; repoint ``_current``."""
    version = f"v-{uuid.uuid4().hex}"
    for name, df in parts.items():
        df.write.mode("errorifexists").format(fmt).save(f"{root}/{version}/{name}")
    fs, _, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    tmp = Path(f"{root}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(version.encode("utf-8")))
    finally:
        out.close()
    # one overwriting rename: readers see the old pointer or the new one, never none
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        tmp.toUri() if tmp.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    option[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(tmp, Path(f"{root}/{POINTER}"), option)
    if current_version(spark, root) != version:
        raise RuntimeError(f"the pointer of {root} was not replaced")
    return version


def has_versions(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` holds version folders, current or not."""
    fs, path, _ = _fs(spark, root)
    return fs.exists(path) and any(s.isDirectory() and s.getPath().getName().startswith("v-") for s in fs.listStatus(path))


def read_current(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame | None:
    """The ``name`` part of the current version of ``root`` (None if none yet)."""
    version = current_version(spark, root)
    if version is None:
        return None
    return spark.read.format(fmt).load(f"{root}/{version}/{name}")
