"""Tables that are updated by batches: rows per key, kept as a base of buckets and as deltas not yet merged.

    <root>/deltas/_batch=<id>/_bucket=<b>/…   what a batch wrote (a repeated batch replaces its own rows)
    <root>/base/<run>/_bucket=<b>/…           merged rows; a compaction writes only the buckets that have deltas
    <root>/<version>/, <root>/_current        which folder holds each bucket, and up to which batch it is merged

An update writes its own rows only.  A read takes the buckets without deltas as they are and merges the others;
``compact`` makes that merge permanent.  The pointer moves by one rename; folders that it no longer names are
removed by the next compaction, so a reader that began before keeps its files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sinks.files import _fs, current_version, read_current, write_version

BATCH, BUCKET = "_batch", "_bucket"
_MERGED = -1  # the batch of merged rows: older than any delta


def latest_row(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the last batch per key."""
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("_row"))
    return last.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def latest_cells(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and column the last cell that isn't NULL."""
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(BATCH))).alias(c) for c in values])


def sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per key of every other column."""
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def all_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Every row: a log, in buckets."""
    return rows.drop(BATCH)


def hash_bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n)).cast("int").cast("string")


class KeyedStore:
    """A table of ``schema`` below ``root`` with one row per ``keys``.

    ``merge`` says what several rows of a key come to (``latest_row``, ``latest_cells``, ``sums``, ``all_rows``); within one
    batch a key has one row, or with the last two any number.  ``bucket`` is a Column over the keys (a hash into ``buckets`` by default; the
    day of a time column makes a compaction rewrite only the days that changed).  Its root, keys, merge and
    bucket have to stay the same over the table's life.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, keys: list[str],
                 merge: Callable[[DataFrame, list[str]], DataFrame] = latest_row, bucket: Column | None = None, buckets: int = 16):
        self.spark, self.root, self.keys, self.merge = spark, root.rstrip("/"), keys, merge
        self.schema = spark.createDataFrame([], schema).schema
        self.bucket = hash_bucket(keys, buckets) if bucket is None else bucket.cast("string")

    # Files

    def _folders(self, path: str) -> list[str]:
        fs, p, _ = _fs(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    def _remove(self, path: str) -> None:
        fs, p, _ = _fs(self.spark, path)
        fs.delete(p, True)

    def _state(self) -> tuple[dict[str, str], int]:
        """(folder of each bucket, last merged batch)"""
        rows = read_current(self.spark, self.root, "buckets")
        if rows is None:
            return {}, _MERGED
        found = rows.collect()
        return {r["bucket"]: r["folder"] for r in found if r["folder"] is not None}, max(r["upto"] for r in found)

    def batches(self) -> list[int]:
        """Batches that are kept as deltas, merged ones still lying there included."""
        return sorted(int(m[1]) for f in self._folders(f"{self.root}/deltas") if (m := re.fullmatch(rf"{BATCH}=(\d+)", f)))

    def last_batch(self) -> int:
        """The highest batch ever appended, -1 if none."""
        return max([self._state()[1], *self.batches()])

    def _pending(self, upto: int) -> list[int]:
        return [b for b in self.batches() if b > upto]

    def _touched(self, pending: list[int]) -> set[str]:
        return {f.partition("=")[2] for b in pending for f in self._folders(f"{self.root}/deltas/{BATCH}={b}") if f.startswith(f"{BUCKET}=")}

    def _read(self, folders: list[str], batch: int) -> DataFrame:
        rows = (self.spark.read.schema(self.schema).parquet(*folders) if folders
                else self.spark.createDataFrame([], self.schema))
        return rows.withColumn(BATCH, F.lit(batch).cast("long"))

    def _deltas(self, pending: list[int], buckets: set[str]) -> DataFrame:
        out = self._read([], 0)
        for b in pending:
            here = {f.partition("=")[2] for f in self._folders(f"{self.root}/deltas/{BATCH}={b}")}
            folders = [f"{self.root}/deltas/{BATCH}={b}/{BUCKET}={x}" for x in sorted(buckets & here)]
            if folders:
                out = out.unionByName(self._read(folders, b))
        return out

    # The table

    def append(self, rows: DataFrame, batch: int) -> None:
        """Write a batch (ids from 0 on); the same id again replaces it.  A batch that is merged already is left as it is."""
        if batch <= self._state()[1]:
            return
        out = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(BUCKET, self.bucket)
        out.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/deltas/{BATCH}={batch}")

    def read(self, where: Column | None = None, before: int | None = None) -> DataFrame:
        """The merged rows; ``where`` is over the keys and is pushed into all parts.  ``before``: without the deltas from
        that batch on (a batch that runs again doesn't see its own rows)."""
        kept, upto = self._state()
        pending = [b for b in self._pending(upto) if before is None or b < before]
        touched = self._touched(pending)
        still = self._read([f for b, f in kept.items() if b not in touched], _MERGED)
        moving = self._read([f for b, f in kept.items() if b in touched], _MERGED).unionByName(self._deltas(pending, touched))
        if where is not None:
            still, moving = still.where(where), moving.where(where)
        names = self.schema.names
        return still.select(*names) if not touched else still.select(*names).unionByName(self.merge(moving, self.keys).select(*names))

    def rows(self, where: Column | None = None) -> DataFrame:
        """The rows as they lie, not merged: of a key as many as batches wrote since it was merged last."""
        kept, upto = self._state()
        pending = self._pending(upto)
        rows = self._read(list(kept.values()), _MERGED).unionByName(self._deltas(pending, self._touched(pending))).drop(BATCH)
        return rows if where is None else rows.where(where)

    def delta(self, batch: int) -> DataFrame:
        """The rows of one batch that isn't merged yet."""
        return self._deltas([batch], self._touched([batch])).drop(BATCH)

    def since(self, batch: int, column: str) -> DataFrame:
        """Rows of the batches after ``batch``, of a log whose rows carry their batch in ``column``, compacted or not."""
        kept, upto = self._state()
        rows = self._deltas(self._pending(max(upto, batch)), self._touched(self._pending(max(upto, batch)))).drop(BATCH)
        if upto > batch and kept:
            rows = rows.unionByName(self._read(list(kept.values()), _MERGED).drop(BATCH))
        return rows.where(F.col(column) > batch)

    def compact(self, forget: Callable[[str], bool] = lambda bucket: False) -> int:
        """Merge the deltas into their buckets; the number of buckets rewritten.  Buckets that ``forget`` names are dropped."""
        kept, upto = self._state()
        pending = self._pending(upto)
        if not pending:
            return 0
        touched = self._touched(pending)
        moving = self._read([kept[b] for b in sorted(touched) if b in kept], _MERGED).unionByName(self._deltas(pending, touched))
        run = f"{self.root}/base/{uuid.uuid4().hex}"
        merged = self.merge(moving, self.keys).select(*self.schema.names).withColumn(BUCKET, self.bucket)
        merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(run)
        made = {f.partition("=")[2]: f"{run}/{f}" for f in self._folders(run) if f.startswith(f"{BUCKET}=")}
        now = {b: f for b, f in ({b: f for b, f in kept.items() if b not in touched} | made).items() if not forget(b)}
        rows = [(b, f, pending[-1]) for b, f in now.items()] or [(None, None, pending[-1])]
        before = current_version(self.spark, self.root)
        version = write_version(self.spark, self.root, {
            "buckets": self.spark.createDataFrame(rows, "bucket string, folder string, upto long").coalesce(1)})
        # what the version before this one had replaced is no longer read by anyone
        for b in self.batches():
            if b <= upto:
                self._remove(f"{self.root}/deltas/{BATCH}={b}")
        named = {*now.values(), *kept.values()}
        for r in self._folders(f"{self.root}/base"):
            for f in self._folders(f"{self.root}/base/{r}"):
                if f"{self.root}/base/{r}/{f}" not in named:
                    self._remove(f"{self.root}/base/{r}/{f}")
            if not self._folders(f"{self.root}/base/{r}"):
                self._remove(f"{self.root}/base/{r}")
        for v in self._folders(self.root):
            if v.startswith("v-") and v not in (before, version):
                self._remove(f"{self.root}/{v}")
        return len(touched)
