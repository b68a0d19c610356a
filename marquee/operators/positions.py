"""Key → numbered items, one row per item, at any size of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.sinks.files import scratch_table

REPEAT_BLOCK = 10_000


def repeat_rows(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row ``times`` times, with ``index`` 0, 1, … instead of ``times``; no array is longer than a block."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / REPEAT_BLOCK).cast("long"))
    within = F.sequence(F.col("_block") * REPEAT_BLOCK, F.least((F.col("_block") + 1) * REPEAT_BLOCK, F.col(times).cast("long")) - 1)
    out = df.where(F.col(times) > 0).withColumn("_block", F.explode(blocks)).withColumn("_index", F.explode(within))
    return out.drop("_block", times).withColumnRenamed("_index", index)


def range_numbered(df: DataFrame, *order: str, name: str = "numbered") -> DataFrame:
    """``df`` as a stored table, dealt and sorted by ranges of ``order``, with a growing ``_n`` per row.

    ``_n`` is the number of the row's range shifted by 33 bits, plus its place in the range.  The ranges are sampled from
    the rows, so a hot value of the first column is cut by the next ones.  The table is written because a second
    evaluation could cut elsewhere.
    """
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch_table(sorted_ranges.withColumn("_n", F.monotonically_increasing_id()), name)


def positions(df: DataFrame, key: str, item: str, distinct: bool = False, heavy_size: int = 100_000,
              most: DataFrame | None = None) -> DataFrame:
    """``key, pos, item, n_items``: every item of a key with its place (1, 2, …) in the item order.

    One shape at every size.  Repeated items take neighbouring places; ``distinct`` leaves one of them.  A NULL item adds
    nothing but keeps its key: a key without items is one row ``(key, NULL, NULL, 0)``.  NULL keys are left out.

    A key of at most ``heavy_size`` items is numbered by a window.  Larger keys are ranked by ranges: their
    items are counted, dealt by ranges of (key, item) over all tasks, numbered inside their range, and the counts
    of a key's earlier ranges are added (prefix sums over one row per key and range).  So no task holds
    more of a hot key than a range, and a hot pair is counted before it is dealt.

    ``most`` (``key, _most``: every key, with no fewer than its items) spares counting the items of costly rows beforehand: keys
    are larger by it, and all others take one window over the rows, evaluated once.
    """
    pairs = df.select(F.col(key), F.col(item)).where(F.col(key).isNotNull())
    if most is not None:
        large = most.where(F.col("_most") > heavy_size).select(key)
        if large.isEmpty():
            return _by_window(pairs, key, item, distinct)
        large = scratch_table(large, "heavy-keys")
        pairs, rest = pairs.join(large, key, "left_semi"), pairs.join(large, key, "left_anti")
        return _by_window(rest, key, item, distinct).unionByName(positions(pairs, key, item, distinct, heavy_size))
    sizes = pairs.groupBy(key).agg(F.count(F.col(item)).alias("n_items"))
    without = sizes.where("n_items = 0").select(
        key, F.lit(None).cast("long").alias("pos"), F.lit(None).cast(pairs.schema[item].dataType).alias(item), "n_items")
    heavy = sizes.where(F.col("n_items") > heavy_size).select(key)
    items = pairs.where(F.col(item).isNotNull())
    if heavy.isEmpty():
        return _by_window(items, key, item, distinct).unionByName(without)
    heavy = scratch_table(heavy, "heavy-keys")
    return (_by_window(items.join(heavy, key, "left_anti"), key, item, distinct)
            .unionByName(_by_ranges(items.join(heavy, key, "left_semi"), key, item, distinct)).unionByName(without))


def _by_window(items: DataFrame, key: str, item: str, distinct: bool) -> DataFrame:
    rows = items.distinct() if distinct else items
    per_key = Window.partitionBy(key)
    placed = rows.select(key, F.row_number().over(per_key.orderBy(F.asc_nulls_last(item))).cast("long").alias("pos"), item,
                         F.count(item).over(per_key).alias("n_items"))
    # of NULL items one row stays, without a place, where a key has no others
    kept = placed.where(F.col(item).isNotNull() | ((F.col("n_items") == 0) & (F.col("pos") == 1)))
    return kept.select(key, F.when(F.col(item).isNotNull(), F.col("pos")).alias("pos"), item, "n_items")


def _by_ranges(items: DataFrame, key: str, item: str, distinct: bool) -> DataFrame:
    if distinct:
        rows = items.distinct().withColumn("_copy", F.lit(0).cast("long"))
    else:
        rows = repeat_rows(items.groupBy(key, item).agg(F.count(F.lit(1)).alias("_times")), "_times", "_copy")
    table = range_numbered(rows, key, item, "_copy", name="positions").withColumn("_range", F.shiftright("_n", 33))
    ranges = table.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_n").alias("_first"))
    per_key = Window.partitionBy(key)
    before = F.sum("_rows").over(per_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranges.select(key, "_range", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_offset"),
                            F.sum("_rows").over(per_key).alias("n_items"))
    return table.join(offsets, [key, "_range"]).select(key, (F.col("_n") + F.col("_offset")).alias("pos"), item, "n_items")


def _at_most(max_items: int) -> Column:
    """True, or an error for a key that has more items."""
    said = F.format_string(f"a key has %d items; a text holds at most {max_items}: use the rows of positions", F.col("n_items"))
    return F.when(F.col("n_items") > max_items, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))


def _joined(rows: DataFrame, key: str, item: str, max_items: int, sep: str) -> DataFrame:
    """``key, _text``: the items in their order; checked before the rows are collected."""
    listed = rows.where(_at_most(max_items)).groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", F.col(item).cast("string").alias("text"))))).alias("_items"))
    return listed.select(key, F.array_join(F.transform("_items", lambda x: x["text"]), sep).alias("_text"))


def list_text(rows: DataFrame, key: str, item: str, sep: str = ",", max_items: int = 1_000_000) -> DataFrame:
    """Rows of ``positions`` → ``key, list_text``.  A key with more than ``max_items`` items is an error, not a shorter text."""
    return _joined(rows, key, item, max_items, sep).withColumnRenamed("_text", "list_text")


def set_text(rows: DataFrame, key: str, item: str, max_items: int = 1_000_000) -> DataFrame:
    """Rows of ``positions`` → ``key, set_text`` (``[a, b]``; ``[]`` without items), with the same limit."""
    return _joined(rows, key, item, max_items, ", ").select(key, F.concat(F.lit("["), "_text", F.lit("]")).alias("set_text"))


def list_lines(rows: DataFrame, key: str, item: str, line_items: int = 1000) -> DataFrame:
    """Rows of ``positions`` → ``key, line, items``: hand-off lines of at most ``line_items`` items, in order.

    A key without items has one line with an empty list.
    """
    line = F.coalesce(F.floor((F.col("pos") - 1) / line_items), F.lit(0)).cast("long")
    listed = rows.groupBy(key, line.alias("line")).agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", item)))).alias("_items"))
    return listed.select(key, "line", F.transform("_items", lambda x: x[item]).alias("items"))
