"""Starting the three vote streams.

All three use event time.  The vote log is stateless.  The sliding top keeps sums per title and pane in a store; it reports a
window once the watermark passes its end, or, with ``open_windows``, from its first vote on and with every late vote.  Trending reports
open windows too and keeps votes that come too late for its state apart; ``read_trending`` counts them in.
Results are written by ``foreachBatch`` under the batch's id with overwrite, so a
re-executed micro-batch replaces its own output (idempotent on restart).
A sink belongs to the checkpoint that wrote it first; empty batches write nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marquee.constants import LOG_WINDOW, TOP_SLIDE, TOP_WINDOW, TOP_WINDOW_N, TREND_WINDOW
from marquee.functions.text import window_label
from marquee.operators.ratings import known_size
from marquee.operators.windows import duration_seconds, trending_flags, window_averages, with_names
from marquee.sinks.files import claim_sink, read_current
from marquee.sinks.store import KeyedStore, latest_row, sums
from marquee.streaming.trending import LATE_BOUND_SECONDS, TrendingProcessor, gathered, window_partials, window_rows

#: Title names: a fixed frame, or a function that gives the present ones; it is asked in every micro-batch.
Names = DataFrame | Callable[[], DataFrame]

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Micro-batches between two compactions of a sink that keeps the latest rows.
COMPACT_EVERY = 20


def current_names(spark: SparkSession, root: str, part: str = "names") -> Callable[[], DataFrame]:
    """Names from the current version of ``root`` (``sinks.write_version``): a new version shows in the next micro-batch."""
    def names() -> DataFrame:
        found = read_current(spark, root, part)
        if found is None:
            raise ValueError(f"no names at {root}")
        return found
    return names


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_vote_log(votes: DataFrame, sink: str, checkpoint: str, ts: str = "ts",
                   length: str = LOG_WINDOW, trigger: dict | None = None,
                   fmt: str = "parquet", folders: str = "day") -> StreamingQuery:
    """Every vote with its window label ``w`` (stateless, append).

    ``folders="day"`` (default) writes ``<sink>/d=<yyyy-MM-dd>/`` and keeps
    ``w`` as a column (pruned by parquet statistics when one window is
    read); ``folders="window"`` writes one folder per window,
    ``<sink>/w=<label>/``, like the reference's per-window log directories —
    fine for a live stream, but a backfill over many windows then creates
    one folder per window in each task.
    """
    win = F.window(F.col(ts), length)
    logged = (
        votes.where(F.col(ts).isNotNull())
        .withColumn("_w", win)
        .withColumn("w", window_label(F.col("_w.end")))
        .drop("_w")
    )
    if folders == "day":
        logged = logged.withColumn("d", F.substring("w", 1, 10))
        part = "d"
    elif folders == "window":
        part = "w"
    else:
        raise ValueError("folders must be 'day' or 'window'")
    writer = (
        logged.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint).partitionBy(part)
    )
    return _trigger(writer, trigger).start(sink)


def start_vote_store(votes: DataFrame, store: KeyedStore, checkpoint: str, ts: str = "ts", length: str = LOG_WINDOW,
                     trigger: dict | None = None) -> StreamingQuery:
    """Every vote with its window label into ``plans.rating_store.vote_store``, a batch of the log per micro-batch.

    Rows carry the number of their batch, so what has been read from the log is told by numbers and stays true when
    the log is compacted.
    """
    claim_sink(votes.sparkSession, store.root, checkpoint)
    logged = votes.where(F.col(ts).isNotNull()).withColumn("w", window_label(F.window(F.col(ts), length)["end"]))

    def write(df: DataFrame, batch_id: int) -> None:
        store.append(df.withColumn("log_batch", F.lit(batch_id).cast("long")), batch_id)

    return _trigger(logged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), trigger).start()


# Largest number of distinct titles of one micro-batch that is broadcast to
# cut the name lookup down before the join.
BROADCAST_KEYS_MAX = 2_000_000


def _named(batch: DataFrame, names: DataFrame, title: str,
           max_keys: int = BROADCAST_KEYS_MAX) -> DataFrame:
    """Join a micro-batch result to the title names without shuffling the whole lookup.

    The batch's distinct titles are counted first (the batch is persisted by
    the caller); when there are at most ``max_keys`` of them they are
    broadcast into a semi-join that trims the lookup on the map side, so only
    the names this batch needs take part in the join.  Above the bound the
    plain join is used.
    """
    keys = batch.select(title).distinct()
    lookup = names
    if keys.count() <= max_keys:
        lookup = names.join(F.broadcast(keys), names[title] == keys[title], "left_semi")
    return with_names(batch, lookup, title, name_title=title, name="name")


def _nothing(df: DataFrame, batch_id: int) -> bool:
    """Whether a batch has no row and can be skipped; the first one is always written, for the sink's schema."""
    return batch_id > 0 and df.isEmpty()


def _batch_writer(sink: str, fmt: str = "parquet"):
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{sink}/batch={batch_id}")
    return write


def _lookup(names: Names, title: str, name_title: str, name: str) -> DataFrame:
    frame = names() if callable(names) else names
    return frame.select(F.col(name_title).alias(title), F.col(name).alias("name"))


def start_sliding_top(votes: DataFrame, names: Names, sink: str, checkpoint: str,
                      title: str = "tconst", vote: str = "rating", ts: str = "ts",
                      length: str = TOP_WINDOW, slide: str = TOP_SLIDE, n: int = TOP_WINDOW_N,
                      watermark: str = "10 minutes", trigger: dict | None = None,
                      name_title: str = "tconst", name: str = "name", panes: bool = False,
                      open_windows: bool = False, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Top ``n`` titles by average per sliding window.

    Each batch adds its votes' sums per title and ``slide``-long pane to a stored table (below the checkpoint) and ranks the
    windows whose end the watermark has passed with this batch, each once, from the panes: a vote is stored once, not
    once for each of its windows.  Votes for windows that are reported already change nothing in them.  A ``length`` that is no whole
    number of slides runs as Spark's windowed average in append mode, ranked as its windows close.

    ``panes=True`` chains two watermarked aggregations: votes are summed per
    title and ``slide``-long pane, and each closed pane (at its
    ``window_time``) feeds the sliding windows.  Same rows; worth it for
    dense streams (many votes per title and pane), where it replaces the
    per-vote window expansion by a per-pane one, at the cost of a second
    state store (on the sparse test data it is slower).

    ``open_windows=True`` reports windows from their first vote on and loses no late vote: each batch adds its votes' sums
    per title and pane to a stored table, and ranks again only the windows that those panes
    belong to.  ``read_sliding_top`` gives the ranks, ``late_votes`` how many votes came behind the watermark.  Sums and ranks are
    kept per key and day and compacted every ``compact_every`` batches, so the sink is as large as its live rows.
    """
    if panes and open_windows:
        raise ValueError("panes and open_windows exclude each other")
    claim_sink(votes.sparkSession, sink, checkpoint)
    if open_windows:
        write_batch = _open_tops(votes, names, sink, title, vote, ts, length, slide, n, watermark, name_title, name, compact_every)
        good = votes.where(F.col(ts).isNotNull() & F.col(title).isNotNull() & F.col(vote).isNotNull())
        return _trigger(good.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch), trigger).start()
    if not panes and duration_seconds(length) % duration_seconds(slide) == 0:
        good = votes.where(F.col(ts).isNotNull() & F.col(title).isNotNull() & F.col(vote).isNotNull())
        write_batch = _closed_tops(good, names, sink, f"{checkpoint}/marquee", title, vote, ts, length, slide, n, watermark, name_title, name, compact_every)
        return _trigger(good.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch), trigger).start()
    if panes:
        avgs = _pane_stream_averages(votes.withWatermark(ts, watermark), title, vote, ts, length, slide)
    else:
        avgs = window_averages(votes.withWatermark(ts, watermark), title, vote, ts, length, slide, panes=False)
    write = _batch_writer(sink)

    def rank(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if not _nothing(df, batch_id):
                write(_ranked(_named(df, _lookup(names, title, name_title, name), title), title, n), batch_id)
        finally:
            df.unpersist()

    writer = avgs.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(rank)
    return _trigger(writer, trigger).start()


def _ranked(named: DataFrame, title: str, n: int) -> DataFrame:
    w = Window.partitionBy("window_start", "window_end").orderBy(F.desc("average"), F.asc(title))
    return (named.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(n))
            .select("window_start", "window_end", "rank", title, "name", "average"))


def _top_store(spark: SparkSession, sink: str, title: T.StructField) -> KeyedStore:
    schema = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
                           T.StructField("rank", T.IntegerType()), title, T.StructField("name", T.StringType()),
                           T.StructField("average", T.DoubleType())])
    return KeyedStore(spark, f"{sink}/top", schema, ["window_start", "rank"], latest_row, F.date_format("window_start", "yyyy-MM-dd"))


def _arrivals(spark: SparkSession, sink: str) -> KeyedStore:
    """One row: the latest vote time (in µs), the votes and the late votes so far."""
    return KeyedStore(spark, f"{sink}/arrivals", "one int, latest long, votes long, late long", ["one"], latest_row, buckets=1)


# Rows of one task that sums or ranks panes, about: the number of tasks follows the rows, not the session's setting.
TASK_ROWS = 1_000_000
_SPREAD = 16  # tasks that share the votes of one title and pane


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _pane_store(spark: SparkSession, root: str, title: T.StructField) -> KeyedStore:
    schema = T.StructType([title, T.StructField("pane", T.TimestampType()), T.StructField("total", T.DoubleType()), T.StructField("count", T.LongType())])
    return KeyedStore(spark, root, schema, [title.name, "pane"], sums, F.date_format("pane", "yyyy-MM-dd"))


def _pane_sums(df: DataFrame, rows: int, title: str, vote: str, ts: str, slide: str) -> DataFrame:
    """``title, pane, total, count`` of ``rows`` votes; several rows where a title has several votes in a pane (the store adds them up)."""
    spread = F.pmod(F.xxhash64(ts, vote), F.lit(_SPREAD))
    dealt = df.select(title, F.window(F.col(ts), slide)["start"].alias("pane"), F.col(vote).cast("double").alias("total"), spread.alias("_s"))
    keys = [title, "pane", "_s"]
    return dealt.repartition(_tasks(rows), *keys).groupBy(*keys).agg(F.sum("total").alias("total"), F.count("total").alias("count")).drop("_s")


def _of_windows(df: DataFrame, size: int, step: int) -> DataFrame:
    """Every row with a ``pane`` once for each window that it belongs to, as ``window_start``."""
    offsets = F.explode(F.sequence(F.lit(0), F.lit(size // step - 1)))
    return df.withColumn("_k", offsets).withColumn("window_start", F.col("pane") - F.expr(f"make_dt_interval(0, 0, 0, {step})") * F.col("_k")).drop("_k")


def _pane_tops(panes: DataFrame, lookup: DataFrame, windows: Callable[[DataFrame], DataFrame], title: str, n: int, size: int, step: int) -> DataFrame:
    """The ranks of the ``windows`` (a filter on ``window_start``) from stored pane sums.

    The panes are dealt by title, so names, window sums and the first cut of the ranks need no other shuffle.
    """
    tasks = _tasks(panes.count() * (size // step))
    named = with_names(panes.repartition(tasks, title), lookup.repartition(tasks, title), title, title, "name")
    avgs = (windows(_of_windows(named, size, step)).groupBy("window_start", title, "name")
            .agg((F.sum("total") / F.sum("count")).alias("average"))
            .withColumn("window_end", F.col("window_start") + F.expr(f"make_dt_interval(0, 0, 0, {size})")))
    return _ranked(avgs, title, n)


def _closed_tops(votes, names, sink, state, title, vote, ts, length, slide, n, watermark, name_title, name, compact_every):
    size, step, delay = duration_seconds(length), duration_seconds(slide), duration_seconds(watermark)
    spark, kind = votes.sparkSession, votes.schema[title]
    panes = _pane_store(spark, f"{state}/panes", kind)
    # one row per batch, so a batch that runs again finds the time that the ones before it had reached
    marks = KeyedStore(spark, f"{state}/marks", "mark long, latest long", ["mark"], latest_row, buckets=1)
    put = _batch_writer(sink)

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if _nothing(df, batch_id):
                return
            here = df.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("latest"), F.count(F.lit(1)).alias("votes")).first()
            panes.append(_pane_sums(df, here["votes"], title, vote, ts, slide), batch_id)
            before = marks.read().where(F.col("mark") < batch_id).agg(F.max("latest")).first()[0]
            latest = max((x for x in (before, here["latest"]) if x is not None), default=None)
            marks.append(spark.createDataFrame([(batch_id, latest)], marks.schema), batch_id)
            # windows whose end is in (low, high]
            low, high = (None if x is None else x - delay * 1_000_000 for x in (before, latest))
            at, end = F.unix_micros("pane"), F.unix_micros("window_start") + size * 1_000_000
            some = F.lit(high is not None) & (at < F.lit(high or 0)) & (F.lit(True) if low is None else at > low - size * 1_000_000)
            closed = lambda w: w.where((end <= F.lit(high or 0)) & (F.lit(True) if low is None else end > low))
            put(_pane_tops(panes.rows(some), _lookup(names, title, name_title, name), closed, title, n, size, step), batch_id)
            if (batch_id + 1) % compact_every == 0:
                # panes of days before all windows still open are read no more
                day = "" if high is None else (_EPOCH + timedelta(microseconds=high, seconds=-size, days=-1)).strftime("%Y-%m-%d")
                panes.compact(forget=lambda bucket: bucket < day)
                marks.compact()
        finally:
            df.unpersist()

    return write


def _open_tops(votes, names, sink, title, vote, ts, length, slide, n, watermark, name_title, name, compact_every):
    size, step, delay = duration_seconds(length), duration_seconds(slide), duration_seconds(watermark)
    if size % step:
        raise ValueError("open windows need a length of whole slides")
    spark, kind = votes.sparkSession, votes.schema[title]
    sums_store = _pane_store(spark, f"{sink}/panes", kind)
    tops, arrivals = _top_store(spark, sink, kind), _arrivals(spark, sink)

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if _nothing(df, batch_id):
                return
            before = arrivals.read(before=batch_id).first()
            latest, seen, late = (before["latest"], before["votes"], before["late"]) if before else (None, 0, 0)
            at = F.unix_micros(F.col(ts).cast("timestamp"))
            is_late = F.lit(False) if latest is None else at < latest - delay * 1_000_000
            here = df.agg(F.max(at).alias("latest"), F.count(F.lit(1)).alias("votes"), F.count_if(is_late).alias("late")).first()
            sums_store.append(_pane_sums(df, here["votes"], title, vote, ts, slide), batch_id)
            latest = max(filter(None, (latest, here["latest"])), default=None)
            arrivals.append(spark.createDataFrame([(1, latest, seen + here["votes"], late + here["late"])], arrivals.schema), batch_id)
            own = df.select(F.window(F.col(ts), slide)["start"].alias("pane")).distinct()
            touched = _of_windows(own, size, step).select("window_start").distinct()
            start = F.unix_micros("window_start")
            span = touched.agg(F.min(start).alias("lo"), F.max(start).alias("hi")).first()
            inside = F.col("pane").between(*(F.timestamp_micros(F.lit(x)) for x in (span["lo"], (span["hi"] or 0) + size * 1_000_000 - 1)))
            if span["lo"] is not None:
                # one row per window, so the windows of a batch are as many as its time has slides
                touched = known_size(touched)
                changed = lambda w: w.join(touched, "window_start", "left_semi")
                tops.append(_pane_tops(sums_store.rows(inside), _lookup(names, title, name_title, name), changed, title, n, size, step), batch_id)
            if (batch_id + 1) % compact_every == 0:
                for store in (sums_store, tops, arrivals):
                    store.compact()
        finally:
            df.unpersist()

    return write


def read_sliding_top(spark: SparkSession, sink: str, title: T.StructField | str = "tconst long") -> DataFrame:
    """Top titles per window, open ones too, from the sink of ``start_sliding_top(open_windows=True)``; ``title``: its field."""
    field = T._parse_datatype_string(title).fields[0] if isinstance(title, str) else title
    return _top_store(spark, sink, field).read()


def late_votes(spark: SparkSession, sink: str) -> int:
    """Votes that came behind the watermark, of the sink of ``start_sliding_top(open_windows=True)``."""
    row = _arrivals(spark, sink).read().first()
    return row["late"] if row else 0


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def _require_rocksdb(spark) -> None:
    """``transformWithState`` keeps its state in column families, which only the
    RocksDB state store offers; switch the session to it when another
    provider is configured (the provider is fixed per query at first start)."""
    if spark.conf.get(PROVIDER_CONF, None) != ROCKSDB_PROVIDER:
        spark.conf.set(PROVIDER_CONF, ROCKSDB_PROVIDER)


def _pane_stream_averages(votes: DataFrame, title: str, vote: str, ts: str, length: str,
                          slide: str) -> DataFrame:
    sums = (votes.where(F.col(ts).isNotNull() & F.col(title).isNotNull() & F.col(vote).isNotNull())
            .groupBy(F.window(F.col(ts), slide).alias("_pane"), F.col(title))
            .agg(F.sum(vote).alias("_s"), F.count(vote).alias("_c")))
    return (
        sums.groupBy(F.window(F.window_time("_pane"), length, slide).alias("_w"), F.col(title))
        .agg((F.sum("_s") / F.sum("_c")).alias("average"), F.sum("_c").alias("votes"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                title, "average", "votes")
    )


def start_trending(votes: DataFrame, names: Names, sink: str, checkpoint: str,
                   title: str = "tconst", ts: str = "ts", length: str = TREND_WINDOW,
                   mode: str = "reset", watermark: str = "15 minutes",
                   trigger: dict | None = None, state_ttl_ms: int | None = None,
                   name_title: str = "tconst", name: str = "name", compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Trending titles: counts per title and window in keyed state, judged from the first vote on, closed by timers.

    State is a title's open windows and the outcome of its last closed one (RocksDB store); ``state_ttl_ms``
    (event time) forgets titles without recent votes.  The sink keeps the latest row per title and window;
    votes for windows that the state has gone past are kept as late rows.  ``read_trending`` gives the reported windows.
    """
    _require_rocksdb(votes.sparkSession)
    seconds = duration_seconds(length)
    partials = window_partials(votes, title, ts, seconds).withWatermark("seen", f"{LATE_BOUND_SECONDS} seconds")
    kind = votes.schema[title]
    rows = T.StructType([T.StructField(title, kind.dataType), T.StructField("starts", T.ArrayType(T.LongType())),
                         T.StructField("votes", T.ArrayType(T.LongType())), T.StructField("live", T.ArrayType(T.BooleanType())),
                         T.StructField("kind", T.StringType())])
    judged = gathered(partials, title).groupBy(title).transformWithState(
        statefulProcessor=TrendingProcessor(title, seconds, duration_seconds(watermark), mode, state_ttl_ms),
        outputStructType=rows, outputMode="Update", timeMode="EventTime")
    claim_sink(votes.sparkSession, sink, checkpoint)
    store = _trending_store(votes.sparkSession, sink, kind)
    late = _late_store(votes.sparkSession, sink, kind)

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if _nothing(df, batch_id):
                return
            named = _named(df, _lookup(names, title, name_title, name), title).persist()
            # a window that was changed and closed in one batch has two rows; the closed one is the last
            last = (named.where("kind <> 'late'").groupBy(title, "window_start")
                    .agg(F.max_by(F.struct("window_end", "name", "votes", "live"), F.struct(F.col("kind") == "closed", "votes")).alias("_r")))
            store.append(last.select(title, "window_start", "_r.*"), batch_id)
            late.append(named.where("kind = 'late'").select(title, "window_start", "votes"), batch_id)
            named.unpersist()
            if (batch_id + 1) % compact_every == 0:
                store.compact()
                late.compact()
        finally:
            df.unpersist()

    writer = window_rows(judged, title, seconds).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, trigger).start()


def _trending_store(spark: SparkSession, sink: str, title: T.StructField) -> KeyedStore:
    schema = T.StructType([title, T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
                           T.StructField("name", T.StringType()), T.StructField("votes", T.LongType()), T.StructField("live", T.BooleanType())])
    return KeyedStore(spark, f"{sink}/windows", schema, [title.name, "window_start"], latest_row, F.date_format("window_start", "yyyy-MM-dd"))


def _late_store(spark: SparkSession, sink: str, title: T.StructField) -> KeyedStore:
    schema = T.StructType([title, T.StructField("window_start", T.TimestampType()), T.StructField("votes", T.LongType())])
    return KeyedStore(spark, f"{sink}/late", schema, [title.name, "window_start"], sums, F.date_format("window_start", "yyyy-MM-dd"))


def late_trending(spark: SparkSession, sink: str, title: T.StructField | str = "tconst long") -> DataFrame:
    """``title, window_start, votes``: votes that came after their window had left the state of ``start_trending``."""
    return _late_store(spark, sink, T._parse_datatype_string(title).fields[0] if isinstance(title, str) else title).read()


def read_trending(spark: SparkSession, sink: str, title: T.StructField | str = "tconst long", length: str = TREND_WINDOW,
                  mode: str = "reset") -> DataFrame:
    """``window_start, window_end, title, name, votes``: the reported windows of ``start_trending``, open ones too.

    Late votes are counted in: only the titles that have any are judged again, over their stored windows;
    the rows of all others are taken as the stream left them.
    """
    field = T._parse_datatype_string(title).fields[0] if isinstance(title, str) else title
    key, out = field.name, ["window_start", "window_end", field.name, "name", "votes"]
    stored, late = _trending_store(spark, sink, field).read(), late_trending(spark, sink, field)
    titles = late.select(key).distinct()
    touched = stored.join(titles, key, "left_semi")
    names = touched.groupBy(key).agg(F.max_by("name", "window_start").alias("_name"))
    added = (late.join(names, key).withColumnRenamed("votes", "_more"))
    end = F.col("window_start") + F.expr(f"make_dt_interval(0, 0, 0, {duration_seconds(length)})")
    counts = touched.drop("live").join(added, [key, "window_start"], "full").select(
        key, "window_start", end.alias("window_end"), F.coalesce("name", "_name").alias("name"),
        (F.coalesce("votes", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("votes"))
    again = trending_flags(counts, key, mode).where("live").select(*out)
    return stored.join(titles, key, "left_anti").where("live").select(*out).unionByName(again)


def start_rejects(votes: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
                  fmt: str = "parquet") -> StreamingQuery:
    """Vote lines that did not parse (``valid = false``), appended to ``sink``.

    Run next to the product streams over the same parsed source, so bad
    input is kept for inspection instead of failing or vanishing.
    """
    bad = votes.where(~F.col("valid"))
    writer = bad.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start(sink)
