"""Event-time vote windows (batch forms; the streams reuse these builders).

Windows are aligned to the epoch (``F.window``), not to the start of a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import LOG_WINDOW, TOP_SLIDE, TOP_WINDOW, TOP_WINDOW_N, TREND_WINDOW
from marquee.functions.text import window_label


def _valid(votes: DataFrame, cols: list[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return votes.where(cond)


def _window(ts: str, length: str, slide: str | None = None, start_time: str | None = None) -> Column:
    """``F.window`` aligned to the epoch, shifted by ``start_time`` if given."""
    if start_time:
        return F.window(F.col(ts), length, slide or length, start_time)
    return F.window(F.col(ts), length, slide) if slide else F.window(F.col(ts), length)


def vote_log(votes: DataFrame, ts: str = "ts", length: str = LOG_WINDOW,
             start_time: str | None = None) -> DataFrame:
    """Each vote with its tumbling log window: ``w, window_start, window_end, …votes``.

    ``w`` labels the window by its end, ``yyyy-MM-dd_HH_mm`` — the folder name
    of the log (the date is part of it, so day two does not collide).
    """
    win = _window(ts, length, None, start_time)
    return (
        _valid(votes, [ts])
        .withColumn("_w", win)
        .select(window_label(F.col("_w.end")).alias("w"),
                F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                *[c for c in votes.columns])
    )


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """``"10 minutes"`` → 600 (units: second, minute, hour, day, week; plural allowed)."""
    number, unit = text.strip().split()
    return int(number) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def window_averages(votes: DataFrame, title: str = "tconst", vote: str = "rating",
                    ts: str = "ts", length: str = TOP_WINDOW,
                    slide: str | None = TOP_SLIDE, start_time: str | None = None,
                    panes: bool = True) -> DataFrame:
    """``window_start, window_end, title, average, votes`` per (window, title).

    Sliding windows expand each vote into ``length / slide`` windows on the
    map side, before the partial average, so only one partial row per
    (window, title, map task) is shuffled.  ``panes=True`` (default for
    batch) first sums the votes of each title per ``slide``-long pane and
    expands the panes instead of the votes — far fewer rows to expand when
    titles get many votes per pane; lengths that are no whole number of
    slides, and other units, take the direct form.  Streams use ``panes=False``: the
    watermarked aggregation must group on the window itself.
    """
    if panes and slide and slide != length and _panes_fit(length, slide):
        return _pane_averages(votes, title, vote, ts, length, slide, start_time)
    win = _window(ts, length, slide, start_time)
    return (
        _valid(votes, [ts, title, vote])
        .groupBy(win.alias("_w"), F.col(title))
        .agg(F.avg(vote).alias("average"), F.count(vote).alias("votes"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                title, "average", "votes")
    )


def _panes_fit(length: str, slide: str) -> bool:
    try:
        return duration_seconds(length) % duration_seconds(slide) == 0
    except (KeyError, ValueError):  # other units, or several of them
        return False


def _pane_averages(votes, title, vote, ts, length, slide, start_time):
    size, step = duration_seconds(length), duration_seconds(slide)
    per = size // step
    pane = _window(ts, slide, None, start_time)
    sums = (
        _valid(votes, [ts, title, vote])
        .groupBy(pane.alias("_p"), F.col(title))
        .agg(F.sum(vote).alias("_s"), F.count(vote).alias("_c"))
    )
    shift = F.expr(f"make_dt_interval(0, 0, 0, {step})")
    expanded = (
        sums.select(title, "_s", "_c", F.col("_p.start").alias("_ps"),
                    F.explode(F.sequence(F.lit(0), F.lit(per - 1))).alias("_i"))
        .select(title, "_s", "_c", (F.col("_ps") - shift * F.col("_i")).alias("window_start"))
    )
    return (
        expanded.groupBy("window_start", title)
        .agg((F.sum("_s") / F.sum("_c")).alias("average"), F.sum("_c").alias("votes"))
        .select("window_start",
                (F.col("window_start") + F.expr(f"make_dt_interval(0, 0, 0, {size})")).alias("window_end"),
                title, "average", "votes")
    )


def with_names(df: DataFrame, names: DataFrame, title: str = "tconst",
               name_title: str = "tconst", name: str = "name") -> DataFrame:
    """Inner join to the title-name lookup (unknown titles drop out).

    No broadcast hint: the planner broadcasts the lookup when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    otherwise, so a name table that grows with the data stays safe.
    """
    lookup = names.select(F.col(name_title).alias(title), F.col(name).alias("name"))
    return df.join(lookup, title, "inner")


def sliding_top(votes: DataFrame, names: DataFrame, title: str = "tconst",
                vote: str = "rating", ts: str = "ts", length: str = TOP_WINDOW,
                slide: str = TOP_SLIDE, n: int = TOP_WINDOW_N, name_title: str = "tconst",
                name: str = "name", start_time: str | None = None, panes: bool = True) -> DataFrame:
    """``window_start, window_end, rank, title, name, average``: best ``n`` per window.

    Order: average descending, then title id.  Titles without a name are
    not ranked (joined before ranking, as the reference does).  The rank
    filter becomes a per-partition group limit ahead of the shuffle.
    """
    avgs = with_names(window_averages(votes, title, vote, ts, length, slide, start_time, panes),
                      names, title, name_title, name)
    w = Window.partitionBy("window_start", "window_end").orderBy(F.desc("average"), F.asc(title))
    return (
        avgs.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= F.lit(n))
        .select("window_start", "window_end", "rank", title, "name", "average")
    )


def window_counts(votes: DataFrame, title: str = "tconst", ts: str = "ts",
                  length: str = TREND_WINDOW, start_time: str | None = None) -> DataFrame:
    """``window_start, window_end, title, votes``: votes per tumbling window."""
    return (
        _valid(votes, [ts, title])
        .groupBy(_window(ts, length, None, start_time).alias("_w"), F.col(title))
        .agg(F.count(F.lit(1)).alias("votes"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                title, "votes")
    )


def trending_flags(counts: DataFrame, title: str = "tconst", mode: str = "reset") -> DataFrame:
    """Add ``live`` (the window is reported) to per-window counts of each title.

    ``reset`` (the reference): a title is compared with its state, which is
    the count of its previous *voted* window if that one was reported and 0
    otherwise — so after a window that does not grow, the next voted window
    is reported again.  With ``d = votes <= previous votes`` (false for the
    first window), rows inside a run of ``d`` alternate silent, reported,
    silent, …; hence: island = running count of ``not d``, position =
    running count of ``d`` in the island, reported iff position is even.

    ``growth``: reported iff votes exceed those of the immediately preceding
    calendar window (0 when that window had none).

    Each title's group has one row per window it was voted in — bounded by
    the time span, not by the number of votes.
    """
    w = Window.partitionBy(title).orderBy("window_start")
    if mode == "reset":
        prev = F.lag("votes").over(w)
        d = F.when(prev.isNotNull() & (F.col("votes") <= prev), 1).otherwise(0)
        running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        flagged = counts.withColumn("_d", d).withColumn("_island", F.sum(1 - F.col("_d")).over(running))
        wi = (Window.partitionBy(title, "_island").orderBy("window_start")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        flagged = flagged.withColumn("_pos", F.sum("_d").over(wi))
        return flagged.withColumn("live", F.col("_pos") % 2 == 0).drop("_d", "_island", "_pos")
    if mode == "growth":
        prev_votes = F.lag("votes").over(w)
        prev_end = F.lag("window_end").over(w)
        prev = F.when(prev_end == F.col("window_start"), prev_votes).otherwise(F.lit(0))
        return counts.withColumn("live", F.col("votes") > prev)
    raise ValueError(f"unknown trending mode {mode!r}; use 'reset' or 'growth'")


def trending(votes: DataFrame, names: DataFrame, title: str = "tconst", ts: str = "ts",
             length: str = TREND_WINDOW, mode: str = "reset", name_title: str = "tconst",
             name: str = "name", start_time: str | None = None) -> DataFrame:
    """``window_start, window_end, title, name, votes``: the reported (trending) windows."""
    counts = window_counts(votes, title, ts, length, start_time)
    live = trending_flags(counts, title, mode).where(F.col("live")).drop("live")
    return with_names(live, names, title, name_title, name).select(
        "window_start", "window_end", title, "name", "votes")
