"""The streaming product: vote log, sliding top 3 and trending over one vote source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marquee.constants import LOG_WINDOW, TOP_SLIDE, TOP_WINDOW, TOP_WINDOW_N, TREND_WINDOW
from marquee.streaming.queries import start_rejects, start_sliding_top, start_trending, start_vote_log


def start_vote_products(votes: DataFrame, names: DataFrame, out_root: str, checkpoint_root: str,
                        trigger: dict | None = None, log_length: str = LOG_WINDOW,
                        top_length: str = TOP_WINDOW, top_slide: str = TOP_SLIDE, top_n: int = TOP_WINDOW_N,
                        trend_length: str = TREND_WINDOW, trend_mode: str = "reset",
                        watermark: str = "10 minutes") -> dict[str, StreamingQuery]:
    """Start the four queries over one parsed vote stream (``tconst, rating, ts[, valid]``).

    Each query has its own checkpoint under ``checkpoint_root`` and output
    under ``out_root`` (``log``, ``top``, ``trending``, ``rejects``).  Returns
    the running queries by name; the caller awaits or stops them.
    """
    good = votes.where("valid") if "valid" in votes.columns else votes
    good = good.select("tconst", "rating", "ts")
    queries = {
        "log": start_vote_log(good, f"{out_root}/log", f"{checkpoint_root}/log", length=log_length,
                              trigger=trigger),
        "top": start_sliding_top(good, names, f"{out_root}/top", f"{checkpoint_root}/top",
                                 length=top_length, slide=top_slide, n=top_n, watermark=watermark,
                                 trigger=trigger),
        "trending": start_trending(good, names, f"{out_root}/trending", f"{checkpoint_root}/trending",
                                   length=trend_length, mode=trend_mode, watermark=watermark,
                                   trigger=trigger),
    }
    if "valid" in votes.columns:
        queries["rejects"] = start_rejects(votes, f"{out_root}/rejects", f"{checkpoint_root}/rejects",
                                           trigger=trigger)
    return queries
