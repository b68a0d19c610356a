"""Structured Streaming forms of the vote products (event time, watermarks).

Each product is its own ``StreamingQuery`` with its own checkpoint:

* ``start_vote_log``      – tumbling windows → parquet partitioned by window label
* ``start_sliding_top``   – sliding averages (append, watermark) → top-n per window
                            (``open_windows``: stored pane sums, late votes too, read by ``read_sliding_top``)
* ``start_trending``      – tumbling counts → per-title state with event-time timers (``transformWithState``),
                            read with late votes by ``read_trending``
"""

from marquee.streaming.sources import file_vote_stream, kafka_vote_stream, text_vote_stream
from marquee.streaming.queries import (
    current_names,
    late_trending,
    late_votes,
    read_sliding_top,
    read_trending,
    start_rejects,
    start_sliding_top,
    start_trending,
    start_vote_log,
    start_vote_store,
)
from marquee.streaming.trending import TrendingProcessor

__all__ = [
    "TrendingProcessor",
    "current_names",
    "file_vote_stream",
    "kafka_vote_stream",
    "late_trending",
    "late_votes",
    "read_sliding_top",
    "read_trending",
    "start_rejects",
    "start_sliding_top",
    "start_trending",
    "start_vote_log",
    "start_vote_store",
    "text_vote_stream",
]
