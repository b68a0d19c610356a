"""Readers: tab-separated dumps, hand-off key–list files, vote logs, vote streams."""

from marquee.sources.tsv import (
    read_credits,
    read_key_lists,
    read_name_lookup,
    read_people,
    read_ratings,
    read_scored_lists,
    read_titles,
    read_tsv,
)
from marquee.sources.votes import (
    parse_vote_log_lines,
    parse_vote_stream_lines,
    read_vote_log,
    vote_lines,
)

__all__ = [
    "parse_vote_log_lines",
    "parse_vote_stream_lines",
    "read_credits",
    "read_key_lists",
    "read_name_lookup",
    "read_people",
    "read_ratings",
    "read_scored_lists",
    "read_titles",
    "read_tsv",
    "read_vote_log",
    "vote_lines",
]
