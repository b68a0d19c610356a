"""Batch operators over DataFrames (column names are parameters)."""

from marquee.operators.collaborators import (
    collaborator_counts,
    collaborator_pairs,
    collaborator_sets,
)
from marquee.operators.credits import credit_counts, top_people
from marquee.operators.merge import merge_by_key, upsert
from marquee.operators.positions import list_lines, list_text, positions, set_text
from marquee.operators.ranking import scored_credits, top_titles, top_titles_text
from marquee.operators.ratings import update_ratings
from marquee.operators.windows import (
    sliding_top,
    trending,
    trending_flags,
    vote_log,
    window_averages,
    window_counts,
    with_names,
)

__all__ = [
    "collaborator_counts",
    "collaborator_pairs",
    "collaborator_sets",
    "credit_counts",
    "list_lines",
    "list_text",
    "merge_by_key",
    "positions",
    "scored_credits",
    "set_text",
    "sliding_top",
    "top_people",
    "top_titles",
    "top_titles_text",
    "trending",
    "trending_flags",
    "update_ratings",
    "upsert",
    "vote_log",
    "window_averages",
    "window_counts",
    "with_names",
]
