"""Column-expression helpers: everything here stays JVM-side (no Python UDFs)."""

from marquee.functions.numeric import round_tenth_even, running_mean
from marquee.functions.predicates import contains_any, is_performer
from marquee.functions.text import (
    decode_scored,
    encode_scored,
    nonempty_split,
    parse_double,
    render_ranked_map,
    render_set,
    window_label,
)

__all__ = [
    "contains_any",
    "decode_scored",
    "encode_scored",
    "is_performer",
    "nonempty_split",
    "parse_double",
    "render_ranked_map",
    "render_set",
    "round_tenth_even",
    "running_mean",
    "window_label",
]
