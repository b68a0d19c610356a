"""Row predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.constants import PERFORMER_WORDS

# Credit categories that count as acting roles (a substring test, so
# "voice_actor" passes as well).


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """True when the text contains any of ``words``; NULL text → NULL (no row).

    Written as a plain OR of ``contains`` so the parquet reader receives it
    as a pushed ``StringContains`` filter.
    """
    col = F.col(c) if isinstance(c, str) else c
    conds = [col.contains(w) for w in words]
    cond = conds[0]
    for extra in conds[1:]:
        cond = cond | extra
    return cond


def is_performer(category: Column | str = "category") -> Column:
    return contains_any(category, PERFORMER_WORDS)
