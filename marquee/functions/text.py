"""Text encodings of lists, maps and sets, and tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.constants import LIST_SEPARATOR, LOG_LABEL_FORMAT, PAIR_SEPARATOR

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty_split(c: ColumnOrName, pattern: str = LIST_SEPARATOR) -> Column:
    """``split`` that drops empty items.

    A list written as ``a,b,`` (trailing separator) or with doubled
    separators must read back as ``[a, b]``; Spark's ``split`` keeps the
    empty strings, so they are filtered out here.
    """
    return F.filter(F.split(_col(c), pattern), lambda x: x != F.lit(""))


def parse_double(c: ColumnOrName) -> Column:
    """Text → double, NULL when the text is not a finite number (never fails)."""
    number = F.trim(_col(c)).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def render_ranked_map(arr: ColumnOrName, key: str, value: str,
                      value_format: str | None = None) -> Column:
    """Ordered ``array<struct>`` → ``{k=v, k=v}`` text, in array order.

    ``value_format`` optionally casts the value before rendering (for
    example ``"decimal(18,2)"`` for money), so the text is stable.
    """
    def item(x: Column) -> Column:
        v = x[value] if value_format is None else x[value].cast(value_format)
        return F.concat(x[key].cast("string"), F.lit("="), v.cast("string"))

    return F.concat(F.lit("{"), F.array_join(F.transform(_col(arr), item), ", "), F.lit("}"))


def render_set(arr: ColumnOrName) -> Column:
    """``array`` → ``[a, b]`` text, sorted (by the items' own type) and without duplicates."""
    items = F.transform(F.array_sort(F.array_distinct(_col(arr))), lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def decode_scored(c: ColumnOrName, sep: str = PAIR_SEPARATOR) -> Column:
    """``title#rating`` text → ``struct(item, score)`` (score NULL if not a number)."""
    parts = F.split(_col(c), sep, 2)
    return F.struct(parts.getItem(0).alias("item"),
                    parse_double(F.try_element_at(parts, F.lit(2))).alias("score"))


def encode_scored(item: ColumnOrName, score: ColumnOrName, sep: str = PAIR_SEPARATOR) -> Column:
    """``item, score`` → ``item#score`` text."""
    return F.concat_ws(sep, _col(item).cast("string"), _col(score).cast("string"))


def window_label(window_end: ColumnOrName) -> Column:
    """Label of a log window: its end as ``yyyy-MM-dd_HH_mm`` (date included)."""
    return F.date_format(_col(window_end), LOG_LABEL_FORMAT)
