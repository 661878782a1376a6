"""Spans of days met by days through an index: equal keys instead of a comparison of every span with every day.

Days are numbered from a first one. A block of level l is 2 ** l days that begin at a multiple of it. A span is the union of
at most two blocks a level (of any other block in it, the block above is in it too), and a day lies in one block of each level, so a
span and a day in it have exactly one block in common. A join of equal blocks therefore gives each meeting once, and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blocks of a level; levels are numbered above it.
_LEVEL = 1 << 40


def levels(days: int) -> int:
    """Levels that spans among so many days use."""
    return max(1, days).bit_length()


def blocks_of_span(low: Column, high: Column, n_levels: int) -> Column:
    """Keys of the blocks whose union are the days low to high (both included, numbers from 0)."""
    keys = []
    for level in range(n_levels):
        first = F.shiftright(low.cast("long") + ((1 << level) - 1), level)
        last = F.shiftright(high.cast("long") + 1, level) - 1
        fits = first <= last
        # the block above reaches over the span's beginning, or over its end
        keys.append(F.when(fits & (first % 2 == 1), first + level * _LEVEL))
        keys.append(F.when(fits & (last % 2 == 0), last + level * _LEVEL))
    return F.array_compact(F.array(*keys))


def blocks_of_day(day: Column, n_levels: int) -> Column:
    """Keys of the blocks that hold the day."""
    return F.array(*[F.shiftright(day.cast("long"), level) + level * _LEVEL for level in range(n_levels)])
