"""Joins of values with closed ranges, without comparing every pair.

The axis is cut into nested blocks of 16**0, 16**1, ... 16**5 values. A range is the union
of few blocks, a value lies in one block per level, and a value is inside a range exactly
when they share one block of the range's union. So the range join is an equi-join on the
block whose output is the result itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 4
_LEVELS = 6  # the top block spans 16**5 values; wider ranges use several top blocks


def _whole_blocks(lo: Column, hi: Column, level: int) -> tuple[Column, Column]:
    """First block and end block (exclusive) of a level that lie inside [lo, hi]."""
    width = 1 << (_BITS * level)
    first = F.shiftright(lo + (width - 1), _BITS * level)
    end = F.shiftright(hi + 1, _BITS * level)
    return first, end


def _span(first: Column, end: Column) -> Column:
    nothing = F.array().cast("array<bigint>")
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(nothing)


def _at_level(blocks: Column, level: int) -> Column:
    return F.transform(blocks, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def range_blocks(lo: Column, hi: Column) -> Column:
    """The disjoint blocks that make up [lo, hi], as array<struct<level, block>>."""
    lo, hi = lo.cast("bigint"), hi.cast("bigint")
    pieces = []
    for level in range(_LEVELS):
        first, end = _whole_blocks(lo, hi, level)
        if level == _LEVELS - 1:
            blocks = _span(first, end)
        else:
            up_first, up_end = _whole_blocks(lo, hi, level + 1)
            side_by_side = F.concat(
                _span(first, F.shiftleft(up_first, _BITS)), _span(F.shiftleft(up_end, _BITS), end)
            )
            blocks = F.when(up_first < up_end, side_by_side).otherwise(_span(first, end))
        pieces.append(_at_level(blocks, level))
    return F.concat(*pieces)


def value_blocks(value: Column) -> Column:
    """The block of every level that holds the value."""
    value = value.cast("bigint")
    return F.array(
        *[
            F.struct(F.lit(level).alias("level"), F.shiftright(value, _BITS * level).alias("block"))
            for level in range(_LEVELS)
        ]
    )


def join_in_range(
    values: DataFrame, ranges: DataFrame, keys: list[str], value: str, lo: str, hi: str
) -> DataFrame:
    """Pairs of a value and a range of the same keys that holds it, each pair once."""
    left = values.select("*", F.inline(value_blocks(F.col(value))))
    right = ranges.select("*", F.inline(range_blocks(F.col(lo), F.col(hi))))
    return left.join(right, [*keys, "level", "block"]).drop("level", "block")


def assign_ranges(
    items: DataFrame,
    ranges: DataFrame,
    keys: list[str],
    value: str,
    lo: str,
    hi: str,
) -> DataFrame:
    """Every item with each range that holds its value.

    The range join runs on the distinct values only; items then meet their ranges by
    equality. A value shared by very many items makes a hot join key on the item side alone,
    which AQE splits, as the other side holds one row per range.
    """
    distinct_values = items.select(*keys, value).distinct()
    placed = join_in_range(distinct_values, ranges, keys, value, lo, hi)
    return items.join(placed, [*keys, value])
