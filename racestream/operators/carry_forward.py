"""Last value seen so far within a key, in a given order, whatever the size of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racestream.session import written

# A key up to this many rows is ordered by a single task.
MAX_GROUP_ROWS = 4_000_000

# A range is cut into at most so many at once. What is kept of a range, and searched for a row of it, ends here too.
MAX_WAYS = 64

_SLICE = "_slice"
_RANK = "_rank"
_BOUNDS = "_bounds"
_ROWS = "_rows"
_LAST = "_last"
_HEAD = "_head"


def carry_forward(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    result: str,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    cut: str | None = None,
) -> DataFrame:
    """Adds ``result``: the latest non-null ``value`` at or before each row, among rows of equal ``keys``.

    ``order`` must be unique within a key. A key is ordered by one task with a plain window, unless it has
    more than ``max_group_rows`` rows. Such keys are cut into ranges of the column ``cut``, many tasks each,
    and large ranges again; the ranges then hand their last value on. Both ways are exact and give the same rows. ``cut`` must never fall along
    ``order``, nulls first; by default it is the first column of that. Rows of equal ``cut`` stay together.

    The sizes of the keys are counted first, in an aggregation that reads the key columns only;
    ``max_group_rows=None`` skips the count, for callers who know that their keys are small.
    """
    if max_group_rows is None:
        return _within(rows, keys, order, value, result)
    # At most total / max_group_rows keys are crowded; Spark broadcasts the table if it is small.
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    crowded = written(counts.where(F.col("rows") > max_group_rows), "crowded-keys")
    largest = crowded.agg(F.max("rows")).first()[0]
    if largest is None:
        return _within(rows, keys, order, value, result)

    named = [F.col(k).alias(f"_crowded_{k}") for k in keys]
    is_crowded = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_crowded_{k}")) for k in keys])
    others = _within(rows.join(crowded.select(*named), is_crowded, "left_anti"), keys, order, value, result)

    in_crowded = rows.join(crowded.select(*named), is_crowded, "left_semi")
    sliced = _sliced(in_crowded, keys, cut or order[0], largest, max_group_rows)
    return others.unionByName(_across_slices(sliced, keys, order, value, result))


def _sliced(rows: DataFrame, keys: Sequence[str], cut: str, largest: int, max_group_rows: int) -> DataFrame:
    """Adds the slice of each row, a number that rises along ``cut`` within a key; a slice has about ``max_group_rows`` rows at most.

    Ranges with more rows are cut near their quantiles, as often as it takes to bring a key of ``largest`` rows below the limit.
    A row's slice follows from the bounds alone, so no copy has to pin it.
    """
    slices = ceil(largest / max_group_rows) + 1
    rounds = next(n for n in count(1) if MAX_WAYS**n >= slices)
    ways = next(n for n in count(2) if n**rounds >= slices)
    shares = [i / ways for i in range(1, ways)]
    rank = F.unix_micros(cut) if rows.schema[cut].dataType.typeName() == "timestamp" else F.col(cut)
    sliced = rows.withColumns({_RANK: rank.cast("bigint"), _SLICE: F.lit(0).cast("bigint")})
    group = (*keys, _SLICE)
    named = [F.col(c).alias(f"_of_{c}") for c in group]
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group])
    for _ in range(rounds):
        quantiles = F.percentile_approx(_RANK, shares, 10 * ways).alias(_BOUNDS)
        ranges = sliced.groupBy(*group).agg(F.count(F.lit(1)).alias(_ROWS), F.max(_RANK).alias(_LAST), quantiles)
        # Nothing lies beyond the last value, so rows of one value have no bounds and stay together.
        bounds = F.array_distinct(F.filter(_BOUNDS, lambda b: b < F.col(_LAST))).alias(_BOUNDS)
        ranges = ranges.where(F.col(_ROWS) > max_group_rows).select(*group, bounds).where(F.size(_BOUNDS) > 0)
        ranges = written(ranges, "crowded-bounds").select(*named, _BOUNDS)
        below = F.coalesce(F.size(F.filter(_BOUNDS, lambda b: b < F.col(_RANK))), F.lit(0))
        sliced = sliced.join(ranges, same, "left").withColumn(_SLICE, F.col(_SLICE) * ways + below)
        sliced = sliced.drop(_BOUNDS, *[f"_of_{c}" for c in group])
    return sliced.drop(_RANK)


def _within(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, result: str) -> DataFrame:
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(result, F.last(value, ignorenulls=True).over(so_far))


def _across_slices(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, result: str) -> DataFrame:
    # The last value of each key in each slice, aggregated before the shuffle.
    placed = F.when(F.col(value).isNotNull(), F.struct(*order))
    tails = sliced.groupBy(*keys, _SLICE).agg(F.max_by(value, placed).alias(value))

    # What the earlier slices of a key hand on to the next.
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    heads = tails.withColumn(value, F.last(value, ignorenulls=True).over(earlier)).where(F.col(value).isNotNull())

    # A value handed on becomes the first row of its slice.
    together = sliced.withColumn(_HEAD, F.lit(False)).unionByName(heads.withColumn(_HEAD, F.lit(True)), allowMissingColumns=True)
    carried = _within(together, [*keys, _SLICE], [F.col(_HEAD).desc(), *order], value, result)
    return carried.where(~F.col(_HEAD)).drop(_HEAD, _SLICE)
