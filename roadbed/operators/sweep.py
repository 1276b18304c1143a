"""Points in intervals by a sweep along sorted ranges of points.

``band_join`` lists an interval once per bucket it touches. Here points are cut
into ranges of about equal row count, an interval is copied once to each range
that has a point for it, and each range is swept in order: an interval opens at
its low end and is let go behind its high end. Long intervals, or ones of very
different length, then cost no more rows than short ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbed.session import stage

#: pairs put together at once in a task
_PAIRS = 1 << 16

_PART, _AT, _LO, _HI = "__part", "__at", "__lo", "__hi"
#: an interval comes before the points that stand at its low end
_INTERVAL, _POINT = 0, 1


def _number(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def ranges_of(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """(range, by columns, first and last position) of staged points, a row for each range and group."""
    return points.groupBy(_PART, *by).agg(F.min(_AT).alias("__first"), F.max(_AT).alias("__last"))


def listed_intervals(intervals: DataFrame, ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each interval once for each range of points that it reaches into."""
    meets = (F.col(_LO) <= F.col("__last")) & (F.col("__first") <= F.col(_HI))
    return intervals.join(ranges, list(by)).filter(meets).drop("__first", "__last")


def _in_ranges(points: DataFrame, by: Sequence[str], point: str | Column) -> DataFrame:
    """Points with their position and range, written once in order.

    A hash of the row ends the order, so points that all stand at one place are
    still spread over ranges.
    """
    tie = F.xxhash64(*points.columns)
    placed = points.withColumn(_AT, _number(point)).dropna(subset=[_AT, *by])
    ordered = placed.repartitionByRange(*by, _AT, tie)
    return stage(ordered.withColumn(_PART, F.spark_partition_id()), "ranges")


def sweep_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str | Column,
    low: str | Column,
    high: str | Column,
    by: Sequence[str] = ("file_name",),
    pad: float = 0.0,
) -> DataFrame:
    """Pairs with ``low - pad <= point <= high + pad`` and equal ``by`` columns.

    The same rows and columns as ``band_join``. Positions and bounds are compared
    as doubles. NULL or NaN positions, bounds and NULL ``by`` values meet nothing, nor
    does an interval whose ends are reversed. Rows that repeat give pairs that repeat.
    A task holds the intervals that are open at one place and a batch of points.
    """
    by = list(by)
    own = [c for c in points.columns if c not in by]
    theirs = [c for c in intervals.columns if c not in by]
    placed = _in_ranges(points, by, point)
    bounded = intervals.withColumns({_LO: _number(low) - pad, _HI: _number(high) + pad})
    # NaN is above all numbers here: only the low end needs a test of its own
    bounded = bounded.filter((F.col(_LO) <= F.col(_HI)) & ~F.isnan(_HI))
    listed = listed_intervals(bounded, ranges_of(placed.filter(~F.isnan(_AT)), by), by)

    def row(kind: int, at: Column, end: Column, point_side: Column, interval_side: Column) -> list[Column]:
        return [
            F.col(_PART), *[F.col(c) for c in by], at.alias("at"), F.lit(kind).alias("kind"), end.alias("end"),
            point_side.alias("point"), interval_side.alias("interval"),
        ]

    # positions stand in the structs too, so that a side without other columns is a struct
    of_point = F.struct(F.col(_AT), *own)
    of_interval = F.struct(F.col(_LO), *theirs)
    point_type = placed.select(of_point.alias("x")).schema["x"].dataType
    interval_type = listed.select(of_interval.alias("x")).schema["x"].dataType
    ends = row(_INTERVAL, F.col(_LO), F.col(_HI), F.lit(None).cast(point_type), of_interval)
    places = row(_POINT, F.col(_AT), F.lit(None).cast("double"), of_point, F.lit(None).cast(interval_type))
    both = listed.select(*ends).union(placed.filter(~F.isnan(_AT)).select(*places))
    order = [_PART, *by, "at", "kind"]
    swept = both.repartition(_PART).sortWithinPartitions(*order)

    kept = [f for f in both.schema if f.name in by]
    schema = T.StructType([*kept, T.StructField("point", point_type), T.StructField("interval", interval_type)])
    width = len(by) + 1
    pairs = swept.mapInArrow(lambda batches: _sweep(batches, width), schema)
    return pairs.select(*by, *[F.col("point")[c].alias(c) for c in own], *[F.col("interval")[c].alias(c) for c in theirs])


def _changes(keys: list[pa.Array]) -> np.ndarray:
    """First row of each group of a sorted batch, and the end."""
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= np.asarray(pc.not_equal(key[1:], key[:-1]))
    return np.append(np.flatnonzero(new), len(new))


def _sweep(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a stream (range, by…, at, kind, end, point, interval) in order."""
    open_end, open_rows, last = np.empty(0), None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, side = batch.columns[:width], batch.columns[-1]
        at, kind, end = (c.to_numpy(zero_copy_only=False) for c in batch.columns[width : width + 3])
        bounds = _changes(keys)
        key_of = lambda i: [k[i].as_py() for k in keys]
        for start, stop in zip(bounds[:-1], bounds[1:]):
            if start or key_of(0) != last:  # intervals end with their range and group
                open_end, open_rows = np.empty(0), side.slice(0, 0)
            is_point = kind[start:stop] == _POINT
            point_rows, interval_rows = (start + np.flatnonzero(m) for m in (is_point, ~is_point))
            # points before an interval in the stream lie below it
            first = np.concatenate([np.zeros(len(open_end), int), np.cumsum(is_point)[~is_point]])
            ends = np.concatenate([open_end, end[interval_rows]])
            rows = pa.concat_arrays([open_rows, side.take(pa.array(interval_rows))])
            behind = np.searchsorted(at[point_rows], ends, side="right")
            yield from _pairs(batch, width, point_rows, rows, first, np.maximum(behind, first))
            still = ends >= at[stop - 1]
            open_end, open_rows = ends[still], rows.filter(pa.array(still))
        last = key_of(batch.num_rows - 1)


def _pairs(batch, width, point_rows, intervals, first, behind) -> Iterator[pa.RecordBatch]:
    """Interval i with its points ``first[i]`` up to ``behind[i]``, some at a time."""
    counts = behind - first
    total = np.concatenate([[0], np.cumsum(counts)])
    for done in range(0, int(total[-1]), _PAIRS):
        pair = np.arange(done, min(done + _PAIRS, int(total[-1])))
        of = np.searchsorted(total, pair, side="right") - 1
        points = pa.array(point_rows[first[of] + pair - total[of]])
        columns = [batch.column(i).take(points) for i in range(1, width)]
        columns += [batch.column(batch.num_columns - 2).take(points), intervals.take(pa.array(of))]
        names = [*batch.schema.names[1:width], "point", "interval"]
        yield pa.record_batch(columns, names)
