"""Joins Spark would otherwise plan as nested loops, and update-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.session import stage


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: buckets of an interval listed at once
_RUN = 4096


def band_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str | Column,
    low: str | Column,
    high: str | Column,
    by: Sequence[str] = ("file_name",),
    bucket: float = 100.0,
    pad: float = 0.0,
) -> DataFrame:
    """Pairs with ``low - pad <= point <= high + pad`` and equal ``by`` columns.

    Distance is cut into buckets and each interval listed once per bucket it
    touches; a point has one bucket. That leaves an equi-join, so Spark may
    broadcast the intervals if they are small, or shuffle both sides and split
    a crowded bucket at run time. A pair meets in the point's bucket only, so
    nothing has to be de-duplicated.
    """
    by = list(by)
    lo, hi, slot = "__lo", "__hi", "__slot"

    def bucket_of(value: Column) -> Column:
        return F.floor(value / F.lit(float(bucket))).cast("bigint")

    def run_of(value: Column) -> Column:
        return F.floor(bucket_of(value) / _RUN).cast("bigint")

    bounded = (
        intervals.withColumns({lo: _column(low) - pad, hi: _column(high) + pad})
        # sequence() would count downwards for a reversed interval
        .filter(F.col(lo) <= F.col(hi))
        # in two steps, so that a very long interval is many rows and no long list
        .withColumn("__run", F.explode(F.sequence(run_of(F.col(lo)), run_of(F.col(hi)))))
        .withColumn(
            slot,
            F.explode(
                F.sequence(
                    F.greatest(bucket_of(F.col(lo)), F.col("__run") * _RUN),
                    F.least(bucket_of(F.col(hi)), F.col("__run") * _RUN + _RUN - 1),
                )
            ),
        )
        .drop("__run")
    )
    placed = points.withColumns({"__at": _column(point)}).withColumn(slot, bucket_of(F.col("__at")))
    joined = placed.join(bounded, [*by, slot])
    return joined.filter(F.col("__at").between(F.col(lo), F.col(hi))).drop(slot, lo, hi, "__at")


_CELL = ("__cx", "__cy")
#: cell size in radii: large cells are touched once by most places
_CELL_RADII = 8
#: positions of one cell that go to one task
_CROWD = 50_000


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("bigint")


def _in_cell(df: DataFrame, lon: str, lat: str, size: float) -> DataFrame:
    return df.withColumns({"__cx": _cell(F.col(lon), size), "__cy": _cell(F.col(lat), size)})


def _touching_cells(df: DataFrame, lon: str, lat: str, radius: float, size: float) -> DataFrame:
    """One row per cell within ``radius`` of a position: 1 for most, 4 at worst."""
    # a hair more than the radius, so that rounding cannot miss a cell
    reach = F.lit(radius * 1.000001)

    def cells(value: Column) -> Column:
        return F.explode(F.sequence(_cell(value - reach, size), _cell(value + reach, size)))

    placed = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return placed.withColumn("__cx", cells(F.col(lon))).withColumn("__cy", cells(F.col(lat)))


def _close(lon: str, lat: str, other_lon: str, other_lat: str, radius: float) -> Column:
    dx, dy = F.col(other_lon) - F.col(lon), F.col(other_lat) - F.col(lat)
    return dx * dx + dy * dy <= F.lit(radius * radius)


def distance_join(
    places: DataFrame,
    points: DataFrame,
    radius: float,
    by: Sequence[str] = ("file_name",),
    place: tuple[str, str] = ("lon", "lat"),
    point: tuple[str, str] = ("point_lon", "point_lat"),
    crowd: int = _CROWD,
) -> DataFrame:
    """Pairs of places and points no further apart than ``radius`` (planar).

    ``places`` is the smaller side: it is listed in every grid cell it reaches
    into, a point only in its own, so a pair meets once. Cells that hold more
    than ``crowd`` points, such as the one of all lost points, are spread over
    several tasks.
    """
    size = radius * _CELL_RADII
    left = _touching_cells(places, *place, radius, size)
    right = _in_cell(points, *point, size)
    left, right, on = _spread(left, right, [*by, *_CELL], points.columns, crowd)
    pairs = left.join(right, on)
    return pairs.filter(_close(*place, *point, radius)).drop(*_CELL, "__salt")


def _spread(
    left: DataFrame, right: DataFrame, cell: list[str], told_apart: Sequence[str], crowd: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and their join keys, with a salt where ``right`` crowds a cell.

    Rows of a crowded cell are dealt by the columns that tell them apart; the
    other side is repeated for each part of that cell only.
    """
    sizes = right.groupBy(*cell).agg(F.count("*").alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= crowd:
        return left, right, cell
    crowded = sizes.filter(F.col("n") > crowd).select(
        *cell, F.ceil(F.col("n") / crowd).cast("int").alias("__salts")
    )
    salts = F.coalesce("__salts", F.lit(1))
    salt = F.pmod(F.xxhash64(*told_apart), salts).cast("int")
    right = right.join(crowded, cell, "left").withColumn("__salt", salt).drop("__salts")
    each = F.explode(F.sequence(F.lit(0), salts - 1))
    left = left.join(crowded, cell, "left").withColumn("__salt", each).drop("__salts")
    return left, right, [*cell, "__salt"]


def distinct_positions(points: DataFrame, by: Sequence[str] = ("file_name",)) -> DataFrame:
    """One row per position with its smallest and largest chainage, written once.

    Repeated positions, such as all lost ones at (0, 0), collapse before any
    shuffle.
    """
    located = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    positions = located.groupBy(
        *by, F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat")
    ).agg(F.min("chainage").alias("p_min"), F.max("chainage").alias("p_max"))
    return stage(positions, "positions")


def near_places(
    places: DataFrame,
    positions: DataFrame,
    radius: float,
    by: Sequence[str] = ("file_name",),
    other_chainage: bool = False,
    crowd: int = _CROWD,
) -> DataFrame:
    """Distinct ``places`` (lon, lat, chainage) with a measured point close by.

    Only existence is asked, of ``distinct_positions``. Cells that hold more
    than ``crowd`` of them are spread over several tasks. The semi-join stops
    at the first hit and emits no pairs.
    """
    size, cell = radius * _CELL_RADII, [*by, *_CELL]
    right = _in_cell(positions, "p_lon", "p_lat", size)
    left = _touching_cells(places.distinct(), "lon", "lat", radius, size)
    left, right, on = _spread(left, right, cell, ["p_lon", "p_lat"], crowd)
    right = right.withColumnsRenamed({c: f"p_{c}" for c in on})
    condition = _close("lon", "lat", "p_lon", "p_lat", radius)
    for column in on:
        condition = condition & (F.col(column) == F.col(f"p_{column}"))
    if other_chainage:
        chainage = F.col("chainage")
        condition = condition & ((F.col("p_min") != chainage) | (F.col("p_max") != chainage))
    return left.join(right, condition, "left_semi").drop(*_CELL, "__salt").distinct()


def update_from(
    target: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` of the target rows that match ``source``.

    A match overwrites with NULL too. Of several source rows for one key the
    smallest by value is taken, so reruns agree.
    """
    on, columns = list(on), list(columns)
    chosen = source.groupBy(*on).agg(F.min(F.struct(*columns)).alias("__new"))
    joined = target.join(chosen, on, "left")
    hit = F.col("__new").isNotNull()
    changed = {
        c: F.when(hit, F.col(f"__new.{c}").cast(target.schema[c].dataType)).otherwise(F.col(c))
        for c in columns
    }
    return joined.withColumns(changed).select(*target.columns)
