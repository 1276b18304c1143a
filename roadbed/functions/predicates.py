"""Named row tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_grid(chainage: Column, step: float = 25.0) -> Column:
    """The point lies on the ``step`` metre grid."""
    return F.pmod(chainage, F.lit(float(step))) == 0


def is_lost(lon: Column, lat: Column, null_is_lost: bool = False) -> Column:
    """The receiver gave no position. NULL is unknown unless asked for."""
    lost = (lon == 0) | (lat == 0)
    return F.coalesce(lost, F.lit(null_is_lost))


# The four tests below differ on purpose and are no complements of is_lost.
def has_any_fix(lon: Column, lat: Column) -> Column:
    return (lon != 0) | (lat != 0)


def has_fix(lon: Column, lat: Column) -> Column:
    return (lon != 0) & (lat != 0)


def has_north_fix(lon: Column, lat: Column) -> Column:
    return (lon != 0) & (lat > 0)


def has_positive_fix(lon: Column, lat: Column) -> Column:
    return (lon > 0) | (lat > 0)


def is_pavement(event_type: Column) -> Column:
    return F.replace(event_type, F.lit(" "), F.lit("")) == "pavetype."


def inside_event() -> Column:
    """The point lies in its own event by the unrounded bounds."""
    return F.col("chainage").between(F.col("event_str"), F.col("event_end"))
