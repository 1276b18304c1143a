"""Condition values along the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from roadbed.functions.numbers import divide_half_up, from_cents, to_cents
from roadbed.functions.numbers import half as half_of
from roadbed.operators.joins import update_from
from roadbed.operators.ordering import OrderedGroups

_WHEEL_PATHS = ("iri_right", "iri_left", "rutt_right", "rutt_left")
_SMOOTHED = (*_WHEEL_PATHS, "iri_lane", "texture", "etd_texture")
_ORDER = ["chainage", "event_str", "link_id"]


def moving_sum(value: Column, half: int) -> Callable[[WindowSpec], Column]:
    """Sum over ``half`` rows to either side; NULL where the row itself is."""
    return lambda w: F.when(value.isNotNull(), F.sum(value).over(w.rowsBetween(-half, half)))


def smooth_condition(
    points: DataFrame,
    half: int = 4,
    denominator: str = "fixed",
    by_link: bool = False,
    max_rows: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Centred moving means of the condition values, rounded to two digits.

    iri and rutting become the mean of their two smoothed wheel paths. The sum
    is divided by the full frame also at the ends of a run (``"fixed"``) or by
    the values really there (``"count"``). All sums share one sort. ``largest``
    is the row count of the largest run (or link), if the caller knows it.
    """
    if denominator not in ("fixed", "count"):
        raise ValueError(f"unknown denominator: {denominator}")
    two_digits = {c: F.col(c).cast("decimal(8,2)") for c in _SMOOTHED}
    # whole hundredths are summed faster than decimals
    summed = {c: to_cents(v) for c, v in two_digits.items()} if denominator == "fixed" else two_digits
    sums = {f"__s_{c}": moving_sum(value, half) for c, value in summed.items()}
    size = 2 * half + 1
    if denominator == "count":
        for c, value in two_digits.items():
            sums[f"__n_{c}"] = (
                lambda w, v=value: F.count(v).over(w.rowsBetween(-half, half)).cast("decimal(9,0)")
            )

    def mean(c: str) -> Column:
        if denominator == "fixed":
            return from_cents(divide_half_up(F.col(f"__s_{c}"), size))
        return (F.col(f"__s_{c}") / F.col(f"__n_{c}")).cast("decimal(8,2)")

    def path_mean(left: str, right: str) -> Column:
        if denominator == "fixed":
            # one exact division: halves of a cent must not be rounded twice
            total = F.col(f"__s_{left}") + F.col(f"__s_{right}")
            return from_cents(divide_half_up(total, 2 * size))
        halves = [F.col(f"__s_{c}") / F.col(f"__n_{c}") for c in (left, right)]
        return ((halves[0] + halves[1]) / 2).cast("decimal(8,2)")

    keys = ["file_name", "link_id"] if by_link else ["file_name"]
    framed = OrderedGroups(points, keys, _ORDER, max_rows, largest).frames(sums, half, half).to_df()
    changed = {c: mean(c) for c in _SMOOTHED}
    changed["iri"] = path_mean("iri_left", "iri_right").cast(points.schema["iri"].dataType)
    changed["rutting"] = path_mean("rutt_left", "rutt_right")
    return framed.withColumns(changed).select(*points.columns)


def interpolate_rutting(
    laser: DataFrame, mode: str = "reference", max_rows: int | None = None
) -> DataFrame:
    """Rebuild the rut depths between those measured every 10 m.

    The value 5 m past a 10 m point becomes the mean of that point and the one
    before it (``"reference"``) or after it (``"centred"``). A missing
    neighbour gives NULL, which overwrites.
    """
    shift = {"reference": F.lag, "centred": F.lead}[mode]
    columns = ("rutt_right", "rutt_left", "rutting")
    tens = laser.filter(F.pmod("chainage", F.lit(10.0)) == 0).select(
        "file_name", "chainage", *columns
    )
    other = F.struct(*columns)
    paired = (
        OrderedGroups(tens, ["file_name"], ["chainage", *columns], max_rows)
        .frames({"other": lambda w: shift(other).over(w)}, before=1, after=1)
        .to_df()
    )
    means = {
        c: half_of(F.col(c) + F.col(f"other.{c}")).cast(laser.schema[c].dataType) for c in columns
    }
    between = paired.select(
        "file_name",
        (F.col("chainage") + 5).alias("chainage"),
        *[v.alias(c) for c, v in means.items()],
    )
    return update_from(laser, between, ["file_name", "chainage"], columns)
