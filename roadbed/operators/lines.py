"""Positions on lines given as vertex tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbed.functions.geometry import make_line, planar_distance
from roadbed.operators.ordering import MAX_GROUP_ROWS, OrderedGroups, largest_group
from roadbed.session import stage

#: segments of one line that share a bucket in place_on_lines
_SEGMENTS_PER_BUCKET = 64


def place_on_lines(
    targets: DataFrame,
    vertices: DataFrame,
    by: Sequence[str],
    fraction: str = "fraction",
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``new_lon``/``new_lat``: the point at ``fraction`` of the target's line.

    ``vertices`` holds ``by`` columns (never NULL) and m, lon, lat; a vertex
    listed twice counts once. Each line is cut into segments by the planar
    length run through; a segment starts at the very number its neighbour ends
    at, so a target falls into exactly one of them. Long lines are spread over buckets of that share. Targets with
    a fraction outside 0..1, or without a line, are left out. A line of one
    vertex, or of no length, gives its first vertex.
    """
    by = list(by)
    follower, whole = F.struct("m", "lon", "lat"), Window.partitionBy(*by)
    listed = vertices.select(*by, "m", "lon", "lat")
    # repeats count as well, so this is a bound
    largest = largest_group(listed, by)
    if largest <= (max_rows or MAX_GROUP_ROWS):
        # rows of a line in one place: once for the distinct vertices, the sums and the totals
        different = listed.repartition(*by).distinct()
    else:
        different, largest = listed.distinct(), None
    groups = OrderedGroups(different, by, ["m", "lon", "lat"], max_rows, largest).frames(
        {"next": lambda w: F.lead(follower).over(w)}, before=0, after=1
    )
    length = planar_distance(F.col("lon"), F.col("lat"), F.col("next.lon"), F.col("next.lat"))
    groups = (
        groups.map(lambda d: d.withColumn("seg_length", F.coalesce(length, F.lit(0.0))))
        .running_sum("run_end", F.col("seg_length"))
        .frames({"before": lambda w: F.lag("run_end").over(w)}, before=1, after=0)
    )
    sums = {"total": F.max("run_end"), "n_rows": F.count("*")}
    in_place = groups.large is None
    segments = groups.to_df()
    if in_place:
        segments = segments.withColumns({n: c.over(whole) for n, c in sums.items()})
    segments = segments.select(
        *by,
        "seg_length",
        F.coalesce("before", F.lit(0.0)).alias("run_start"),
        "run_end",
        F.col("lon").alias("seg_lon"),
        F.col("lat").alias("seg_lat"),
        F.coalesce("next.lon", "lon").alias("end_lon"),
        F.coalesce("next.lat", "lat").alias("end_lat"),
        F.col("next").isNull().alias("is_last"),
        *(sums if in_place else ()),
    )
    # joined to targets, and to the sums or read for them: written once
    segments = stage(segments, "segments")
    if in_place:
        # a line has one last vertex
        totals = segments.filter("is_last").select(*by, *sums)
        summed = segments
    else:
        totals = segments.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])
        summed = segments.join(totals, by)

    def slot(run: Column, slack: float) -> Column:
        share = F.when(F.col("total") > 0, run / F.col("total")).otherwise(0.0)
        n_slots = F.ceil(F.col("n_rows") / _SEGMENTS_PER_BUCKET)
        return F.floor(share * n_slots + slack).cast("bigint")

    slots = F.sequence(slot(F.col("run_start"), -1e-6), slot(F.col("run_end"), 1e-6))
    slotted = summed.withColumn("slot", F.explode(slots)).drop(*sums)
    aimed = (
        targets.filter(F.col(fraction).between(0, 1))
        .join(totals, by)
        .withColumn("aim", F.col(fraction) * F.col("total"))
        .withColumn("slot", slot(F.col("aim"), 0.0))
        .drop(*sums)
    )
    aim = F.col("aim")
    inside = (aim >= F.col("run_start")) & (F.col("is_last") | (aim < F.col("run_end")))
    part = F.least((aim - F.col("run_start")) / F.col("seg_length"), F.lit(1.0))
    share = F.when(F.col("seg_length") > 0, part).otherwise(0.0)
    placed = aimed.join(slotted, [*by, "slot"]).filter(inside)
    return placed.withColumns(
        {
            "new_lon": F.col("seg_lon") + share * (F.col("end_lon") - F.col("seg_lon")),
            "new_lat": F.col("seg_lat") + share * (F.col("end_lat") - F.col("seg_lat")),
        }
    ).select(*targets.columns, "new_lon", "new_lat")


def line_parts(vertices: DataFrame, by: Sequence[str], row: str, part_rows: int) -> DataFrame:
    """Lines as arrays of at most ``part_rows + 1`` vertices.

    ``row`` is the 1-based number of the vertex in its line. The last vertex of
    a part opens the next one too, so parts join up.
    """
    number = F.col(row) - 1
    part = F.floor(number / part_rows).cast("bigint")
    opens_next = (F.pmod(number, F.lit(part_rows)) == 0) & (number > 0)
    parts = F.array_compact(F.array(part, F.when(opens_next, part - 1)))
    listed = vertices.withColumn("part_no", F.explode(parts))
    return listed.groupBy(*by, "part_no").agg(
        make_line(F.col("chainage"), F.col("lon"), F.col("lat")).alias("line")
    )
