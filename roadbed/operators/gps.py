"""GPS gaps: find, explain and repair them; snap event ends to the track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.functions.predicates import has_fix, has_north_fix, is_lost, is_pavement, on_grid
from roadbed.operators.assembly import padded_band_join
from roadbed.operators.joins import band_join, distinct_positions, near_places, update_from
from roadbed.operators.lines import place_on_lines
from roadbed.operators.ordering import OrderedGroups
from roadbed.schema import Profile
from roadbed.session import stage

LINK = ["file_name", "date", "link_id"]
GAP = [*LINK, "gap_start", "gap_end", "c_p"]
POINT_ORDER = ["chainage", "event_str", "lon", "lat"]

#: how far beyond a gap its anchors may lie, metres
REACH = 6


def is_lost_point(cfg: Profile) -> Column:
    return is_lost(F.col("lon"), F.col("lat"), cfg.null_is_lost)


def _island_stats(lost: DataFrame, island: str, cfg: Profile) -> DataFrame:
    return (
        lost.groupBy(*LINK, island)
        .agg(
            F.min("chainage").alias("gap_start"),
            F.max("chainage").alias("gap_end"),
            F.count("*").alias("c_p"),
        )
        .withColumn("meter", F.col("c_p") * F.lit(cfg.spacing).cast("bigint"))
        .drop(island)
    )


def gps_islands(
    points: DataFrame, cfg: Profile = Profile(), max_rows: int | None = None
) -> DataFrame:
    """Runs of lost points, one row each.

    A run ends at a located point or where chainage jumps by more than the
    point spacing. ``compat`` numbers runs by the difference of two row numbers
    instead; pieces of a link that lie apart may then fall into one run.
    """
    rows = points.select(*LINK, *POINT_ORDER)
    if cfg.compat:
        return _islands_by_row_numbers(rows, cfg, max_rows)
    before = F.struct("chainage", is_lost_point(cfg).alias("lost"))
    flagged = OrderedGroups(rows, LINK, POINT_ORDER, max_rows).frames(
        {"previous": lambda w: F.lag(before).over(w)}, before=1, after=0
    )
    opens = is_lost_point(cfg) & ~F.coalesce(
        F.col("previous.lost")
        & (F.col("chainage") - F.col("previous.chainage") <= F.lit(cfg.spacing)),
        F.lit(False),
    )
    numbered = (
        flagged.map(lambda d: d.withColumn("opens", opens.cast("int")).drop("previous"))
        .running_sum("island", F.col("opens"))
        .to_df()
    )
    return _island_stats(numbered.filter(is_lost_point(cfg)), "island", cfg)


def _islands_by_row_numbers(rows: DataFrame, cfg: Profile, max_rows: int | None) -> DataFrame:
    in_link = OrderedGroups(rows, LINK, POINT_ORDER, max_rows).row_number("n_link").to_df()
    in_place = OrderedGroups(in_link, [*LINK, "lat", "lon"], ["n_link"], max_rows)
    numbered = in_place.row_number("n_place").to_df()
    island = F.col("n_link") - F.col("n_place")
    return _island_stats(numbered.withColumn("island", island).filter(is_lost_point(cfg)), "island", cfg)


def gap_points(
    points: DataFrame,
    islands: DataFrame,
    cfg: Profile = Profile(),
    same_link: bool = False,
    all_points: bool = False,
) -> DataFrame:
    """One row per gap and lost grid point in it (any link of the same run)."""
    wanted = is_lost_point(cfg) & (F.col("status") == "lost")
    if not all_points:
        wanted = wanted & on_grid(F.col("chainage"), cfg.grid)
    by = LINK if same_link else ["file_name"]
    lost = points.filter(wanted).select(*by, "chainage").distinct()
    pairs = band_join(lost, islands, "chainage", "gap_start", "gap_end", by=by, bucket=cfg.bucket)
    return pairs.select(
        *GAP,
        "meter",
        "chainage",
        (F.col("gap_start") - REACH).alias("new_p_min"),
        (F.col("gap_end") + REACH).alias("new_p_max"),
    )


def gps_gaps(
    points: DataFrame,
    cfg: Profile = Profile(),
    same_link: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    return gap_points(points, gps_islands(points, cfg, max_rows), cfg, same_link)


def gap_vertices(points: DataFrame, gaps: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Located points within reach of a gap: the vertices of its anchor line.

    The line belongs to the gap, so it is built once however many lost points
    the gap has.
    """
    located = has_north_fix(F.col("lon"), F.col("lat")) & (F.col("status") == "lost")
    fixes = points.filter(located).select("file_name", "chainage", "lon", "lat").distinct()
    windows = gaps.select(*GAP, "new_p_min", "new_p_max").distinct()
    return band_join(
        fixes, windows, "chainage", "new_p_min", "new_p_max", bucket=cfg.bucket
    ).select(*GAP, F.col("chainage").alias("m"), "lon", "lat")


def gap_spans(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy(*GAP).agg(
        F.min("m").alias("chainage_str"), F.max("m").alias("chainage_end")
    )


def gap_anchors(points: DataFrame, gaps: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Gap points with the first and last anchor around their gap."""
    return gaps.join(gap_spans(gap_vertices(points, gaps, cfg)), GAP)


def gap_positions(
    points: DataFrame, gaps: DataFrame, cfg: Profile = Profile(), max_rows: int | None = None
) -> DataFrame:
    """Interpolated position for every gap point that has anchors on both sides."""
    # read by the spans, the size check and the segments: join once
    vertices = stage(gap_vertices(points, gaps, cfg), "gap-vertices")
    span = F.col("chainage_end") - F.col("chainage_str")
    targets = (
        gaps.join(gap_spans(vertices), GAP)
        .filter(span > 0)
        .select(*GAP, "chainage", ((F.col("chainage") - F.col("chainage_str")) / span).alias("fraction"))
    )
    return place_on_lines(targets, vertices, GAP, max_rows=max_rows)


def repair_gps(
    points: DataFrame, gaps: DataFrame, cfg: Profile = Profile(), max_rows: int | None = None
) -> DataFrame:
    """Give lost grid points a position on the line between their anchors.

    Points whose fraction falls outside the line stay as they are; see
    ``unrepaired_points``. Repaired rows are flagged ``gps_imputed``.
    """
    return move_points(points, gap_positions(points, gaps, cfg, max_rows))


def move_points(points: DataFrame, positions: DataFrame, grid: float | None = None) -> DataFrame:
    """Give points the position found for them and flag them ``gps_imputed``.

    If all positions lie on a ``grid``, only the points on it are joined to them.
    """
    repaired = positions.select(
        *LINK,
        "chainage",
        F.col("new_lon").alias("lon"),
        F.col("new_lat").alias("lat"),
        F.lit(True).alias("gps_imputed"),
    )
    on, columns = [*LINK, "chainage"], ["lon", "lat", "gps_imputed"]
    if grid is None:
        return update_from(points, repaired, on, columns)
    may_move = F.coalesce(on_grid(F.col("chainage"), grid), F.lit(False))
    moved = update_from(points.filter(may_move), repaired, on, columns)
    return moved.union(points.filter(~may_move))


def unrepaired_points(
    repaired: DataFrame, gaps: DataFrame, cfg: Profile = Profile()
) -> DataFrame:
    """Gap points that are still lost after the repair."""
    on = [*LINK, "chainage"]
    still_lost = repaired.filter(is_lost_point(cfg)).select(*on).distinct()
    return gaps.join(still_lost, on, "left_semi")


def event_endpoints(points: DataFrame) -> DataFrame:
    """Distinct start and end of every event, one pass over the points."""
    attributes = [
        "event_name", "link_id", "section_id", "km_start", "km_end",
        "length", "lane_no", "date", "file_name",
    ]

    def end(chainage: str, lon: str, lat: str, direction: str) -> Column:
        return F.struct(
            F.col(chainage).alias("chainage"),
            F.col(lon).alias("lon"),
            F.col(lat).alias("lat"),
            F.lit(direction).alias("direction"),
        )

    events = points.select(
        *attributes, "event_str", "event_end", "lon_str", "lat_str", "lon_end", "lat_end"
    ).distinct()
    ends = F.array(
        end("event_str", "lon_str", "lat_str", "str"), end("event_end", "lon_end", "lat_end", "end")
    )
    listed = events.select(*attributes, F.explode(ends).alias("e"))
    return listed.select(*attributes, "e.*").distinct()


def measured_near_events(laser: DataFrame, key: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Measured points within 5 m of a pavement event that has a link id."""
    named = key.filter(F.replace("link_id", F.lit(" "), F.lit("")) != "")
    events = named.filter(is_pavement(F.col("event_type"))).select(
        "file_name", "event_str", "event_end", "event_type", "survey_date"
    )
    columns = laser.select("file_name", "chainage", "lon", "lat")
    return padded_band_join(columns, events, cfg).select("file_name", "chainage", "lon", "lat")


def track_positions(laser: DataFrame, key: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Distinct positions of the measured points near events."""
    return distinct_positions(measured_near_events(laser, key, cfg))


def snap_positions(
    endpoints: DataFrame,
    laser: DataFrame,
    track: DataFrame,
    cfg: Profile = Profile(),
    max_rows: int | None = None,
) -> DataFrame:
    """Chainages of event ends and their place on the measured track.

    Only ends with a measured point of other chainage close by are moved.
    """
    ends = endpoints.select("file_name", "chainage", "lon", "lat").distinct()
    near = near_places(ends, track, cfg.snap_radius, other_chainage=True)
    chainages = near.select("file_name", F.col("chainage").alias("at")).distinct()
    fixes = (
        laser.filter(has_fix(F.col("lon"), F.col("lat")))
        .select("file_name", F.col("chainage").alias("m"), "lon", "lat")
        .distinct()
    )
    vertices = stage(
        band_join(fixes, chainages, "m", "at", "at", bucket=cfg.bucket, pad=cfg.spacing),
        "snap-vertices",
    )
    by = ["file_name", "at"]
    span = F.col("last") - F.col("first")
    targets = (
        vertices.groupBy(*by)
        .agg(F.min("m").alias("first"), F.max("m").alias("last"))
        .select(
            *by,
            ((F.col("at") - F.col("first")) / F.when(span == 0, 0.0001).otherwise(span)).alias(
                "fraction"
            ),
        )
    )
    placed = place_on_lines(targets, vertices, by, max_rows=max_rows).drop("fraction")
    # looked up for starts and again for ends
    return stage(placed, "snap-positions")


def _moved_events(points: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Events with at least one moved end; NULL where an end stays."""
    result = points.select("file_name", "event_str", "event_end").distinct()
    for which, positions in (("str", starts), ("end", ends)):
        moved = positions.select(
            "file_name",
            F.col("at").alias(f"event_{which}"),
            F.col("new_lon").alias(f"new_lon_{which}"),
            F.col("new_lat").alias(f"new_lat_{which}"),
        )
        result = result.join(moved, ["file_name", f"event_{which}"], "left")
    return result.filter(F.col("new_lon_str").isNotNull() | F.col("new_lon_end").isNotNull())


def _move_ends(points: DataFrame, events: DataFrame, which: list[str]) -> DataFrame:
    joined = points.join(events, ["file_name", "event_str", "event_end"], "left")
    changed = {
        f"{c}_{w}": F.coalesce(f"new_{c}_{w}", f"{c}_{w}") for w in which for c in ("lon", "lat")
    }
    return joined.withColumns(changed).select(*points.columns)


def snap_endpoints(
    points: DataFrame,
    laser: DataFrame,
    key: DataFrame,
    cfg: Profile = Profile(),
    max_rows: int | None = None,
    track: DataFrame | None = None,
    moved: DataFrame | None = None,
) -> DataFrame:
    """Move event starts and ends onto the measured track.

    Both are moved by one set of positions; ``compat`` looks for the ends again
    after the starts have moved. New positions are brought together per event,
    so that the points are joined once. ``track`` are the ``track_positions``,
    if already at hand. ``moved`` are the points with positions of their own changed,
    which get the new ends in place of ``points``.
    """
    track = track_positions(laser, key, cfg) if track is None else track
    starts = snap_positions(event_endpoints(points), laser, track, cfg, max_rows)
    ends = starts
    if cfg.compat:
        started = _move_ends(points, _moved_events(points, starts, starts), ["str"])
        ends = snap_positions(event_endpoints(started), laser, track, cfg, max_rows)
    events = _moved_events(points, starts, ends)
    return _move_ends(points if moved is None else moved, events, ["str", "end"])
