"""Data-quality reports, each a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.functions.identifiers import lane_group
from roadbed.functions.numbers import km_to_int
from roadbed.functions.predicates import has_any_fix, on_grid
from roadbed.operators.assembly import lost_counts
from roadbed.operators.gps import event_endpoints, gap_anchors, track_positions
from roadbed.operators.joins import near_places
from roadbed.operators.ordering import same, with_row_id
from roadbed.schema import Profile
from roadbed.session import stage

#: what the rule codes of link_rules mean
RULE_TEXTS = {
    "left_descends": "link is on the left side but its kilometres descend",
    "right_ascends": "link is on the right side but its kilometres ascend",
    "lane_missing": "no lane given",
    "not_frontage": "lane says frontage road, link id does not",
    "not_interchange": "lane says interchange, link id does not",
    "not_u_turn": "lane says u-turn, link id does not",
    "not_bridge": "lane says bridge, link id does not",
    "not_tunnel": "lane says tunnel, link id does not",
}


def gps_lost(laser: DataFrame, key: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Links with too many lost grid points."""
    counts = lost_counts(laser, key, cfg).filter(F.col("n_lost") > cfg.report_above)
    return counts.select("file_name", "date", "link_id", F.col("n_lost").alias("count"))


def endpoints_off_track(
    points: DataFrame,
    laser: DataFrame,
    key: DataFrame,
    cfg: Profile = Profile(),
    track: DataFrame | None = None,
) -> DataFrame:
    """Event ends with no measured point close by."""
    track = track_positions(laser, key, cfg) if track is None else track
    ends = event_endpoints(points)
    columns = ["file_name", "chainage", "lon", "lat"]
    names = [f"near_{c}" for c in columns]
    near = near_places(ends.select(*columns), track, cfg.snap_radius)
    near = near.withColumnsRenamed(dict(zip(columns, names)))
    lonely = ends.join(near, same(ends, near, columns, names), "left_anti")
    return lonely.select(
        "file_name", "chainage", "direction", "event_name", "link_id", "lon", "lat"
    ).distinct()


def one_sided_gaps(points: DataFrame, gaps: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Gap points whose anchors all lie at one chainage (gaps at a link junction)."""
    anchors = gap_anchors(points, gaps, cfg)
    return anchors.filter(F.col("chainage_end") == F.col("chainage_str"))


def lacks_value(cfg: Profile = Profile(), grid_only: bool = False) -> Column:
    """Whether a point lacks a value. The grid test binds to the last column only,
    unless ``grid_only`` asks it of all."""
    grid = on_grid(F.col("chainage"), cfg.grid)
    tests: list[Column] = [F.col(c).isNull() for c in cfg.missing_columns]
    if not grid_only:
        tests[-1] = tests[-1] & grid
    lacking = reduce(lambda a, b: a | b, tests)
    return lacking & grid if grid_only else lacking


def missing_values(
    points: DataFrame, cfg: Profile = Profile(), grid_only: bool = False
) -> DataFrame:
    """Points that lack a value, see ``lacks_value``."""
    return points.filter(lacks_value(cfg, grid_only)).select(
        "file_name", "link_id", "chainage", "iri", "rutting", "texture", "frame_number"
    )


def link_rules(points: DataFrame) -> DataFrame:
    """Links whose id, lane name and direction of kilometres disagree."""
    groups = (
        points.select(
            "file_name", "date", "event_name", "link_id", "section_id", "km_start", "km_end", "lane_no"
        )
        .distinct()
        .withColumns(
            {
                "km_start": km_to_int(F.col("km_start")),
                "km_end": km_to_int(F.col("km_end")),
                "lane_group": lane_group(F.col("link_id")),
            }
        )
    )
    group, kind = F.col("lane_group"), F.left("lane_no", F.lit(1))
    rise = F.col("km_end") - F.col("km_start")
    rule = (
        F.when((group > 0) & (rise < 0), "left_descends")
        .when((group < 0) & (rise > 0), "right_ascends")
        .when(F.col("lane_no").isNull(), "lane_missing")
    )
    by_prefix = {
        "F": (2, "not_frontage"),
        "I": (3, "not_interchange"),
        "U": (4, "not_u_turn"),
        "B": (5, "not_bridge"),
        "T": (6, "not_tunnel"),
    }
    for prefix, (number, code) in by_prefix.items():
        rule = rule.when((kind == prefix) & (F.abs(group) != number), code)
    # numbered before the filter, as the report always was
    order = ["km_start", "link_id", "file_name", "date", "event_name", "section_id", "km_end", "lane_no"]
    numbered = with_row_id(stage(groups, "links"), order, name="id")
    return numbered.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select(
        "id", "file_name", "link_id", "km_start", "km_end", "lane_no", "lane_group", "rule"
    )


def duplicate_positions(points: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Positions a link has at more than one grid point."""
    located = points.filter(
        on_grid(F.col("chainage"), cfg.grid) & has_any_fix(F.col("lon"), F.col("lat"))
    )
    return (
        located.groupBy("file_name", "link_id", "lon", "lat")
        .agg(
            F.min("chainage").alias("min"),
            F.max("chainage").alias("max"),
            F.count("*").alias("count"),
        )
        .filter(F.col("count") > 1)
    )


def duplicate_images(images: DataFrame) -> DataFrame:
    """File names used more than once, and the missing one."""
    return (
        images.groupBy("filename")
        .agg(F.count("filename").alias("cc"))
        .filter((F.col("cc") > 1) | F.col("filename").isNull())
    )
