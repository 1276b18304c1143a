"""Survey lines: one row per surveyed link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.functions import identifiers as ids
from roadbed.functions.geometry import geodesic_segment
from roadbed.functions.numbers import bround_int, km_to_int
from roadbed.functions.predicates import has_positive_fix, inside_event, on_grid
from roadbed.operators.lines import line_parts
from roadbed.operators.ordering import OrderedGroups, same, with_row_id
from roadbed.schema import Profile
from roadbed.session import stage

LINE = [
    "event_name", "link_id", "section_id", "km_start", "km_end",
    "length", "lane_no", "date", "file_name",
]

#: vertices in one geometry array; longer lines come in several parts
PART_ROWS = 10_000


def survey_vertices(points: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Distinct event ends and located grid points of every line.

    Each point row names up to three vertices, so the points are read once and
    repeats collapse before the shuffle.
    """

    def vertex(chainage: str, lon: str, lat: str) -> Column:
        return F.struct(
            F.col(chainage).alias("chainage"), F.col(lon).alias("lon"), F.col(lat).alias("lat")
        )

    on_line = (
        inside_event()
        & has_positive_fix(F.col("lon"), F.col("lat"))
        & on_grid(F.col("chainage"), cfg.grid)
    )
    vertices = F.array_compact(
        F.array(
            vertex("event_str", "lon_str", "lat_str"),
            vertex("event_end", "lon_end", "lat_end"),
            F.when(on_line, vertex("chainage", "lon", "lat")),
        )
    )
    surveyed = (F.col("link_id") != "construction") & (
        F.replace("length", F.lit(" "), F.lit("")).cast("double") > 0
    )
    return points.filter(surveyed).select(*LINE, F.explode(vertices).alias("v")).select(
        *LINE, "v.*"
    ).distinct()


def numbered_vertices(
    vertices: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """Vertices with their number in the line and the metres from the one before."""
    before = F.struct("lon", "lat")
    length = geodesic_segment(
        F.col("before.lon"), F.col("before.lat"), F.col("lon"), F.col("lat")
    )
    return (
        OrderedGroups(vertices, LINE, ["chainage", "lon", "lat"], max_rows)
        .frames({"before": lambda w: F.lag(before).over(w)}, before=1, after=0)
        .row_number("vertex_no")
        .to_df()
        .withColumn("metres", length)
        .drop("before")
    )


def survey_line_parts(
    points: DataFrame,
    cfg: Profile = Profile(),
    part_rows: int = PART_ROWS,
    max_rows: int | None = None,
    vertices: DataFrame | None = None,
) -> DataFrame:
    """The whole geometry of every line, in parts of bounded size."""
    if vertices is None:
        vertices = stage(survey_vertices(points, cfg), "vertices")
    numbered = numbered_vertices(vertices, max_rows)
    return line_parts(numbered, LINE, "vertex_no", part_rows)


def build_survey(
    points: DataFrame,
    cfg: Profile = Profile(),
    start_id: int | None = None,
    part_rows: int = PART_ROWS,
    max_rows: int | None = None,
    vertices: DataFrame | None = None,
) -> DataFrame:
    """The survey table, with file_name and event_name added as keys.

    ``the_geom`` has every vertex, whatever the length; it is put together from
    parts, which ``line_parts`` counts and ``survey_line_parts`` holds.
    """
    # measured, then numbered: join up the vertices once
    if vertices is None:
        vertices = stage(survey_vertices(points, cfg), "vertices")
    numbered = numbered_vertices(vertices, max_rows)
    # two steps: bounded arrays first, then one row per line
    part = F.floor((F.col("vertex_no") - 1) / part_rows).cast("bigint")
    vertex = F.struct(F.col("chainage").alias("m"), "lon", "lat")
    parts = numbered.groupBy(*LINE, part.alias("part_no")).agg(
        F.sum("metres").alias("metres"),
        F.min("chainage").alias("chainage_str"),
        F.array_sort(F.collect_list(vertex)).alias("line"),
    )
    lines = parts.groupBy(*LINE).agg(
        F.sum("metres").alias("metres"),
        F.min("chainage_str").alias("chainage_str"),
        F.count("*").alias("line_parts"),
        F.array_sort(F.collect_list(F.struct("part_no", "line"))).alias("parts"),
    )
    link, km_start, km_end = F.col("link_id"), km_to_int(F.col("km_start")), km_to_int(F.col("km_end"))
    side = F.substring(F.right(link, F.lit(6)), 1, 1)
    kilometres = (F.coalesce(F.col("metres"), F.lit(0.0)) / 1000).cast("decimal(8,3)")
    described = lines.select(
        F.lit(None).cast("int").alias("subsection_id"),
        F.col("section_id").cast("int").alias("section_id"),
        "link_id",
        ids.survey_code(link).alias("survey_code"),
        ids.run_code(link).alias("run_code"),
        ids.lane_group(link).alias("lane_group"),
        ids.lane_number(F.col("lane_no")).alias("lane_no"),
        F.lit(None).cast("int").alias("lane_reverse"),
        km_start.alias("km_start"),
        km_end.alias("km_end"),
        F.when(side == "L", km_end - km_start).when(side == "R", km_start - km_end).alias("length"),
        kilometres.alias("distance_odo"),
        kilometres.alias("distance_gps"),
        F.year("date").alias("year"),
        ids.survey_type(link).alias("survey_type"),
        "date",
        F.flatten(F.transform("parts", lambda p: p["line"])).alias("the_geom"),
        F.lit(cfg.remark).alias("remark"),
        F.lit(cfg.run_tag).alias("run_new"),
        F.lit(25).alias("interval"),
        "event_name",
        "file_name",
        bround_int(F.col("chainage_str")).alias("chainage_str"),
        "line_parts",
    )
    start = cfg.survey_start_id if start_id is None else start_id
    order = ["chainage_str", "link_id", "file_name", "event_name", "section_id", "km_start", "km_end"]
    # ids are given in range order, which samples its input first
    described = stage(described, "lines")
    numbered_lines = with_row_id(described, order, start, "survey_id").drop("chainage_str")
    return numbered_lines.select("survey_id", *[c for c in numbered_lines.columns if c != "survey_id"])


def parts_with_survey_id(parts: DataFrame, survey: DataFrame) -> DataFrame:
    """Line parts keyed by survey_id."""
    keys = ["event_name", "link_id", "date", "file_name", "section_id", "km_start", "km_end"]
    typed = parts.withColumns(
        {
            "section_id": F.col("section_id").cast("int"),
            "km_start": km_to_int(F.col("km_start")),
            "km_end": km_to_int(F.col("km_end")),
        }
    )
    named = survey.select("survey_id", *[F.col(k).alias(f"s_{k}") for k in keys])
    match = same(typed, named, keys, [f"s_{k}" for k in keys])
    return typed.join(named, match).select("survey_id", "part_no", "line")
