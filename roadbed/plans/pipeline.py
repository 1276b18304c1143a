"""The conditioning pipeline, from landed tables to published ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from roadbed.operators import assembly, export, gps, images, reports, series, survey, survey_points
from roadbed.operators.ordering import largest_group
from roadbed.schema import Profile
from roadbed.session import stage
from roadbed.sources.sinks import to_insert_statements, write_csv, write_lines, write_table


#: keys the survey table carries beside what is published of it
SURVEY_HELPERS = ("event_name", "file_name", "line_parts")
#: the order reports are read in; missing values last
REPORT_ORDER = {
    "qa_links_dropped": ["link_id", "date", "file_name"],
    "qa_gps_lost": ["link_id", "date", "file_name"],
    "qa_endpoints": ["chainage", "link_id", "file_name", "direction"],
    "qa_gap_one_sided": ["gap_start", "link_id", "file_name", "chainage"],
    "qa_unrepaired": ["gap_start", "link_id", "file_name", "chainage"],
    "qa_missing": ["chainage", "link_id", "file_name"],
    "qa_link_rules": ["id"],
    "qa_duplicate_positions": ["min", "count", "link_id", "file_name", "lon", "lat"],
    "qa_duplicate_images": ["filename"],
    "qa_duplicate_images_after": ["filename"],
}


#: reports that have no row if this metric is 0
EMPTY_IF_ZERO = {
    "qa_missing": "missing_values",
    "qa_gap_one_sided": "gap_points",
    "qa_unrepaired": "still_lost",
}


class Tables(Mapping[str, DataFrame]):
    """Tables by name; one that is given as a function is built when it is asked for, once."""

    def __init__(self, made: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._made = dict(made)

    def __getitem__(self, name: str) -> DataFrame:
        table = self._made[name]
        if not isinstance(table, DataFrame):
            table = self._made[name] = table()
        return table

    def __iter__(self) -> Iterator[str]:
        return iter(self._made)

    def __len__(self) -> int:
        return len(self._made)


@dataclass(frozen=True)
class Inputs:
    """Landed tables of any number of runs."""

    laser: DataFrame
    key: DataFrame
    pic: DataFrame
    section_dim: DataFrame | None = None
    corrections: DataFrame | None = None


def condition_points(
    inputs: Inputs, cfg: Profile = Profile(), max_rows: int | None = None
) -> dict[str, DataFrame]:
    """Point table, version by version, and the gaps found on the way.

    What is read several times is written once. Ends and lost points are moved
    on the way to the smoothing, in one pass over the points: both are found on
    the assembled table, and so is the size of the largest run. What the reports
    need to know is counted while the tables are written.
    """
    laser = inputs.laser
    if cfg.reinterpolate_rutting:
        laser = series.interpolate_rutting(laser, max_rows=max_rows)
    laser = stage(laser, "laser")
    counts = [Observation(name) for name in ("assembled", "gaps", "points")]
    assembled = assembly.assemble_points(laser, inputs.key, inputs.pic, cfg).observe(
        counts[0],
        F.count("*").alias("points"),
        F.count_if(gps.is_lost_point(cfg)).alias("lost_points"),
        F.count_if(reports.lacks_value(cfg)).alias("missing_values"),
    )
    assembled = stage(assembled, "assembled")
    gaps = gps.gps_gaps(assembled, cfg, max_rows=max_rows).observe(counts[1], F.count("*").alias("gap_points"))
    gaps = stage(gaps, "gaps")
    track = gps.track_positions(laser, inputs.key, cfg)
    # gap points are grid points: the others are not shuffled for their positions
    moved = gps.move_points(assembled, gps.gap_positions(assembled, gaps, cfg, max_rows), cfg.grid)
    points = gps.snap_endpoints(assembled, laser, inputs.key, cfg, max_rows, track, moved)
    if inputs.corrections is not None:
        points = assembly.apply_corrections(points, inputs.corrections)
    longest = largest_group(assembled, ["file_name"])
    smoothed = series.smooth_condition(points, max_rows=max_rows, largest=longest)
    smoothed = smoothed.observe(counts[2], F.count_if(gps.is_lost_point(cfg)).alias("still_lost"))
    points = stage(smoothed, "points")
    found = [(name, n) for observed in counts for name, n in observed.get.items()]
    return {
        "laser": laser,
        "track": track,
        "assembled": assembled,
        "gaps": gaps,
        "points": points,
        # a row for each metric
        "qa_summary": laser.sparkSession.createDataFrame(found, "metric string, n bigint"),
    }


def run_pipeline(
    inputs: Inputs, cfg: Profile = Profile(), max_rows: int | None = None
) -> Tables:
    """All published tables and reports by name; reports are built when they are asked for."""
    stages = condition_points(inputs, cfg, max_rows)
    laser, assembled, gaps = stages["laser"], stages["assembled"], stages["gaps"]
    points = stages["points"]
    vertices = stage(survey.survey_vertices(points, cfg), "vertices")
    lines = survey.build_survey(points, cfg, max_rows=max_rows, vertices=vertices)
    lines = stage(lines, "survey")
    parts = survey.survey_line_parts(points, cfg, max_rows=max_rows, vertices=vertices)
    local = stage(
        survey_points.build_survey_point_local(points, laser, lines, cfg, max_rows=max_rows),
        "survey_point_local",
    )
    pictures = stage(images.build_survey_image(local, points, cfg), "pictures")
    renamed = stage(images.dedupe_images(pictures, max_rows), "survey_image")
    before_or_after = assembled if cfg.duplicates_before_repair else points
    result = {
        **stages,
        "survey": lines,
        "survey_line_parts": survey.parts_with_survey_id(parts, lines),
        "survey_point_local": local,
        "survey_point": survey_points.build_survey_point(local),
        "survey_image": renamed,
        "image_dirs": images.image_dirs(renamed, cfg.image_target),
        "image_copy_manifest": images.image_copy_manifest(renamed, cfg.image_source, cfg.image_target),
        "qa_links_dropped": lambda: assembly.links_dropped(laser, inputs.key, cfg),
        "qa_gps_lost": lambda: reports.gps_lost(laser, inputs.key, cfg),
        "qa_endpoints": lambda: reports.endpoints_off_track(assembled, laser, inputs.key, cfg, stages["track"]),
        "qa_gap_one_sided": lambda: reports.one_sided_gaps(assembled, gaps, cfg),
        "qa_unrepaired": lambda: gps.unrepaired_points(points, gaps, cfg),
        "qa_missing": lambda: reports.missing_values(assembled, cfg),
        "qa_link_rules": lambda: reports.link_rules(assembled),
        "qa_duplicate_positions": lambda: reports.duplicate_positions(before_or_after, cfg),
        "qa_duplicate_images": lambda: reports.duplicate_images(pictures),
        # names the renaming has made equal to others show here
        "qa_duplicate_images_after": lambda: reports.duplicate_images(renamed),
    }
    if cfg.interval_export and inputs.section_dim is not None:
        # after the renaming, so that image_url names the final file
        result["interval_export"] = lambda: export.interval_export(
            local, renamed, lines, inputs.section_dim, cfg, max_rows
        )
    return Tables(result)


def reports_with_rows(tables: Mapping[str, DataFrame]) -> list[str]:
    """Names of the reports that may have rows, by what was counted on the way."""
    n = {r.metric: r.n for r in tables["qa_summary"].collect()} if "qa_summary" in tables else {}
    return [name for name in REPORT_ORDER if n.get(EMPTY_IF_ZERO.get(name), 1)]


def publish(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write the published tables, the scripts that go with them, and the reports.

    Reports that are known to be empty are not built, and have no folder.
    """
    # by day: a folder for each run would be too many
    by_day = ("survey", "survey_point_local", "survey_image")
    for name in ("survey", "survey_line_parts", "survey_point_local", "survey_point", "survey_image"):
        keys = (["date"], ["file_name"]) if name in by_day else ()
        write_table(tables[name], f"{folder}/{name}", *keys)
    for name in ("survey", "survey_point", "survey_image"):
        published = tables[name].drop(*SURVEY_HELPERS) if name == "survey" else tables[name]
        statements = to_insert_statements(published, name)
        write_lines(statements, "statement", f"{folder}/sql/{name}")
    write_lines(tables["image_dirs"], "line", f"{folder}/mkdir")
    write_lines(tables["image_copy_manifest"], "line", f"{folder}/copy")
    for name in reports_with_rows(tables):
        write_csv(tables[name], f"{folder}/reports/{name}", REPORT_ORDER[name])
    if "interval_export" in tables:
        order = ["road_code", "section_code", "section_part_id", "km_start", "km_end"]
        write_csv(tables["interval_export"], f"{folder}/interval_export", order)
