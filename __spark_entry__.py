"""Entry points for checks: one query per operator, and its SQL twin.

Every query starts from survey-shaped views of the given tables (FIXTURES.md)
and runs over all of them. Results are shown as whole numbers: hundredths or
thousandths of a value, 1e-9 degrees, metres.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import oracle_sql as _oracle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbed.functions import predicates
from roadbed.functions.geometry import interpolate_line, planar_distance
from roadbed.functions.identifiers import decode_link, lane_number
from roadbed.functions.numbers import cap_values
from roadbed.operators import (
    assembly,
    export,
    gps,
    images,
    joins,
    reports,
    series,
    survey,
    survey_points,
)
from roadbed.operators import lines as lines_on
from roadbed.operators.ordering import with_row_id
from roadbed.plans import incremental, pipeline
from roadbed.schema import KEY, LASER, METRICS, WITH_EXPORT, Profile
from roadbed.session import on_workers, stage, stage_root
from roadbed.sources import landing, rejects, sinks
from roadbed.sources import sample_views as views
from roadbed.sources.publication import Publisher

try:  # the training-data operators may be left out of an installation
    import corpus_pipeline as _pipeline
    from roadbed.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "roadbed.llm"):
        raise
    _llm = None

#: the sample links have at most three lost grid points; a random cap cannot be
#: compared between engines by value
CHECKED = Profile(cap_mode="clamp", stop_above=1, report_above=1, interval_export=True)

_DEGREES = {"lon", "lat", "lon_str", "lat_str", "lon_end", "lat_end"}


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers, text and flags instead of decimals, doubles and dates."""
    df = df.select(*columns) if columns else df
    shown = []
    for field in df.schema:
        value, kind = F.col(field.name), field.dataType
        if field.name in _DEGREES:
            value = F.round(value * 1e9).cast("bigint")
        elif isinstance(kind, T.DecimalType):
            value = (value * 10**kind.scale).cast("bigint")
        elif isinstance(kind, T.IntegerType):
            value = value.cast("bigint")
        elif isinstance(kind, T.DoubleType):
            # never cut: a fraction would make different values compare equal
            whole = value == F.rint(value)
            odd = F.raise_error(F.concat(F.lit(f"{field.name} is not whole: "), value.cast("string")))
            value = F.when(whole | value.isNull(), value.cast("bigint")).otherwise(odd.cast("bigint"))
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        shown.append(value.alias(field.name))
    return df.select(*shown)


def _points(spark: SparkSession, sf: str) -> DataFrame:
    tables = views.laser(spark, sf), views.key(spark, sf), views.pic(spark, sf)
    return assembly.assemble_points(*tables, CHECKED)


def _staged_points(spark: SparkSession, sf: str) -> DataFrame:
    return stage(_points(spark, sf), "points")


_POINT_COLUMNS = [
    "file_name", "date", "link_id", "event_str", "event_end", "event_num", "event_type",
    "event_name", "section_id", "km_start", "km_end", "length", "lane_no", "survey_date",
    "chainage", "km2", "iri_old", *METRICS, "chainage_pic", "frame_number", "lon", "lat",
]
_PUBLISHED = ["survey_point_id", "survey_id", "km", *METRICS, "lon", "lat", "remark"]
_GAP = ["file_name", "date", "link_id", "gap_start", "gap_end", "c_p", "meter"]


def _source_merge(spark, sf):
    return plain(landing.build_laser(*views.extracts(spark, sf)))


def _by_run(df: DataFrame, name: str, fmt: str) -> str:
    """Writes ``df`` as files in a folder per run, without the run among the columns."""
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy("file_name").option("header", False).format(fmt).save(path)
    return f"{path}/*"


def _landed_key(spark, sf):
    fields = [f.name for f in KEY]
    path = _by_run(views.key(spark, sf).select(*fields, "file_name"), "key", "csv")
    return plain(landing.read_landed(spark, path, "key"), *fields, "file_name")


def _landed_pic(spark, sf):
    path = _by_run(views.pic(spark, sf).select("chainage_pic", "frame_number", "file_name"), "pic", "csv")
    return plain(landing.read_landed(spark, path, "pic"), "chainage_pic", "frame_number", "file_name")


def _raw_extracts(spark, sf):
    """The four instruments read from files by run, then merged."""
    named = zip(views.extracts(spark, sf), ("gps", "iri", "tpl", "mpd"))
    read = [landing.read_extract(spark, _by_run(df, name, "parquet")) for df, name in named]
    return plain(landing.build_laser(*read))


def _event_extract(spark, sf):
    """Events from a raw extract: its own column names, numbers and padding as they come."""
    raw = views.key(spark, sf).withColumnsRenamed({new: old for old, new in landing.KEY_COLUMNS.items()})
    return plain(landing.build_key(raw), *[f.name for f in KEY], "file_name")


def _picture_extract(spark, sf):
    raw = views.pic(spark, sf).withColumnsRenamed({"chainage_pic": "CHAINAGE", "frame_number": "FRAME"})
    return plain(landing.build_pic(raw), "chainage_pic", "frame_number", "file_name")


def _landed_lines(spark, sf) -> str:
    """Event files in which some lines are spoilt, in a way that follows from the section."""
    fields = [f.name for f in KEY]
    values = {c: F.col(c).cast("bigint").cast("string") for c in ("event_str", "event_end")}
    values |= {c: F.round(F.col(c) * 1e6).cast("bigint").cast("string") for c in _DEGREES & set(fields)}
    k = F.col("section_id").cast("int") % 50
    values["event_str"] = F.when(k.isin(1, 5), "abc").when(k == 6, "").otherwise(values["event_str"])
    values["event_end"] = F.when(k == 2, "12,5").when(k == 5, "1.2.3").otherwise(values["event_end"])
    values["survey_date"] = F.when(k == 4, "2022-13-45").otherwise(F.col("survey_date"))
    shown = [F.coalesce(values.get(c, F.col(c)), F.lit("")) for c in fields]
    shown[-1] = F.concat(F.when(k == 7, '"').otherwise(""), shown[-1])
    line = F.when(k == 3, F.concat_ws(",", *shown[:-1])).otherwise(F.concat_ws(",", *shown))
    path = f"{stage_root(spark)}/lines-{uuid.uuid4().hex}"
    views.key(spark, sf).select("file_name", line.alias("line")).write.partitionBy("file_name").text(path)
    return f"{path}/*"


def _landed_rejects(spark, sf):
    """Every fault of every line, and how many rows of each run were good."""
    landed = rejects.read_with_rejects(spark, _landed_lines(spark, sf), "key")
    run = F.regexp_extract("file_path", landing.RUN_PATTERN, 1).alias("file_name")
    faults = landed.rejects.select(run, "line", "column", "rule", F.lit(None).cast("bigint").alias("n"))
    good = landed.good.groupBy("file_name").agg(F.count("*").alias("n"))
    nothing = F.lit(None).cast("string")
    return faults.union(good.select("file_name", nothing, nothing, F.lit("good"), "n"))


def _publisher(spark, ids: dict[str, str]) -> Publisher:
    return Publisher(spark, f"{stage_root(spark)}/published-{uuid.uuid4().hex}", ids)


def _published_manifest(spark, sf):
    """What two publications of events and one of them again leave in the manifest."""
    publisher = _publisher(spark, {"events": "event_id"})
    events, sections = views.key(spark, sf), views.section_dim(spark, sf)
    left = F.col("km_start") < F.col("km_end")
    for key, own in (("rising", left), ("falling", ~left), ("rising", left)):
        start = publisher.start_ids(key)["events"]
        numbered = with_row_id(events.filter(own), ["file_name", "event_str"], start, "event_id")
        publisher.publish(key, {"events": numbered, "sections": sections})
    entries = publisher.history().select("version", "key", F.inline("tables"))
    return entries.select("version", "key", "name", "n", "before", "last")


def _survey_ids_continue(spark, sf):
    """Survey lines of half the runs, of the other half, and of the first half once more."""
    points = _staged_points(spark, sf)
    publisher = _publisher(spark, {"survey": "survey_id"})
    odd = F.substring("file_name", 8, 1).cast("int") % 2 == 1
    shown = []
    for key, own in (("odd", odd), ("even", ~odd), ("odd", odd)):
        start = publisher.start_ids(key)["survey"]
        version = publisher.publish(key, {"survey": survey.build_survey(points.filter(own), CHECKED, start_id=start)})
        lines = publisher.read("survey", version).withColumn("version", F.lit(version).cast("bigint"))
        shown.append(plain(lines, "version", "survey_id", "file_name", "link_id", "km_start", "km_end"))
    return reduce(DataFrame.union, shown)


_EVENT_INSERTS = [
    "file_name", "event_str", "event_end", "event_name", "link_id", "section_id", "km_start", "km_end", "lane_no",
]


def _insert_files(spark, sf):
    """Statements of sections and then of events, read back from files of bounded length."""
    folder, most = f"{stage_root(spark)}/inserts-{uuid.uuid4().hex}", 20_000
    events = plain(views.key(spark, sf), *_EVENT_INSERTS)
    tables = [
        ("sections", plain(views.section_dim(spark, sf)), ["section_part_id"]),
        ("events", events, ["file_name", "event_str", "section_id"]),
    ]
    files = sinks.write_insert_files(tables, folder, rows_per_statement=40, max_bytes=most)
    lines = spark.read.text([f"{folder}/{name}" for name, _, _ in tables])
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("statement"))
    too_long = F.raise_error(F.lit("a file is too long")).cast("string")
    return lines.join(files, "path").select(
        "table", F.when(F.col("bytes") > most, too_long).otherwise(F.col("statement")).alias("statement")
    )


def _report_order(spark, sf):
    report = reports.gps_lost(views.laser(spark, sf), views.key(spark, sf), CHECKED)
    return plain(sinks.indexed(report, pipeline.REPORT_ORDER["qa_gps_lost"]))


def _section_lookup(spark, sf):
    path = f"{stage_root(spark)}/sections-{uuid.uuid4().hex}"
    dim = views.section_dim(spark, sf)
    dim.withColumns({c: F.col(c).cast("string") for c in ("route", "control")}).write.parquet(path)
    return plain(landing.read_section_dim(spark, path))


def _landed_csv(spark, sf):
    """Measured points written as header-less CSV, blank where NULL, and landed."""
    path = f"{stage_root(spark)}/landed-{uuid.uuid4().hex}"
    laser = views.laser(spark, sf).select(*LASER.fieldNames())
    laser.write.option("header", False).csv(path)
    return plain(landing.read_landed(spark, path, "laser"))


def _pavement_events(spark, sf):
    columns = ["file_name", "event_str", "event_end", "event_name", "link_id", "date"]
    return plain(assembly.pavement_events(views.key(spark, sf)), *columns)


def _decode_link(spark, sf):
    decoded = decode_link(views.key(spark, sf))
    return plain(
        decoded.withColumn("lane_number", lane_number(F.col("lane_no"))),
        "link_id", "file_name", "section_id", "district", "route", "control", "road_code",
        "lane_group", "survey_type", "survey_code", "run_code", "lane_number",
    )


def _grid_points(spark, sf):
    lon, lat = F.col("lon"), F.col("lat")
    tests = ("is_lost", "has_any_fix", "has_fix", "has_north_fix", "has_positive_fix")
    flags = [getattr(predicates, name)(lon, lat).alias(name) for name in tests]
    grid = views.laser(spark, sf).filter(predicates.on_grid(F.col("chainage")))
    return plain(grid.select("file_name", "chainage", *flags))


def _padded_band_join(spark, sf, sweep=False):
    joined = assembly.padded_band_join(views.laser(spark, sf), views.key(spark, sf), CHECKED, sweep)
    return plain(
        joined, "file_name", "date", "link_id", "event_name", "event_str", "event_end",
        "chainage", "lon", "lat",
    )


def _padded_sweep_join(spark, sf):
    on_workers(spark)
    return _padded_band_join(spark, sf, sweep=True)


def _band_join_points(spark, sf):
    tables = views.laser(spark, sf), views.key(spark, sf), views.pic(spark, sf)
    return plain(assembly.points_in_events(*tables, CHECKED), *_POINT_COLUMNS)


def _cap_flags(spark, sf):
    capped = cap_values(
        views.laser(spark, sf), ["iri_right", "iri_left"], ["file_name", "chainage"]
    )
    in_range = (F.col("iri_right") <= 8) & (F.col("iri_left") <= 8)
    for name in ("iri_right", "iri_left"):
        kept = F.col(name) == F.col(f"{name}_raw")
        in_range = in_range & F.when(F.col(f"{name}_imputed"), F.col(name) >= 7).otherwise(kept)
    flags = [f"{c}_{s}" for c in ("iri_right", "iri_left") for s in ("raw", "imputed")]
    return plain(capped.select("file_name", "chainage", *flags, in_range.alias("in_range")))


def _link_status(spark, sf):
    return plain(assembly.link_status(views.laser(spark, sf), views.key(spark, sf), CHECKED))


def _assemble_points(spark, sf):
    return plain(_points(spark, sf), *_POINT_COLUMNS, "status", "status_type")


def _gps_islands(spark, sf):
    return plain(gps.gps_islands(_staged_points(spark, sf), CHECKED), *_GAP)


def _gps_islands_compat(spark, sf):
    cfg = Profile(cap_mode="clamp", stop_above=1, compat=True)
    return plain(gps.gps_islands(_staged_points(spark, sf), cfg), *_GAP)


def _gps_gaps(spark, sf):
    gaps = gps.gps_gaps(_staged_points(spark, sf), CHECKED)
    return plain(gaps, *_GAP, "chainage", "new_p_min", "new_p_max")


def _with_gaps(spark, sf):
    points = _staged_points(spark, sf)
    return points, stage(gps.gps_gaps(points, CHECKED), "gaps")


_ANCHOR = [*_GAP, "chainage", "new_p_min", "new_p_max", "chainage_str", "chainage_end"]


def _gap_anchors(spark, sf):
    return plain(gps.gap_anchors(*_with_gaps(spark, sf), CHECKED), *_ANCHOR)


def _qa_gap_one_sided(spark, sf):
    return plain(reports.one_sided_gaps(*_with_gaps(spark, sf), CHECKED), *_ANCHOR)


def _repair_gps(spark, sf):
    repaired = gps.repair_gps(*_with_gaps(spark, sf), CHECKED)
    columns = ["file_name", "date", "link_id", "event_str", "chainage", "lon", "lat", "gps_imputed"]
    return plain(repaired, *columns)


def _repair_all_points(spark, sf):
    """Every lost point, not only those on the grid, and gaps within one link."""
    points = _staged_points(spark, sf)
    islands = gps.gps_islands(points, CHECKED)
    gaps = gps.gap_points(points, islands, CHECKED, same_link=True, all_points=True)
    repaired = gps.repair_gps(points, stage(gaps, "gaps"), CHECKED)
    columns = ["file_name", "date", "link_id", "event_str", "chainage", "lon", "lat", "gps_imputed"]
    return plain(repaired, *columns)


def _place_on_dense_lines(spark, sf):
    """A point on each order's straight line of 5, 9 or 11 vertices, at a vertex."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    size = F.element_at(F.array(F.lit(5), F.lit(9), F.lit(11)), (F.col("k") % 3 + 1).cast("int"))
    step = F.when(F.col("k") % 2 == 0, 20 / 7).otherwise(20 / 11) * 1e-6
    lines = orders.select("k", size.alias("size"), step.alias("step"))
    vertices = lines.select("k", "step", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("m"))
    vertices = vertices.select(
        "k", F.col("m").cast("double").alias("m"), (F.col("m") * F.col("step")).alias("lon"),
        (F.col("m") * F.col("step") / 2).alias("lat"),
    )
    at = (F.col("k") % 5) * F.floor((F.col("size") - 1) / 4) / (F.col("size") - 1)
    targets = lines.select("k", at.cast("double").alias("fraction"))
    placed = lines_on.place_on_lines(targets, vertices, ["k"])
    return placed.select(
        "k", F.round(F.col("new_lon") * 1e12).cast("bigint").alias("lon"),
        F.round(F.col("new_lat") * 1e12).cast("bigint").alias("lat"),
    )


def _event_endpoints(spark, sf):
    return plain(gps.event_endpoints(_points(spark, sf)))


def _distance_join(spark, sf):
    """Event ends with the measured points of other chainage close to them."""
    ends = gps.event_endpoints(_points(spark, sf))
    measured = gps.measured_near_events(views.laser(spark, sf), views.key(spark, sf), CHECKED)
    measured = measured.select(
        "file_name",
        F.col("chainage").alias("point_chainage"),
        F.col("lon").alias("point_lon"),
        F.col("lat").alias("point_lat"),
    ).distinct()
    pairs = joins.distance_join(ends, measured, CHECKED.snap_radius)
    place = ["file_name", "chainage", "direction", "event_name", "link_id", "lon", "lat"]
    return plain(
        pairs.filter(F.col("point_chainage") != F.col("chainage"))
        .groupBy(*place)
        .agg(F.min("point_chainage").alias("chainage_data"), F.count("*").alias("n_points"))
    )


def _snap_endpoints(spark, sf):
    points = _staged_points(spark, sf)
    snapped = gps.snap_endpoints(points, views.laser(spark, sf), views.key(spark, sf), CHECKED)
    return plain(
        snapped, "file_name", "date", "link_id", "event_str", "event_end", "chainage",
        "lon_str", "lat_str", "lon_end", "lat_end",
    )


def _smooth_condition(spark, sf):
    smoothed = series.smooth_condition(_staged_points(spark, sf))
    return plain(smoothed, "file_name", "date", "link_id", "event_str", "chainage", *METRICS)


def _smooth_by_link(spark, sf):
    smoothed = series.smooth_condition(_staged_points(spark, sf), by_link=True)
    return plain(smoothed, "file_name", "date", "link_id", "event_str", "chainage", *METRICS)


def _interpolate_rutting(spark, sf):
    rutting = series.interpolate_rutting(views.laser(spark, sf))
    return plain(rutting, "file_name", "chainage", "rutt_right", "rutt_left", "rutting")


def _apply_corrections(spark, sf):
    points = _staged_points(spark, sf)
    links = points.select("file_name", "chainage", "link_id")
    fixes = views.corrections(spark, sf).join(links, ["file_name", "chainage"])
    corrected = assembly.apply_corrections(points, fixes)
    columns = ["file_name", "date", "link_id", "event_str", "chainage", "lon", "lat"]
    return plain(corrected, *columns)


def _build_survey(spark, sf):
    lines = survey.build_survey(_staged_points(spark, sf), CHECKED)
    return plain(lines.drop("the_geom"))


def _survey_line_parts(spark, sf):
    points = _staged_points(spark, sf)
    lines = survey.build_survey(points, CHECKED)
    parts = survey.parts_with_survey_id(survey.survey_line_parts(points, CHECKED), lines)

    def micro(value):
        return F.round(value * 1e6).cast("bigint").cast("string")

    vertex = F.transform(
        "line",
        lambda v: F.concat_ws(":", v.m.cast("bigint").cast("string"), micro(v.lon), micro(v.lat)),
    )
    return parts.select(
        "survey_id",
        "part_no",
        F.size("line").cast("bigint").alias("n_vertices"),
        F.array_join(vertex, " ").alias("vertices"),
    )


def _line_interpolation(spark, sf):
    """Middle of every survey line: as far from its start as from its end."""
    lines = survey.build_survey(_staged_points(spark, sf), CHECKED)
    middle = interpolate_line(F.col("the_geom"), F.lit(0.5))
    placed = lines.select("survey_id", "the_geom", middle.alias("middle"))
    first = F.element_at("the_geom", 1)
    reach = planar_distance(first.lon, first.lat, F.col("middle.lon"), F.col("middle.lat"))
    return plain(
        placed.select("survey_id", "middle.lon", "middle.lat", F.round(reach * 1e9).alias("reach"))
    )


def _local(spark, sf):
    points = _staged_points(spark, sf)
    laser = views.laser(spark, sf)
    lines = stage(survey.build_survey(points, CHECKED), "survey")
    local = survey_points.build_survey_point_local(points, laser, lines, CHECKED)
    return points, lines, local


def _survey_point_local(spark, sf):
    return plain(_local(spark, sf)[2])


def _survey_point(spark, sf):
    return plain(survey_points.build_survey_point(_local(spark, sf)[2]), *_PUBLISHED)


def _csv_export(spark, sf):
    """The published points written as CSV and read back."""
    published = plain(survey_points.build_survey_point(_local(spark, sf)[2]), *_PUBLISHED)
    path = f"{stage_root(spark)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(published, path, ["survey_point_id"])
    schema = T.StructType([T.StructField("index", T.LongType()), *published.schema])
    return spark.read.schema(schema).option("header", True).csv(path)


def _images(spark, sf):
    points, lines, local = _local(spark, sf)
    local = stage(local, "local")
    return lines, local, stage(images.build_survey_image(local, points, CHECKED), "images")


def _survey_image(spark, sf):
    return plain(_images(spark, sf)[2])


def _qa_duplicate_images(spark, sf):
    return plain(reports.duplicate_images(_images(spark, sf)[2]))


def _dedupe_images(spark, sf):
    return plain(images.dedupe_images(_images(spark, sf)[2]))


def _image_dirs(spark, sf):
    return images.image_dirs(images.dedupe_images(_images(spark, sf)[2]))


def _image_copy_manifest(spark, sf):
    return images.image_copy_manifest(images.dedupe_images(_images(spark, sf)[2]))


def _insert_statements(spark, sf):
    """All columns of the three published tables; lines are tested on their own."""
    lines, local, pictures = _images(spark, sf)
    surveyed = lines.drop("the_geom", *pipeline.SURVEY_HELPERS)
    tables = {
        "survey": surveyed,
        "survey_point": survey_points.build_survey_point(local),
        "survey_image": images.dedupe_images(pictures),
    }
    statements = [sinks.to_insert_statements(plain(df), name) for name, df in tables.items()]
    return statements[0].union(statements[1]).union(statements[2])


def _interval_lengths(spark, sf):
    _, lines, local = _local(spark, sf)
    rows = local.join(lines.select("survey_id", "km_start"), "survey_id", "left")
    measured = export.interval_lengths(rows, CHECKED)
    return plain(measured, "survey_id", "survey_point_id", "chainage", "interval", "km_sum")


def _interval_lengths_compat(spark, sf):
    """Kilometres summed over all surveys that start at the same kilometre."""
    _, lines, local = _local(spark, sf)
    rows = local.join(lines.select("survey_id", "km_start"), "survey_id", "left")
    measured = export.interval_lengths(stage(rows, "rows"), Profile(compat=True))
    return plain(measured, "survey_id", "survey_point_id", "chainage", "interval", "km_sum")


def _interval_export(spark, sf):
    lines, local, pictures = _images(spark, sf)
    renamed = images.dedupe_images(pictures)
    dim = views.section_dim(spark, sf)
    return plain(export.interval_export(local, renamed, lines, dim, CHECKED))


def _interval_export_csv(spark, sf):
    """The interval export as one CSV file, read back."""
    on_workers(spark)
    rows = _interval_export(spark, sf)
    path = sinks.local_path(f"{stage_root(spark)}/intervals-{uuid.uuid4().hex}.csv")
    sinks.write_csv_file(rows, path, ["road_id", "section_code", "km_start", "km_end"])
    schema = T.StructType([T.StructField("index", T.LongType()), *rows.schema])
    return spark.read.schema(schema).option("header", True).csv(f"file://{path}").drop("index")


def _qa_gps_lost(spark, sf):
    return plain(reports.gps_lost(views.laser(spark, sf), views.key(spark, sf), CHECKED))


def _qa_links_dropped(spark, sf):
    """Links without a grid point near them, on a 200 m grid."""
    coarse = Profile(cap_mode="clamp", stop_above=1, grid=200.0)
    return plain(assembly.links_dropped(views.laser(spark, sf), views.key(spark, sf), coarse))


def _qa_endpoints(spark, sf):
    tables = _staged_points(spark, sf), views.laser(spark, sf), views.key(spark, sf)
    return plain(reports.endpoints_off_track(*tables, CHECKED))


def _qa_missing(spark, sf):
    return plain(reports.missing_values(_points(spark, sf), CHECKED))


def _qa_link_rules(spark, sf):
    return plain(reports.link_rules(_points(spark, sf)))


def _qa_duplicate_positions(spark, sf):
    return plain(reports.duplicate_positions(_points(spark, sf), CHECKED))


def _inputs(spark, sf):
    return pipeline.Inputs(
        views.laser(spark, sf), views.key(spark, sf), views.pic(spark, sf),
        views.section_dim(spark, sf),
    )


def _pipeline_survey(spark, sf):
    """Survey lines of the fully conditioned points."""
    points = pipeline.condition_points(_inputs(spark, sf), CHECKED)["points"]
    return plain(survey.build_survey(points, CHECKED).drop("the_geom"))


def _conditioned_local(spark, sf):
    stages = pipeline.condition_points(_inputs(spark, sf), CHECKED)
    points = stages["points"]
    lines = stage(survey.build_survey(points, CHECKED), "survey")
    local = survey_points.build_survey_point_local(points, stages["laser"], lines, CHECKED)
    return points, local


def _pipeline_survey_point(spark, sf):
    return plain(survey_points.build_survey_point(_conditioned_local(spark, sf)[1]), *_PUBLISHED)


def _pipeline_survey_image(spark, sf):
    points, local = _conditioned_local(spark, sf)
    pictures = stage(images.build_survey_image(stage(local, "local"), points, CHECKED), "images")
    return plain(images.dedupe_images(pictures))


def _pipeline_survey_point_local(spark, sf):
    return plain(_conditioned_local(spark, sf)[1])


def _qa_summary(spark, sf):
    """What was counted while the stages were written."""
    return pipeline.condition_points(_inputs(spark, sf), CHECKED)["qa_summary"]


def _qa_unrepaired(spark, sf):
    """Lost points of gaps without a measured point on both sides."""
    stages = pipeline.condition_points(_inputs(spark, sf), CHECKED)
    left = gps.unrepaired_points(stages["points"], stages["gaps"], CHECKED)
    return plain(left, *_GAP, "chainage", "new_p_min", "new_p_max")


def _qa_duplicate_images_after(spark, sf):
    """Names that are used more than once also after the renaming."""
    points, local = _conditioned_local(spark, sf)
    pictures = stage(images.build_survey_image(stage(local, "local"), points, CHECKED), "images")
    return plain(reports.duplicate_images(images.dedupe_images(pictures)))


#: the export programme as shipped, made comparable like ``CHECKED``
EXPORTED = replace(WITH_EXPORT, cap_mode="clamp", stop_above=1, report_above=1)


def _pipeline_export_profile_survey_point(spark, sf):
    tables = pipeline.run_pipeline(_inputs(spark, sf), EXPORTED)
    return plain(tables["survey_point"], *_PUBLISHED)


def _pipeline_interval_export(spark, sf):
    return plain(pipeline.run_pipeline(_inputs(spark, sf), EXPORTED)["interval_export"])


def _pipeline_changed_runs(spark, sf):
    """All points after a publication of other values for some runs and one of the true ones."""
    true = _inputs(spark, sf)
    even = F.substring("file_name", 8, 1).cast("int") % 2 == 0
    rutting = F.when(even, F.col("rutting") + 1).otherwise(F.col("rutting")).cast("decimal(8,2)")
    publisher = _publisher(spark, incremental.IDS)
    once = replace(true, laser=true.laser.withColumn("rutting", rutting))
    incremental.condition_changed(publisher, "once", once, CHECKED)
    incremental.condition_changed(publisher, "again", true, CHECKED)
    points = incremental.read_runs(publisher, "survey_point_local")
    # ids of runs that were worked out again go on behind the first ones
    return plain(points.drop("survey_id", "survey_point_id"))


def entry(spark: SparkSession) -> DataFrame:
    """Every GPS gap: its link, first and last chainage, points and metres."""
    return _gps_islands(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    more = {} if _llm is None else {**_llm.queries(), "pipeline": _pipeline.run}
    return more | {
        "source_merge": _source_merge,
        "landed_csv": _landed_csv,
        "landed_key": _landed_key,
        "landed_pic": _landed_pic,
        "raw_extracts": _raw_extracts,
        "section_lookup": _section_lookup,
        "event_extract": _event_extract,
        "picture_extract": _picture_extract,
        "landed_rejects": _landed_rejects,
        "published_manifest": _published_manifest,
        "survey_ids_continue": _survey_ids_continue,
        "report_order": _report_order,
        "insert_files": _insert_files,
        "pavement_events": _pavement_events,
        "decode_link": _decode_link,
        "grid_points": _grid_points,
        "padded_band_join": _padded_band_join,
        "padded_sweep_join": _padded_sweep_join,
        "band_join_points": _band_join_points,
        "cap_flags": _cap_flags,
        "link_status": _link_status,
        "assemble_points": _assemble_points,
        "gps_islands": _gps_islands,
        "gps_islands_compat": _gps_islands_compat,
        "gps_gaps": _gps_gaps,
        "gap_anchors": _gap_anchors,
        "repair_gps": _repair_gps,
        "repair_all_points": _repair_all_points,
        "place_on_dense_lines": _place_on_dense_lines,
        "event_endpoints": _event_endpoints,
        "distance_join": _distance_join,
        "snap_endpoints": _snap_endpoints,
        "smooth_condition": _smooth_condition,
        "smooth_by_link": _smooth_by_link,
        "interpolate_rutting": _interpolate_rutting,
        "apply_corrections": _apply_corrections,
        "build_survey": _build_survey,
        "survey_line_parts": _survey_line_parts,
        "line_interpolation": _line_interpolation,
        "survey_point_local": _survey_point_local,
        "survey_point": _survey_point,
        "survey_image": _survey_image,
        "dedupe_images": _dedupe_images,
        "interval_lengths": _interval_lengths,
        "interval_lengths_compat": _interval_lengths_compat,
        "interval_export": _interval_export,
        "interval_export_csv": _interval_export_csv,
        "image_dirs": _image_dirs,
        "image_copy_manifest": _image_copy_manifest,
        "insert_statements": _insert_statements,
        "csv_export": _csv_export,
        "qa_gps_lost": _qa_gps_lost,
        "qa_links_dropped": _qa_links_dropped,
        "qa_endpoints": _qa_endpoints,
        "qa_gap_one_sided": _qa_gap_one_sided,
        "qa_missing": _qa_missing,
        "qa_link_rules": _qa_link_rules,
        "qa_duplicate_positions": _qa_duplicate_positions,
        "qa_duplicate_images": _qa_duplicate_images,
        "pipeline_survey": _pipeline_survey,
        "pipeline_survey_point": _pipeline_survey_point,
        "pipeline_survey_image": _pipeline_survey_image,
        "pipeline_survey_point_local": _pipeline_survey_point_local,
        "pipeline_export_profile_survey_point": _pipeline_export_profile_survey_point,
        "pipeline_interval_export": _pipeline_interval_export,
        "pipeline_changed_runs": _pipeline_changed_runs,
        "qa_summary": _qa_summary,
        "qa_unrepaired": _qa_unrepaired,
        "qa_duplicate_images_after": _qa_duplicate_images_after,
    }


def oracle_sql() -> dict[str, str]:
    """SQL twins, for every key of ``queries()`` that SQL can express."""
    return _oracle.oracle_sql() | ({} if _llm is None else _llm.oracle_sql())
