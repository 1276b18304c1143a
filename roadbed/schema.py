"""Landed table schemas and the settings of a conditioning run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_METRIC = T.DecimalType(8, 2)
#: a mean of two 2-digit values needs a third digit to stay exact
_MEAN = T.DecimalType(9, 3)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LASER = _struct(
    ("chainage", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("lat", T.DoubleType()),
    ("iri_right", _METRIC),
    ("iri_left", _METRIC),
    ("iri", _MEAN),
    ("iri_lane", _METRIC),
    ("rutt_right", _METRIC),
    ("rutt_left", _METRIC),
    ("rutting", _METRIC),
    ("texture", _METRIC),
    ("etd_texture", _METRIC),
    ("file_name", T.StringType()),
)

KEY = _struct(
    ("event_str", T.DoubleType()),
    ("event_end", T.DoubleType()),
    ("event_num", T.StringType()),
    ("event_type", T.StringType()),
    ("event_name", T.StringType()),
    ("link_id", T.StringType()),
    ("section_id", T.StringType()),
    ("km_start", T.StringType()),
    ("km_end", T.StringType()),
    ("length", T.StringType()),
    ("lane_no", T.StringType()),
    ("survey_date", T.StringType()),
    ("lat_str", T.DoubleType()),
    ("lat_end", T.DoubleType()),
    ("lon_str", T.DoubleType()),
    ("lon_end", T.DoubleType()),
)

PIC = _struct(("chainage_pic", T.DoubleType()), ("frame_number", T.StringType()))

SECTION_DIM = _struct(
    ("road_id", T.StringType()),
    ("road_revision", T.IntegerType()),
    ("section_revision", T.IntegerType()),
    ("section_part_id", T.LongType()),
    ("route", T.IntegerType()),
    ("control", T.IntegerType()),
)

#: the nine condition values of a point, in published order
METRICS = (
    "iri_right", "iri_left", "iri", "iri_lane",
    "rutt_right", "rutt_left", "rutting", "texture", "etd_texture",
)


@dataclass(frozen=True)
class Profile:
    """Everything two survey programmes may do differently."""

    remark: str = "road_survey"
    image_remark: str = "road_images"
    run_tag: str = "run"
    path_root: str = "survey/images"
    #: roots the copy script copies pictures from and to
    image_source: str = "E:\\"
    image_target: str = "E:\\images\\"
    #: re-interpolate rutting between 10 m values before assembly
    reinterpolate_rutting: bool = False
    #: columns the missing-value report looks at
    missing_columns: tuple[str, ...] = ("iri", "rutting", "texture", "frame_number")
    #: report duplicate positions on the assembled or on the conditioned points
    duplicates_before_repair: bool = False
    interval_export: bool = False
    cap_limit: float = 8.0
    #: "random" (repeatable draw in 7..8), "clamp" or "null"
    cap_mode: str = "random"
    #: a link with more lost grid points than this is marked "stop"
    stop_above: int = 10
    #: a link with more lost grid points than this is reported
    report_above: int = 11
    #: treat a missing position like a lost one
    null_is_lost: bool = False
    grid: float = 25.0
    spacing: float = 5.0
    snap_radius: float = 0.00004
    bucket: float = 100.0
    #: keep the number conventions of older exports
    compat: bool = False
    survey_start_id: int = 0
    survey_point_start_id: int = 0


BASIC = Profile()
WITH_EXPORT = Profile(
    reinterpolate_rutting=True,
    missing_columns=("iri", "texture", "frame_number"),
    duplicates_before_repair=True,
    interval_export=True,
)
