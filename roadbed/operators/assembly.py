"""Measured points meet road events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.functions import numbers
from roadbed.functions.predicates import has_any_fix, is_lost, is_pavement, on_grid
from roadbed.operators.joins import band_join, update_from
from roadbed.operators.sweep import sweep_join
from roadbed.schema import Profile

LINK_KEYS = ("file_name", "date", "link_id")


def pavement_events(key: DataFrame) -> DataFrame:
    return key.filter(is_pavement(F.col("event_type"))).withColumn(
        "date", numbers.survey_date(F.col("survey_date"))
    )


def padded_band_join(
    laser: DataFrame, key: DataFrame, cfg: Profile = Profile(), sweep: bool = False
) -> DataFrame:
    """Measured points within 5 m of a pavement event (bounds not rounded).

    ``sweep`` lists fewer event rows (see ``sweep_join``), but shuffles points
    twice and passes them through Python; the bucket join is faster here.
    """
    events, between = pavement_events(key), ("chainage", "event_str", "event_end")
    if sweep:
        return sweep_join(laser, events, *between, pad=cfg.spacing)
    return band_join(laser, events, *between, bucket=cfg.bucket, pad=cfg.spacing)


def lost_counts(laser: DataFrame, key: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Lost and located grid points of every link, in one pass."""
    lon, lat = F.col("lon"), F.col("lat")
    grid = laser.filter(on_grid(F.col("chainage"), cfg.grid)).select(
        "file_name", "chainage", "lon", "lat"
    )
    events = key.select(
        "file_name", "event_str", "event_end", "event_type", "link_id", "survey_date"
    ).filter(F.col("link_id").isNotNull())
    return (
        padded_band_join(grid, events, cfg)
        .groupBy(*LINK_KEYS)
        .agg(
            F.count_if(is_lost(lon, lat, cfg.null_is_lost)).alias("n_lost"),
            F.count_if(has_any_fix(lon, lat)).alias("n_fix"),
        )
    )


def link_status(laser: DataFrame, key: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """One row per link: ``lost`` or ``ok``, its point count, ``stop``/``continue``."""
    lost = F.col("n_lost") > 0
    counted = lost_counts(laser, key, cfg).filter(lost | (F.col("n_fix") > 0))
    return counted.select(
        *LINK_KEYS,
        F.when(lost, F.col("n_lost")).otherwise(F.col("n_fix")).alias("count"),
        F.when(lost, "lost").otherwise("ok").alias("status"),
        F.when(F.col("n_lost") > cfg.stop_above, "stop").otherwise("continue").alias("status_type"),
    )


def capped_points(laser: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Cap the wheel-path roughness and rebuild its mean; the old mean is kept."""
    capped = numbers.cap_values(
        laser.withColumnRenamed("iri", "iri_old"),
        ["iri_right", "iri_left"],
        ["file_name", "chainage"],
        limit=cfg.cap_limit,
        mode=cfg.cap_mode,
    )
    return capped.withColumn(
        "iri", numbers.half(F.col("iri_right") + F.col("iri_left")).cast("decimal(9,3)")
    )


def with_pictures(laser: DataFrame, pic: DataFrame) -> DataFrame:
    """Left-join the picture taken at the (rounded) chainage of the point."""
    rounded = numbers.bround_int(F.col("chainage_pic")).cast("double")
    frames = pic.select("file_name", rounded.alias("chainage"), "chainage_pic", "frame_number")
    return laser.join(frames, ["file_name", "chainage"], "left")


def points_in_events(
    laser: DataFrame,
    key: DataFrame,
    pic: DataFrame,
    cfg: Profile = Profile(),
    events: DataFrame | None = None,
) -> DataFrame:
    """Points with every pavement event whose rounded bounds hold them.

    Bounds are closed: a border point belongs to both its events.
    """
    points = with_pictures(capped_points(laser, cfg), pic)
    joined = band_join(
        points,
        pavement_events(key) if events is None else events,
        "chainage",
        numbers.bround_int(F.col("event_str")),
        numbers.bround_int(F.col("event_end")),
        bucket=cfg.bucket,
    )
    km = numbers.km_to_int(F.col("km_start")) + F.col("chainage") - F.col("event_str")
    return joined.withColumn("km2", km)


def assemble_points(
    laser: DataFrame, key: DataFrame, pic: DataFrame, cfg: Profile = Profile()
) -> DataFrame:
    """The conditioned point table, version 1: points × events × link status.

    The status is joined to the events, a tenth of the points, before these
    meet the points: the wide point table is not shuffled again for it.
    """
    status = link_status(laser, key, cfg).select(*LINK_KEYS, "status", "status_type")
    events = pavement_events(key).join(status, list(LINK_KEYS))
    points = points_in_events(laser, key, pic, cfg, events)
    return points.withColumn("gps_imputed", F.lit(False))


def links_dropped(laser: DataFrame, key: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Pavement links the status join drops: no grid point lies near them."""
    links = pavement_events(key).select(*LINK_KEYS).filter(F.col("link_id").isNotNull()).distinct()
    return links.join(link_status(laser, key, cfg).select(*LINK_KEYS), list(LINK_KEYS), "left_anti")


def apply_corrections(points: DataFrame, corrections: DataFrame) -> DataFrame:
    """Overlay positions corrected by a field team."""
    return update_from(points, corrections, ["file_name", "link_id", "chainage"], ["lon", "lat"])

