"""The 25 m interval export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.functions.identifiers import control, route
from roadbed.operators.ordering import OrderedGroups
from roadbed.schema import Profile


def interval_lengths(
    rows: DataFrame,
    cfg: Profile = Profile(),
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``interval`` (metres to the next point, 25 for the last) and ``km_sum``.

    ``km_sum`` runs along the survey; points at one chainage share it.
    ``compat`` lets it run along all surveys that start at the same kilometre.
    """
    if cfg.compat:
        measured = _with_interval(rows, cfg, max_rows).to_df()
        order = ["chainage", "survey_id", "survey_point_id"]
        groups = OrderedGroups(measured, ["km_start"], order, max_rows)
    else:
        groups = _with_interval(rows, cfg, max_rows)
    return groups.running_sum("km_sum", F.col("interval"), peers_by=["chainage"]).to_df()


def _with_interval(rows: DataFrame, cfg: Profile, max_rows: int | None) -> OrderedGroups:
    interval = F.coalesce(F.col("next") - F.col("chainage"), F.lit(cfg.grid)).cast("bigint")
    return (
        OrderedGroups(rows, ["survey_id"], ["chainage", "survey_point_id"], max_rows)
        .frames({"next": lambda w: F.lead("chainage").over(w)}, before=0, after=1)
        .map(lambda d: d.withColumn("interval", interval).drop("next"))
    )


def interval_export(
    local: DataFrame,
    images: DataFrame,
    survey: DataFrame,
    section_dim: DataFrame,
    cfg: Profile = Profile(),
    max_rows: int | None = None,
) -> DataFrame:
    """Intervals between 25 m points with the road section they belong to."""
    pictures = images.select(
        "survey_id", F.col("img_id").alias("chainage"), F.col("directory").alias("image_url")
    )
    points = local.select(
        "survey_id", "survey_point_id", "chainage", "iri", F.col("rutting").alias("rut"),
        F.col("texture").alias("mpd"), "lon", "lat",
    ).join(pictures, ["survey_id", "chainage"], "left")
    link = F.col("link_id")
    lines = survey.select(
        "survey_id",
        "section_id",
        "lane_group",
        "km_start",
        route(link).cast("int").alias("route"),
        control(link).cast("int").alias("control"),
    )
    rows = interval_lengths(points.join(lines, "survey_id", "left"), cfg, max_rows)
    right = F.col("lane_group") < 0
    left = F.col("lane_group") > 0
    km_end = F.when(right, F.col("km_start") - F.col("km_sum")).when(
        left, F.col("km_start") + F.col("km_sum")
    )
    rows = rows.withColumn("km_end", km_end)
    km_start = F.when(right, F.col("km_end") + F.col("interval")).when(
        left, F.col("km_end") - F.col("interval")
    )
    rows = rows.withColumn("km_start", km_start)
    dim = section_dim.withColumnsRenamed({"route": "d_route", "control": "d_control"})
    match = (
        (F.col("route") == F.col("d_route"))
        & (F.col("control") == F.col("d_control"))
        & (rows["section_id"] == dim["section_part_id"])
    )
    return rows.join(dim, match, "left").select(
        "road_id",
        "road_revision",
        F.lit("null").alias("section_id"),
        "section_revision",
        "section_part_id",
        F.col("d_route").alias("road_code"),
        F.col("d_control").alias("section_code"),
        "km_start",
        "km_end",
        "iri",
        "rut",
        "mpd",
        "image_url",
        "lon",
        "lat",
    )
