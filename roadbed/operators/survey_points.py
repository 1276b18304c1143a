"""Published points: one row per 25 m."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.functions.identifiers import district
from roadbed.functions.numbers import bround_int, capped
from roadbed.functions.predicates import inside_event, on_grid
from roadbed.operators.ordering import OrderedGroups, with_row_id
from roadbed.schema import METRICS, Profile
from roadbed.session import stage

LINK = ["file_name", "date", "link_id"]


#: values of the 25 m points that are capped once more, after smoothing
CAPPED = ("iri_right", "iri_left", "iri")


def _any_imputed() -> Column:
    return F.max(F.coalesce("gps_imputed", F.lit(False))).alias("gps_imputed")


def _means() -> list[Column]:
    return [F.avg(c).cast("decimal(8,2)").alias(c) for c in METRICS]


def event_start_rows(points: DataFrame) -> DataFrame:
    """Values at event starts that lie off the measured grid.

    Points near an event end lend their values to it: to the start if they lie
    less than 5 m past it, or anywhere before it, else to the end by the same
    rule. A point at the very chainage of the end is no neighbour. The values
    are averaged per end before they meet the event starts.
    """
    c, start, end = F.col("chainage"), F.col("event_str"), F.col("event_end")
    near = start.between(c - 6, c + 6) | end.between(c - 4, c + 4)
    lent_to = F.when(c - start < 5, start).when(c - end < 5, end)
    lent = (
        points.filter(near)
        .withColumn("at", lent_to)
        .filter(bround_int(F.col("at")) != bround_int(c))
        .groupBy(*LINK, "at")
        .agg(*_means())
        .withColumnRenamed("at", "chainage")
    )
    starts = (
        points.filter(bround_int(start) != bround_int(c))
        .select(
            *LINK,
            start.alias("chainage"),
            F.col("lon_str").alias("lon"),
            F.col("lat_str").alias("lat"),
        )
        .distinct()
    )
    rows = starts.join(lent, [*LINK, "chainage"])
    return rows.select(*LINK, "chainage", "lon", "lat", *METRICS, F.lit(False).alias("gps_imputed"))


def grid_rows(points: DataFrame, laser: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """Values on the 25 m grid.

    At one chainage of a run every distinct set of values counts once: those of
    the points inside their events, and the landed values right after the last
    point of an event. The mean does not depend on the link, so it is taken per
    chainage and joined to the links afterwards.
    """
    here = ["file_name", "chainage"]
    inside = points.filter(inside_event())
    on = on_grid(F.col("chainage"), cfg.grid)
    grid = inside.filter(on)
    step = F.col("chainage") + cfg.spacing
    after_event = (
        points.select("file_name", step.alias("chainage"), "event_end")
        .filter((F.col("chainage") > F.col("event_end")) & on)
        .select(*here)
        .distinct()
    )
    # one type per value on both sides, wide enough for either
    values = [F.col(c).cast("decimal(9,3)").alias(c) for c in METRICS]
    ahead = laser.filter(on).join(after_event, here, "left_semi").select(*here, *values)
    means = grid.select(*here, *values).union(ahead).distinct().groupBy(*here).agg(*_means())
    links = grid.select(*LINK, "chainage").distinct()
    places = points.filter(on & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    places = places.groupBy(*LINK, "chainage", "lon", "lat").agg(_any_imputed())
    return (
        links.join(places, [*LINK, "chainage"])
        .join(means, here)
        .select(*LINK, "chainage", "lon", "lat", *METRICS, "gps_imputed")
    )


def build_survey_point_local(
    points: DataFrame,
    laser: DataFrame,
    survey: DataFrame,
    cfg: Profile = Profile(),
    start_id: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """25 m points with their order and kilometre in the link.

    Means above the cap are replaced as single values are: ``<value>_raw`` has
    the mean and ``<value>_imputed`` marks it. ``gps_imputed`` marks positions
    that were interpolated.
    """
    rows = event_start_rows(points).union(grid_rows(points, laser, cfg))
    rows = rows.filter(F.col("link_id") != "construction")
    rows = rows.groupBy(*LINK, "chainage", "lon", "lat", *METRICS).agg(_any_imputed())
    attributes = survey.select(
        *LINK, "survey_id", "survey_code", "run_code", "lane_group", F.col("km_start").alias("km0")
    )
    # numbered twice and sorted for ids below: join once
    joined = stage(rows.join(attributes, LINK, "left"), "grid-rows")
    order = ["chainage", "lon", "lat", *METRICS]
    in_link = OrderedGroups(joined, LINK, [*order, "survey_id"], max_rows).row_number("n_link")
    in_survey = OrderedGroups(in_link.to_df(), [*LINK, "survey_id"], order, max_rows, in_link.largest)
    metres = (F.col("n_survey") - 1) * F.lit(int(cfg.grid))
    km = (
        F.when(F.col("lane_group") > 0, F.col("km0") + metres)
        .when(F.col("lane_group") < 0, F.col("km0") - metres)
        .cast("bigint")
    )
    keys = [F.col(c) for c in (*LINK, "chainage")]

    def cap(value: str, substitute_for_rest: str | None = None) -> Column:
        kept = F.col(substitute_for_rest or value)
        over = F.col(value) > cfg.cap_limit
        drawn = capped(F.col(value), cfg.cap_limit, cfg.cap_mode, [F.lit(value), *keys])
        return F.when(over, drawn).otherwise(kept).cast("decimal(8,2)").alias(value)

    def over_limit(value: str) -> Column:
        return F.coalesce(F.col(value) > cfg.cap_limit, F.lit(False)).alias(f"{value}_imputed")

    numbered = in_survey.row_number("n_survey").to_df()
    described = numbered.select(
        (F.col("n_link") - 1).alias("order_row"),
        km.alias("km"),
        "chainage",
        "link_id",
        "date",
        "lon",
        "lat",
        "file_name",
        cap("iri_right"),
        cap("iri_left"),
        # older exports show iri_left where iri is within its limit
        cap("iri", "iri_left" if cfg.compat else None),
        *METRICS[3:],
        "survey_id",
        "survey_code",
        "run_code",
        *[F.col(c).cast("decimal(8,2)").alias(f"{c}_raw") for c in CAPPED],
        *[over_limit(c) for c in CAPPED],
        "gps_imputed",
    )
    start = cfg.survey_point_start_id if start_id is None else start_id
    id_order = ["km", "file_name", "date", "link_id", "survey_id", "order_row"]
    with_id = with_row_id(described, id_order, start, "survey_point_id")
    return with_id.select("survey_point_id", *described.columns)


def build_survey_point(local: DataFrame) -> DataFrame:
    """The published columns of the 25 m points."""
    remark = F.concat(district(F.col("link_id")), F.lit("_"), F.year("date").cast("string"))
    return local.select(
        "survey_point_id", "survey_id", "km", *METRICS, "lon", "lat", remark.alias("remark")
    )
