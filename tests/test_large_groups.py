"""Groups too large for one task give the same rows as small ones."""

import pytest
from pyspark.sql import functions as F

from roadbed.operators import export, gps, images, joins, series, survey, survey_points
from roadbed.operators.ordering import OrderedGroups, with_row_id
from roadbed.schema import Profile
from roadbed.session import stage
from roadbed.sources import sample_views as views
from roadbed.operators.assembly import assemble_points

CFG = Profile(cap_mode="clamp", stop_above=1)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def points(spark, sf_dir):
    tables = views.laser(spark, sf_dir), views.key(spark, sf_dir), views.pic(spark, sf_dir)
    return stage(assemble_points(*tables, CFG))


@pytest.fixture(scope="module")
def local(spark, sf_dir, points):
    lines = stage(survey.build_survey(points, CFG))
    return lines, stage(
        survey_points.build_survey_point_local(points, views.laser(spark, sf_dir), lines, CFG)
    )


@pytest.mark.parametrize("limit", [4, 7, 100, 1000])
def test_smoothing(points, limit):
    assert rows(series.smooth_condition(points, max_rows=limit)) == rows(
        series.smooth_condition(points)
    )


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("limit", [2, 5, 9])
def test_islands(points, compat, limit):
    cfg = Profile(cap_mode="clamp", stop_above=1, compat=compat)
    assert rows(gps.gps_islands(points, cfg, max_rows=limit)) == rows(gps.gps_islands(points, cfg))


def test_repair(points):
    gaps = stage(gps.gps_gaps(points, CFG))
    assert rows(gps.repair_gps(points, gaps, CFG, max_rows=1)) == rows(
        gps.repair_gps(points, gaps, CFG)
    )


def test_rutting(spark, sf_dir):
    laser = views.laser(spark, sf_dir)
    for mode in ("reference", "centred"):
        assert rows(series.interpolate_rutting(laser, mode, max_rows=50)) == rows(
            series.interpolate_rutting(laser, mode)
        )


def test_survey_lines(points):
    whole = survey.build_survey(points, CFG)
    cut = survey.build_survey(points, CFG, max_rows=2)
    # lengths are summed in another order
    assert rows(whole.drop("the_geom")) == rows(cut.drop("the_geom"))


def test_crowded_cells_are_spread(spark):
    places = spark.range(40).selectExpr("'r' file_name", "id as place", "0D as lon", "id % 3 * 0.00003D as lat")
    points = spark.range(300).selectExpr("'r' file_name", "id as point", "0D as point_lon", "id % 7 * 0.00001D as point_lat")
    plain = joins.distance_join(places, points, 0.00004)
    spread = joins.distance_join(places, points, 0.00004, crowd=20)
    assert spread.columns == plain.columns
    assert plain.exceptAll(spread).count() == spread.exceptAll(plain).count() == 0 < plain.count()


def test_band_join_of_a_very_long_interval(spark):
    points = spark.createDataFrame([("r", 5.0), ("r", 700.0), ("r", -3.0)], "file_name string, at double")
    events = spark.createDataFrame([("r", 0.0, 2.0e6), ("r", 650.0, 800.0)], "file_name string, a double, b double")
    got = joins.band_join(points, events, "at", "a", "b").select("at", "a").collect()
    assert sorted(map(tuple, got)) == [(5.0, 0.0), (700.0, 0.0), (700.0, 650.0)]


def test_survey_points(spark, sf_dir, points, local):
    lines, expected = local
    laser = views.laser(spark, sf_dir)
    got = survey_points.build_survey_point_local(points, laser, lines, CFG, max_rows=2)
    assert rows(got) == rows(expected)


def test_images(points, local):
    pictures = stage(images.build_survey_image(local[1], points, CFG))
    assert rows(images.dedupe_images(pictures, max_rows=1)) == rows(images.dedupe_images(pictures))


@pytest.mark.parametrize("compat", [False, True])
def test_intervals(local, compat):
    lines, points25 = local
    cfg = Profile(compat=compat)
    table = points25.join(lines.select("survey_id", "km_start"), "survey_id", "left")
    assert rows(export.interval_lengths(table, cfg, max_rows=2)) == rows(
        export.interval_lengths(table, cfg)
    )


def test_line_parts_keep_every_vertex(points):
    parts = survey.survey_line_parts(points, CFG, part_rows=1)
    whole = survey.survey_line_parts(points, CFG)
    keys = survey.LINE
    n_segments = lambda d: d.groupBy(*keys).agg(F.sum(F.size("line") - 1).alias("n"))
    assert parts.agg(F.max(F.size("line"))).first()[0] == 2
    multi = n_segments(parts.filter(F.size("line") > 1))
    assert rows(multi) == rows(n_segments(whole))
    cut = survey.build_survey(points, CFG, part_rows=1)
    assert cut.filter("line_parts > 1").count() > 0
    geometry = lambda d: rows(d.select("survey_id", "the_geom"))
    assert geometry(cut) == geometry(survey.build_survey(points, CFG))


def test_running_sum_shares_peers_across_chunks(spark):
    data = [("a", c, i) for c in range(5) for i in range(7)] + [("b", 1, 1), ("b", 1, 2)]
    df = spark.createDataFrame(data, "k string, c int, v int")

    def run(limit):
        groups = OrderedGroups(df, ["k"], ["c", "v"], limit)
        return rows(groups.running_sum("s", F.col("v"), peers_by=["c"]).to_df())

    assert run(3) == run(None)


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("x", 1)], "k string, c int")
    got = OrderedGroups(df, ["k"], ["c"], 3).row_number("n").to_df()
    assert got.filter("k is null and n = c + 1").count() == 20


def test_row_ids_are_contiguous(spark):
    df = spark.range(0, 5000).select((F.col("id") % 17).alias("a"), F.col("id").alias("b"))
    got = with_row_id(df, ["a", "b"], start=100)
    ids = [r[0] for r in got.orderBy("a", "b").select("row_id").collect()]
    assert ids == list(range(101, 5101))


def test_many_large_groups_are_not_broadcast(spark, monkeypatch):
    from roadbed.operators import ordering

    monkeypatch.setattr(ordering, "MAX_BROADCAST_KEYS", 1)
    df = spark.range(0, 120).select((F.col("id") % 4).alias("k"), F.col("id").alias("c"))
    groups = OrderedGroups(df, ["k"], ["c"], 10).row_number("n").running_sum("s", F.col("n"))
    got = groups.to_df()
    assert got.count() == 120
    assert got.filter("n = (c - k) div 4 + 1 and s = n * (n + 1) div 2").count() == 120
