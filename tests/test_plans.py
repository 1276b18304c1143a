"""Plans that would not survive large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from roadbed.functions.numbers import divide_half_up
from roadbed.operators import assembly, gps, series, survey_points
from roadbed.plans import pipeline
from roadbed.schema import Profile
from roadbed.session import stage
from roadbed.sources import sample_views as views

CFG = Profile(cap_mode="clamp", stop_above=1)


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check(df):
    text = plan(df)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text, bad
    return text


def test_stages(spark, sf_dir, no_broadcast):
    laser, key, pic = (f(spark, sf_dir) for f in (views.laser, views.key, views.pic))
    check(assembly.assemble_points(laser, key, pic, CFG))
    points = stage(assembly.assemble_points(laser, key, pic, CFG))
    gaps = gps.gps_gaps(points, CFG)
    check(gaps)
    check(gps.repair_gps(points, stage(gaps), CFG))
    check(gps.snap_endpoints(points, laser, key, CFG))
    check(series.smooth_condition(points))
    check(series.interpolate_rutting(laser))
    check(survey_points.grid_rows(points, laser, CFG))
    check(survey_points.event_start_rows(points))


def test_smoothing_sorts_once(spark, sf_dir, no_broadcast):
    laser, key, pic = (f(spark, sf_dir) for f in (views.laser, views.key, views.pic))
    text = plan(series.smooth_condition(stage(assembly.assemble_points(laser, key, pic, CFG))))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    points = stage(assembly.assemble_points(*[f(spark, sf_dir) for f in (views.laser, views.key, views.pic)], CFG))
    text = plan(points.filter("status = 'lost'").select("file_name", "chainage"))
    assert "EqualTo(status,lost)" in text
    assert "iri" not in text.split("ReadSchema")[1]


def test_smoothing_is_compiled(spark, sf_dir, monkeypatch, no_broadcast):
    """The JVM leaves generated methods of over 8000 bytes to its interpreter."""
    found = []
    stage = pipeline.stage

    def look(df, name):
        if name == "points":
            text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            found.extend(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))
        return stage(df, name)

    monkeypatch.setattr(pipeline, "stage", look)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        inputs = pipeline.Inputs(*(view(spark, sf_dir) for view in (views.laser, views.key, views.pic)))
        pipeline.condition_points(inputs, CFG)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found and max(found) <= 8000


def test_whole_quotients_round_halves_away(spark):
    totals = [None, 0, 1, 4, 5, 8, 9, 13, 14, 27, 45, 2**53 + 9, *(-n for n in (1, 4, 5, 9, 14, 27, 45))]
    df = spark.createDataFrame([(n,) for n in totals], "n bigint")
    for size in (9, 18):
        got = [r[0] for r in df.select(divide_half_up(F.col("n"), size)).collect()]
        half = [n and (abs(n) * 2 + size) // (2 * size) * (1 if n > 0 else -1) for n in totals]
        assert got == half
