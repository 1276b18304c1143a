"""Reading extracts and writing tables, scripts and statements."""

import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roadbed.plans import pipeline
from roadbed.schema import Profile
from roadbed.sources import landing, sinks
from roadbed.sources import sample_views as views


def test_landed_csv_of_many_runs(spark, tmp_path):
    for run in ("20220214_1", "20220214_2"):
        folder = tmp_path / run
        folder.mkdir()
        (folder / "pic.csv").write_text("5.0,00012  \n10.0,\n")
    pic = landing.read_landed(spark, [f"{tmp_path}/20220214_{n}/pic.csv" for n in (1, 2)], "pic")
    got = sorted(map(tuple, pic.select("file_name", "chainage_pic", "frame_number").fillna("-").collect()))
    assert got == [
        ("20220214_1", 5.0, "00012"), ("20220214_1", 10.0, "-"),
        ("20220214_2", 5.0, "00012"), ("20220214_2", 10.0, "-"),
    ]


def test_bad_csv_fails(spark, tmp_path):
    (tmp_path / "pic.csv").write_text("not a number,1\n")
    with pytest.raises(Exception):
        landing.read_landed(spark, str(tmp_path / "pic.csv"), "pic").collect()


def test_laser_csv_types(spark, tmp_path):
    (tmp_path / "laser.csv").write_text("0,100.5,13.7,1.25,1.30,1.275,,2,3,2.5,1.1,0.89,20220214_1\n")
    row = landing.read_landed(spark, str(tmp_path / "laser.csv"), "laser").first()
    assert row.iri == Decimal("1.275") and row.iri_lane is None and row.file_name == "20220214_1"


def test_raw_extracts(spark):
    raw = spark.createDataFrame(
        [("f", 1.0, 9.0, "pave type.", "336  ")], "file_name string, CHAINAGE_START double, CHAINAGE_END double, SWITCH_GROUP string, LINK_ID string"
    )
    for name in ("EVENT", "EVENT_DESC", "section_id", "km_start", "km_end", "length", "lane_no", "survey_date"):
        raw = raw.withColumn(name, F.lit("1 "))
    for name in ("LATITUDE_START", "LATITUDE_END", "LONGITUDE_START", "LONGITUDE_END"):
        raw = raw.withColumn(name, F.lit("1.5"))
    row = landing.build_key(raw).first()
    assert (row.link_id, row.event_end, row.lat_str, row.section_id) == ("336", 9.0, 1.5, "1")
    pictures = spark.createDataFrame([("f", 5, 7)], "file_name string, CHAINAGE int, FRAME int")
    assert tuple(landing.build_pic(pictures).first()) == (5.0, "7", "f")


def test_section_dim(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.sql(
        "select 'R1' road_id, 1 road_revision, 2 section_revision, 3L section_part_id, '0004' route, '0201' control"
    ).write.parquet(path)
    row = landing.read_section_dim(spark, path).first()
    assert (row.route, row.control) == (4, 201)


def test_insert_statements(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b, \"it's\" as c, date'2022-02-14' as d, true as e")
    got = sinks.to_insert_statements(df, "t").first()[0]
    assert got == "INSERT INTO t (a, b, c, d, e) VALUES (1, NULL, 'it''s', '2022-02-14', true);"


def test_insert_statements_write_wkt(spark):
    df = spark.sql(
        "select named_struct('lon', 100.5D, 'lat', 13.7D) as p, "
        "array(named_struct('m', 0D, 'lon', 1.5D, 'lat', 2D), named_struct('m', 5D, 'lon', 1.75D, 'lat', 2D)) as g, "
        "cast(null as array<struct<lon: double, lat: double>>) as n"
    )
    got = sinks.to_insert_statements(df, "t").first()[0]
    assert got == "INSERT INTO t (p, g, n) VALUES ('POINT(100.5 13.7)', 'LINESTRING(1.5 2.0,1.75 2.0)', NULL);"


def test_publish(spark, sf_dir, tmp_path):
    inputs = pipeline.Inputs(
        *[f(spark, sf_dir) for f in (views.laser, views.key, views.pic, views.section_dim)]
    )
    cfg = Profile(interval_export=True, reinterpolate_rutting=True, survey_start_id=100)
    tables = pipeline.run_pipeline(inputs, cfg)
    pipeline.publish(tables, str(tmp_path))
    lines = spark.read.parquet(f"{tmp_path}/survey")
    assert sorted(r[0] for r in lines.select("survey_id").collect()) == list(range(101, 101 + lines.count()))
    points = spark.read.parquet(f"{tmp_path}/survey_point_local")
    assert points.count() == tables["survey_point"].count() > 0
    assert glob.glob(f"{tmp_path}/survey/date=*/*.parquet") and not glob.glob(f"{tmp_path}/survey/date=*/file_name=*")
    for name in ("survey", "survey_point", "survey_image"):
        text = spark.read.text(f"{tmp_path}/sql/{name}")
        assert text.count() == tables[name].count()
        assert text.filter(~F.col("value").startswith(f"INSERT INTO {name} (")).count() == 0
    statement = spark.read.text(f"{tmp_path}/sql/survey").first()[0]
    assert "'LINESTRING(" in statement and "line_parts" not in statement
    for name, order in pipeline.REPORT_ORDER.items():
        report = spark.read.option("header", True).csv(f"{tmp_path}/reports/{name}")
        assert report.count() == tables[name].count() and set(order) <= set(tables[name].columns)
    assert spark.read.text(f"{tmp_path}/mkdir").filter("value like 'mkdir E:%'").count() > 0
    assert spark.read.text(f"{tmp_path}/copy").filter("value like 'copy E:%'").count() > 0
    export = spark.read.option("header", True).csv(f"{tmp_path}/interval_export")
    assert export.columns[:2] == ["index", "road_id"]
    assert export.count() == tables["interval_export"].count()
    # capped at random, but within the range and the same when run again
    again = pipeline.run_pipeline(inputs, cfg)["survey_point"]
    assert again.exceptAll(tables["survey_point"]).count() == 0


def test_a_path_without_a_run_id_fails(spark, tmp_path):
    (tmp_path / "pic.csv").write_text("5.0,00012\n")
    with pytest.raises(Exception, match="no run id"):
        landing.read_landed(spark, str(tmp_path / "pic.csv"), "pic").collect()


def test_publishing_a_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("2022-01-01", "a_1", 1), ("2022-01-02", "b_1", 2)], "date string, file_name string, v int")
    sinks.write_table(days, path, ["date"], ["file_name"])
    again = days.filter("date = '2022-01-02'").withColumn("v", F.lit(5))
    sinks.write_table(again, path, ["date"], ["file_name"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 5]


def test_insert_files_load_in_order(spark, tmp_path):
    """Files by ascending number, one statement after the other, give the tables back, parents first."""
    import duckdb

    survey = spark.range(1, 200).select(F.col("id").alias("survey_id"), F.concat(F.lit("it's "), F.col("id")).alias("name"))
    points = spark.range(1, 1001).select(F.col("id").alias("point_id"), (1 + F.col("id") % 199).alias("survey_id"), F.when(F.col("id") % 3 > 0, F.col("id") / 4).alias("iri"))
    nothing = spark.range(0).withColumnRenamed("id", "x")
    tables = [("survey", survey, ["survey_id"]), ("nothing", nothing, ["x"]), ("point", points, ["point_id"])]
    files = sinks.write_insert_files(tables, str(tmp_path / "sql"), rows_per_statement=30, max_bytes=3000)
    listed = files.orderBy("load_no").collect()
    assert [r.load_no for r in listed] == list(range(1, len(listed) + 1)) and len(listed) > 8
    assert [r.table for r in listed] == sorted((r.table for r in listed), reverse=True)
    con = duckdb.connect()
    con.execute("create table survey (survey_id bigint primary key, name varchar)")
    con.execute("create table point (point_id bigint, survey_id bigint references survey(survey_id), iri double)")
    for r in listed:
        text = open(r.path.removeprefix("file://").removeprefix("file:")).read()
        assert len(text.encode()) == r.bytes <= 3000 and text.count("\n") == r.lines
        for statement in text.splitlines():
            con.execute(statement)
    assert con.execute("select * from survey").fetchall() == sorted(map(tuple, survey.collect()))
    assert con.execute("select * from point").fetchall() == sorted(map(tuple, points.collect()))
    statements = sinks.multi_row_statements(points, "point", ["point_id"], 30).collect()
    assert sorted(r.n_rows for r in statements) == [10] + [30] * 33
