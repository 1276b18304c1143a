"""Rejected lines, publications that appear as a whole, and ids that go on."""

import os

import pytest
from pyspark.sql import functions as F

from roadbed.session import stage, stage_root, stage_scope
from roadbed.sources import landing, rejects
from roadbed.sources.publication import Publisher

KEY_LINE = "{a},{b},1,pave type. ,link 1,336000102,7,10+000,10+050,0.050,L2,{day},13.7,13.8,100.5,100.6"


def key_file(tmp_path, *lines):
    folder = tmp_path / "20220214_1"
    folder.mkdir(exist_ok=True)
    (folder / "key.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def line(a="0", b="50", day="2022-02-14 "):
    return KEY_LINE.format(a=a, b=b, day=day)


def test_faults_are_named(spark, tmp_path):
    bad = {
        line(a="abc"): [("event_str", "bad_number")],
        line(a="x", b="y"): [("event_str", "bad_number"), ("event_end", "bad_number")],
        line(a=""): [("event_str", "missing")],
        line(day="2022-13-45"): [("survey_date", "bad_date")],
        line() + ",more": [(None, "too_many_fields")],
        line(a="1,5"): [(None, "too_many_fields")],
        line().rsplit(",", 1)[0]: [(None, "too_few_fields")],
        "nonsense": [(None, "too_few_fields")],
        line(day='"2022-02-14'): [(None, "open_quote")],
    }
    good = [line(), line(a=" 5 ", b="1e2"), line(day="").replace("link 1", '"link, ""1"""'), line(b="60")]
    path = key_file(tmp_path, *bad, "", "   ", *good)
    landed = rejects.read_with_rejects(spark, path, "key")
    found = {}
    for r in landed.rejects.collect():
        assert r.file_path.endswith("20220214_1/key.csv")
        found.setdefault(r.line, []).append((r.column, r.rule))
    assert found == bad
    rows = {(r.event_str, r.event_end, r.event_name, r.survey_date, r.file_name) for r in landed.good.collect()}
    assert rows == {
        (0.0, 50.0, "link 1", "2022-02-14", "20220214_1"), (5.0, 100.0, "link 1", "2022-02-14", "20220214_1"),
        (0.0, 50.0, 'link, "1"', None, "20220214_1"), (0.0, 60.0, "link 1", "2022-02-14", "20220214_1"),
    }


def test_clean_files_give_what_the_strict_reader_gives(spark, tmp_path):
    path = key_file(tmp_path, *[line(a=str(i), b=f"{i}.5") for i in range(50)])
    landed = rejects.read_with_rejects(spark, path, "key")
    strict = landing.read_landed(spark, path, "key")
    assert landed.good.schema == strict.schema and landed.rejects.isEmpty()
    assert sorted(map(tuple, landed.good.collect())) == sorted(map(tuple, strict.collect()))
    laser = tmp_path / "laser.csv"
    laser.write_text("0,100.5,13.7,1.25,1.30,1.275,,2,3,2.5,1.1,0.89,20220214_1\n5,,,,,,,,,,,,20220214_1\n")
    own = rejects.read_with_rejects(spark, str(laser), "laser")
    assert sorted(map(str, own.good.collect())) == sorted(map(str, landing.read_landed(spark, str(laser), "laser").collect()))


def test_numbers_that_do_not_fit_are_rejected(spark, tmp_path):
    (tmp_path / "laser.csv").write_text("0,100.5,13.7,12345678901,1,1,1,1,1,1,1,1,20220214_1\n")
    landed = rejects.read_with_rejects(spark, str(tmp_path / "laser.csv"), "laser")
    assert [(r.column, r.rule) for r in landed.rejects.collect()] == [("iri_right", "bad_number")] and landed.good.isEmpty()


def numbered(spark, start, n):
    return spark.range(start + 1, start + 1 + n).withColumnRenamed("id", "row_id")


def broken(spark):
    fail = F.raise_error(F.lit("lost")).cast("bigint")
    return spark.range(3).withColumn("x", F.when(F.col("id") >= 0, fail))


@pytest.fixture
def publisher(spark, tmp_path):
    return Publisher(spark, str(tmp_path / "published"), {"a": "row_id", "b": "row_id"})


def test_nothing_shows_of_a_run_that_failed_between_two_tables(spark, publisher):
    assert publisher.tables() == {}
    publisher.publish("one", {"a": numbered(spark, 0, 4), "b": numbered(spark, 0, 2)})
    with pytest.raises(Exception, match="lost"):
        publisher.publish("two", {"a": numbered(spark, 4, 9), "b": broken(spark).withColumnRenamed("id", "row_id")})
    assert publisher.read("a").count() == 4 and publisher.history().count() == 1
    assert publisher.start_ids("two") == {"a": 4, "b": 2}
    assert len(publisher.remove_unpublished()) == 1 and publisher.remove_unpublished() == []
    again = publisher.publish("two", {"a": numbered(spark, 4, 9), "b": numbered(spark, 2, 1)})
    assert publisher.read("a").count() == 9 and publisher.read("a", again - 1).count() == 4
    with pytest.raises(LookupError):
        publisher.read("c")


def test_ids_go_on_and_a_repeated_run_has_the_ids_it_had(spark, publisher):
    publisher.publish("one", {"a": numbered(spark, 0, 4), "other": spark.range(2)})
    assert publisher.start_ids("two") == {"a": 4, "b": 0}
    publisher.publish("two", {"a": numbered(spark, 4, 3), "b": numbered(spark, 0, 1)})
    assert publisher.start_ids("one") == {"a": 0, "b": 1}
    assert publisher.start_ids("two") == {"a": 4, "b": 0} and publisher.start_ids("three") == {"a": 7, "b": 1}
    publisher.publish("one", {"a": numbered(spark, 0, 4)})
    assert publisher.start_ids("three") == {"a": 7, "b": 1}
    publisher.publish("empty", {"a": numbered(spark, 7, 0)})
    assert publisher.start_ids("three") == {"a": 7, "b": 1}


def test_ids_that_meet_others_are_refused(spark, publisher):
    publisher.publish("one", {"a": numbered(spark, 0, 4)})
    publisher.publish("two", {"a": numbered(spark, 4, 3)})
    with pytest.raises(ValueError, match="meet"):
        publisher.publish("one", {"a": numbered(spark, 0, 5)})  # grown into the next block
    with pytest.raises(ValueError, match="above"):
        publisher.publish("three", {"a": numbered(spark, 5, 3)})
    with pytest.raises(ValueError, match="different"):
        publisher.publish("three", {"a": numbered(spark, 7, 3).union(numbered(spark, 7, 1))})
    assert publisher.history().count() == 2


def test_stage_tables_go_with_their_scope(spark):
    root = stage_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    with pytest.raises(RuntimeError):
        with stage_scope(spark):
            assert stage(spark.range(5), "scoped").count() == 5
            with stage_scope(spark):
                stage(spark.range(5), "inner")
            assert len(set(os.listdir(root)) - before) == 1
            raise RuntimeError("also then")
    assert set(os.listdir(root)) == before
    stage(spark.range(1), "outside")
    assert len(set(os.listdir(root)) - before) == 1
