"""Only changed runs are worked out again, and the result is that of a full run."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from roadbed.operators.ordering import with_row_id
from roadbed.plans.incremental import IDS, condition_changed, only_runs, read_runs, run_digests
from roadbed.plans.pipeline import REPORT_ORDER, Inputs, Tables, reports_with_rows
from roadbed.schema import Profile
from roadbed.sources.publication import Publisher

RUNS = [f"2022020{d}_1" for d in range(1, 5)]


def inputs_of(spark, rows):
    laser = spark.createDataFrame(rows, "file_name string, chainage double, iri double")
    key = spark.createDataFrame([(r, 0.0, f"link {r}") for r in RUNS], "file_name string, event_str double, link_id string")
    pic = spark.createDataFrame([(r, 0.0) for r in RUNS[:3]], "file_name string, chainage_pic double")
    return Inputs(laser, key, pic)


def rows_of(runs=RUNS, n=5):
    return [(r, float(i), float(i)) for r in runs for i in range(n)]


@pytest.fixture
def seen():
    return []


@pytest.fixture
def work(seen):
    """A small programme: numbered points, numbered links, no pictures; notes which runs it is given."""

    def run(inputs, cfg):
        seen.append({r[0] for r in inputs.laser.select("file_name").distinct().collect()})
        assert {r[0] for r in inputs.key.select("file_name").distinct().collect()} <= seen[-1]
        order = ["file_name", "chainage"]
        points = with_row_id(inputs.laser, order, cfg.survey_point_start_id, "survey_point_id")
        return {
            "survey": with_row_id(inputs.key, ["file_name"], cfg.survey_start_id, "survey_id"),
            "survey_point_local": points,
            "survey_image": inputs.pic,
            "qa_rows": inputs.laser.groupBy("file_name").count(),
        }

    return run


@pytest.fixture
def publisher(spark, tmp_path):
    return Publisher(spark, str(tmp_path / "published"), IDS)


def shown(publisher, name="survey_point_local"):
    return sorted(tuple(r) for r in read_runs(publisher, name).drop("survey_point_id").collect())


def test_changed_new_and_missing_runs(spark, publisher, work, seen):
    first = rows_of(RUNS[:3])
    inputs = inputs_of(spark, first)
    inputs = replace(inputs, key=inputs.key.filter(F.col("file_name") != RUNS[3]))
    condition_changed(publisher, "monday", inputs, work=work)
    assert shown(publisher) == sorted(first) and seen[-1] == set(RUNS[:3])
    old = {r.file_name: r.survey_point_id for r in read_runs(publisher, "survey_point_local").filter("chainage = 0").collect()}
    # the second run changed, the third is gone, the fourth is new
    second = rows_of([RUNS[0]]) + [(RUNS[1], 0.0, 7.0)] + rows_of([RUNS[3]], 2)
    inputs = inputs_of(spark, second)
    inputs = replace(inputs, key=inputs.key.filter(F.col("file_name") != RUNS[2]), pic=inputs.pic.filter(F.col("file_name") != RUNS[2]))
    done = condition_changed(publisher, "tuesday", inputs, work=work)
    assert seen[-1] == {RUNS[1], RUNS[3]} == {r[0] for r in done.changed.collect()}
    assert {r.file_name for r in done.reports["qa_rows"].collect()} == {RUNS[1], RUNS[3]}
    assert shown(publisher) == sorted(second)
    ids = {(r.file_name, r.chainage): r.survey_point_id for r in read_runs(publisher, "survey_point_local").collect()}
    assert ids[RUNS[0], 0.0] == old[RUNS[0]] and len(set(ids.values())) == len(second)
    assert min(v for (run, _), v in ids.items() if run != RUNS[0]) > 15
    # what was read before is still there
    assert read_runs(publisher, "survey_point_local", 1).count() == len(first)


def test_nothing_changed(spark, publisher, work, seen):
    rows = rows_of()
    condition_changed(publisher, "monday", inputs_of(spark, rows), work=work)
    mixed = inputs_of(spark, rows[::-1])
    done = condition_changed(publisher, "tuesday", replace(mixed, laser=mixed.laser.repartition(7)), work=work)
    assert seen[-1] == set() and done.changed.isEmpty() and shown(publisher) == sorted(rows)
    # other settings change every run
    condition_changed(publisher, "wednesday", mixed, Profile(grid=50.0), work=work)
    assert seen[-1] == set(RUNS) and shown(publisher) == sorted(rows)


def test_digest_tells_nulls_copies_and_columns(spark):
    def digest(rows, names="a double, b double"):
        laser = spark.createDataFrame(rows, f"file_name string, {names}")
        return run_digests(Inputs(laser, laser.limit(0), laser.limit(0)), Profile()).first().digest

    same = [("f", 1.0, None), ("f", None, 1.0)]
    others = [[("f", 1.0, None)], [("f", None, 1.0)] * 2, [*same, same[0]], [("f", 1.0, 1.0), ("f", None, None)]]
    assert digest(same) == digest(same[::-1])
    found = [digest(rows) for rows in others] + [digest(same), digest(same, "a double, c double")]
    assert len(set(found)) == len(found)


def test_a_failed_run_leaves_the_last_one(spark, publisher, work):
    rows = rows_of()
    condition_changed(publisher, "monday", inputs_of(spark, rows), work=work)
    changed = inputs_of(spark, [(r, c, v + 1) for r, c, v in rows])

    def breaks(inputs, cfg):
        made = work(inputs, cfg)
        return {**made, "survey_image": made["survey_image"].withColumn("x", F.raise_error(F.lit("lost")))}

    with pytest.raises(Exception, match="lost"):
        condition_changed(publisher, "tuesday", changed, work=breaks)
    assert shown(publisher) == sorted(rows) and publisher.history().count() == 1
    condition_changed(publisher, "tuesday", changed, work=work)
    assert shown(publisher) == sorted((r, c, v + 1) for r, c, v in rows)


def test_unchanged_runs_are_not_read(spark, tmp_path):
    """Of inputs in a folder for each run, only those of the runs told are opened."""
    rows = spark.createDataFrame(rows_of(), "file_name string, chainage double, iri double")
    rows.write.partitionBy("file_name").parquet(str(tmp_path / "laser"))
    laser = spark.read.parquet(str(tmp_path / "laser"))
    changed = spark.createDataFrame([(RUNS[1],)], "file_name string")
    some = only_runs(laser, changed)
    assert {r.file_name for r in some.collect()} == {RUNS[1]}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or f"file_name#" in plan and "PartitionFilters: [isnotnull" in plan


def test_reports_are_built_when_asked_for_and_skipped_when_empty(spark):
    built = []

    def report(name):
        built.append(name)
        return spark.range(1)

    made = {"survey": spark.range(2), **{name: (lambda name=name: report(name)) for name in REPORT_ORDER}}
    made["qa_summary"] = spark.createDataFrame([("missing_values", 0), ("gap_points", 3), ("still_lost", 0)], "metric string, n bigint")
    tables = Tables(made)
    assert len(tables) == len(made) and tables["survey"].count() == 2 and not built
    wanted = reports_with_rows(tables)
    assert set(REPORT_ORDER) - set(wanted) == {"qa_missing", "qa_unrepaired"} and not built
    assert tables["qa_missing"] is tables["qa_missing"] and built == ["qa_missing"]
