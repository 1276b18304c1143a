"""Sweep join against brute force and against the bucket join."""

import random

import pytest
from pyspark.sql import functions as F
from roadbed.operators import joins, sweep

POINTS = "file_name string, at double, p int"
EVENTS = "file_name string, lo double, hi double, e int"


def brute(points, events, pad):
    return sorted(
        (p, e)
        for file, at, p in points
        for other, lo, hi, e in events
        if file is not None and file == other and None not in (at, lo, hi) and lo - pad <= at <= hi + pad
    )


def pairs(df):
    return sorted(map(tuple, df.select("p", "e").collect()))


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_sweep_equals_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(sweep, "_PAIRS", 13)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    draw = random.Random(5)
    files = ["a", "b", "c", None]
    points = [(draw.choice(files), draw.choice([None, *map(float, range(60))]), i) for i in range(400)]
    events = [("a", 0.0, 59.0, 0), ("a", 0.0, 59.0, 0), ("b", 30.0, 10.0, 1), ("d", 0.0, 99.0, 2), ("c", None, 3.0, 3)]
    events += [(draw.choice(files), x, x + draw.choice([0.0, 1.0, 7.0, 40.0]), i) for i in range(4, 60) for x in [float(draw.randrange(60))]]
    try:
        for pad in (0.0, 5.0):
            left, right = spark.createDataFrame(points, POINTS), spark.createDataFrame(events, EVENTS)
            got = sweep.sweep_join(left, right, "at", "lo", "hi", pad=pad)
            assert got.columns == ["file_name", "at", "p", "lo", "hi", "e"]
            assert pairs(got) == brute(points, events, pad)
            assert got.filter("at < lo - {0} or at > hi + {0}".format(pad)).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_sweep_of_awkward_rows(spark):
    nan = float("nan")
    points = spark.createDataFrame([("a", nan, 1), ("a", 2.0, 2), ("a", 2.0, 2)], POINTS)
    events = spark.createDataFrame([("a", 0.0, nan, 1), ("a", nan, 5.0, 2), ("a", 2.0, 2.0, 3)], EVENTS)
    assert pairs(sweep.sweep_join(points, events, "at", "lo", "hi")) == [(2, 3), (2, 3)]
    none = spark.createDataFrame([], EVENTS)
    assert pairs(sweep.sweep_join(points, none, "at", "lo", "hi")) == []
    assert pairs(sweep.sweep_join(points.filter("p > 5"), events, "at", "lo", "hi")) == []


def test_one_place_is_spread_and_keeps_all_pairs(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        points = spark.range(4000).select(F.lit("a").alias("file_name"), F.lit(1.0).alias("at"), F.col("id").cast("int").alias("p"))
        placed = sweep._in_ranges(points, ["file_name"], "at")
        assert placed.groupBy(sweep._PART).count().agg(F.max("count")).first()[0] < 2000
        events = spark.createDataFrame([("a", 0.0, 2.0, 1), ("a", 1.0, 1.0, 2), ("a", 1.5, 2.0, 3)], EVENTS)
        got = sweep.sweep_join(points, events, "at", "lo", "hi").groupBy("e").count().collect()
        assert sorted(map(tuple, got)) == [(1, 4000), (2, 4000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_intervals_are_listed_once_a_range(spark):
    """100 km intervals: 1,000 buckets each, but a row for each range of points only."""
    points = spark.range(40_000).select(
        F.concat(F.lit("f"), F.col("id") % 2).alias("file_name"), (F.col("id") * 2.5).alias("at"), F.col("id").cast("int").alias("p")
    )
    events = spark.range(40).select(
        F.concat(F.lit("f"), F.col("id") % 2).alias("file_name"), (F.col("id") * 10.0).alias("lo"),
        (F.col("id") * 10.0 + 100_000).alias("hi"), F.col("id").cast("int").alias("e"),
    )
    placed = sweep._in_ranges(points, ["file_name"], "at")
    ranges = sweep.ranges_of(placed, ["file_name"])
    bounded = events.withColumns({sweep._LO: F.col("lo"), sweep._HI: F.col("hi")})
    assert sweep.listed_intervals(bounded, ranges, ["file_name"]).count() <= 40 * ranges.count()
    total = F.sum(F.xxhash64("p", "e") % 1_000_003)
    swept = sweep.sweep_join(points, events, "at", "lo", "hi").agg(F.count("*"), total).first()
    assert swept == joins.band_join(points, events, "at", "lo", "hi").agg(F.count("*"), total).first()
