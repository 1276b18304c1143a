"""Small literal cases for rules that are easy to get wrong."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roadbed.operators.lines import place_on_lines
from roadbed.functions import geometry, identifiers, numbers, predicates
from roadbed.operators import gps, joins, lines, reports, series
from roadbed.operators import images
from roadbed.operators.images import dedupe_images
from roadbed.schema import BASIC, WITH_EXPORT, Profile


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rounding(spark):
    row = one(
        spark,
        numbers.bround_int(F.lit(2.5)),
        numbers.bround_int(F.lit(3.5)),
        numbers.ceil_to(F.lit(21.0)),
        numbers.ceil_to(F.lit(20.0)),
        numbers.divide_half_up(F.lit(9), 18),
        numbers.divide_half_up(F.lit(-9), 18),
        numbers.divide_half_up(F.lit(8), 18),
        numbers.from_cents(F.lit(314)),
    )
    assert tuple(row) == (2, 4, 25, 20, 1, -1, 0, Decimal("3.14"))


def test_text(spark):
    row = one(
        spark,
        numbers.km_to_int(F.lit("12+345")),
        numbers.pad_frame(F.lit("7")),
        numbers.pad_frame(F.lit("123456")),
        numbers.survey_date(F.lit("20220214 ")).cast("string"),
        numbers.survey_date(F.lit("2022-02-14 ")).cast("string"),
    )
    assert tuple(row) == (12345, "00007", "123456", "2022-02-14", "2022-02-14")


@pytest.mark.parametrize(
    ("link", "group", "kind"),
    [
        ("33600040201L2CC01", 2, 1),
        ("33600040201R6AC01", -6, 2),
        ("33600040201L7CC01", 0, 1),
        ("construction", 0, None),
        (None, 0, None),
    ],
)
def test_link(spark, link, group, kind):
    value = F.lit(link).cast("string")
    row = one(spark, identifiers.lane_group(value), identifiers.survey_type(value))
    assert tuple(row) == (group, kind)


def test_lane_number(spark):
    names = ["FL2", "FL", "R", None]
    got = one(spark, *[identifiers.lane_number(F.lit(n).cast("string")) for n in names])
    assert tuple(got) == (2, 2, 2, None)


def test_position_tests_differ(spark):
    lon, lat = F.lit(100.0), F.lit(0.0)
    row = one(
        spark,
        predicates.is_lost(lon, lat),
        predicates.has_any_fix(lon, lat),
        predicates.has_fix(lon, lat),
        predicates.has_north_fix(lon, lat),
        predicates.has_positive_fix(lon, lat),
        predicates.is_lost(F.lit(None).cast("double"), lat),
        predicates.is_lost(F.lit(None).cast("double"), F.lit(1.0), null_is_lost=True),
    )
    assert tuple(row) == (True, True, False, False, True, True, True)


def test_cap_modes(spark):
    df = spark.createDataFrame([(1, 9.5), (2, 8.0), (3, None)], "k int, v double").withColumn(
        "v", F.col("v").cast("decimal(8,2)")
    )
    clamped = numbers.cap_values(df, ["v"], ["k"], mode="clamp")
    expected = [(1, Decimal("8.00"), True), (2, Decimal("8.00"), False), (3, None, False)]
    assert [tuple(r) for r in clamped.orderBy("k").select("k", "v", "v_imputed").collect()] == expected
    drawn = numbers.cap_values(df, ["v"], ["k"])
    first = [r.v for r in drawn.orderBy("k").collect()]
    assert Decimal(7) <= first[0] <= Decimal(8)
    assert first == [r.v for r in numbers.cap_values(df, ["v"], ["k"]).orderBy("k").collect()]


def test_band_join_equals_between(spark):
    points = spark.range(0, 400).select(
        F.lit("f").alias("file_name"), (F.col("id") * 2.5).alias("c"), F.col("id").alias("p")
    )
    bounds = [(0.0, 0.0), (10.0, 260.0), (99.9, 100.0), (300.0, 200.0), (950.0, 5000.0), (None, 5.0)]
    events = spark.createDataFrame(
        [("f", lo, hi, i) for i, (lo, hi) in enumerate(bounds)],
        "file_name string, lo double, hi double, e int",
    )
    for pad, bucket in ((0.0, 100.0), (5.0, 7.0)):
        got = joins.band_join(points, events, "c", "lo", "hi", bucket=bucket, pad=pad)
        brute = [
            (p, e)
            for p in range(400)
            for e, (lo, hi) in enumerate(bounds)
            if lo is not None and lo - pad <= p * 2.5 <= hi + pad
        ]
        assert values(got, "p", "e") == sorted(brute)


@pytest.mark.parametrize("crowd", [50_000, 2])
def test_near_places_equals_brute_force(spark, crowd):
    radius = 0.00004
    spots = [(100 + i * 1.3e-5, 13 + (i * 7 % 11) * 2.1e-5, float(i)) for i in range(60)]
    spots += [(0.0, 0.0, float(c)) for c in range(100, 120)]
    goals = [(100 + i * 2.9e-5, 13 + (i % 5) * 3.7e-5, float(i)) for i in range(30)] + [
        (0.0, 0.0, 100.0),
        (-3.0, 5.0, 1.0),
    ]
    schema = "lon double, lat double, chainage double"
    file = F.lit("f").alias("file_name")
    points = spark.createDataFrame(spots, schema).select(file, "*")
    places = spark.createDataFrame(goals, schema).select(file, "*")
    positions = joins.distinct_positions(points)
    assert positions.filter("p_lon = 0").count() == 1

    def close(a, b):
        return (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= radius**2

    for other in (False, True):
        got = joins.near_places(places, positions, radius, other_chainage=other, crowd=crowd)
        expected = [
            g for g in goals if any(close(g, s) and not (other and s[2] == g[2]) for s in spots)
        ]
        assert values(got, "lon", "lat", "chainage") == sorted(expected)
    pairs = joins.distance_join(
        places, points.select(file, F.col("lon").alias("point_lon"), F.col("lat").alias("point_lat"),
                              F.col("chainage").alias("m")), radius)
    brute = [(g[2], s[2]) for g in goals for s in spots if close(g, s)]
    assert values(pairs, "chainage", "m") == sorted(brute)


def test_update_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    source = spark.createDataFrame([(1, None), (2, "y"), (2, "x")], "k int, v string")
    assert values(joins.update_from(target, source, ["k"], ["v"]).fillna("-"), "k", "v") == [
        (1, "-"),
        (2, "x"),
        (3, "c"),
    ]


def test_lengths(spark):
    # a degree of latitude at the equator and of longitude at 60° north
    row = one(
        spark,
        geometry.geodesic_segment(F.lit(0.0), F.lit(-0.05), F.lit(0.0), F.lit(0.05)),
        geometry.geodesic_segment(F.lit(10.0), F.lit(60.0), F.lit(10.1), F.lit(60.0)),
    )
    assert math.isclose(row[0], 11057.4276, rel_tol=1e-6)
    assert math.isclose(row[1], 5580.0232, rel_tol=1e-5)


VERTICES = [(0.0, 0.0, 0.0), (1.0, 3.0, 0.0), (2.0, 3.0, 0.0), (3.0, 3.0, 1.0)]


@pytest.mark.parametrize("max_rows", [None, 2])
def test_interpolation_on_arrays_and_tables(spark, max_rows):
    fractions = [0.0, 0.25, 0.5, 0.75, 0.875, 1.0, 1.5]
    by_hand = [(0, 0), (1, 0), (2, 0), (3, 0), (3, 0.5), (3, 1)]
    vertices = spark.createDataFrame([("g", *v) for v in VERTICES], "g string, m double, lon double, lat double")
    targets = spark.createDataFrame([("g", f) for f in fractions], "g string, fraction double")
    placed = lines.place_on_lines(targets, vertices, ["g"], max_rows=max_rows)
    got = placed.orderBy("fraction").select("new_lon", "new_lat").collect()
    flat = [x for r in got for x in r]
    assert flat == pytest.approx([x for pair in by_hand for x in pair])
    line = vertices.groupBy("g").agg(geometry.make_line(F.col("m"), F.col("lon"), F.col("lat")).alias("line"))
    spots = targets.join(line, "g").select(
        "fraction", geometry.interpolate_line(F.col("line"), F.col("fraction")).alias("p")
    )
    array_way = {r.fraction: r.p for r in spots.collect()}
    assert array_way.pop(1.5) is None
    flat = [x for f in fractions[:-1] for x in array_way[f]]
    assert flat == pytest.approx([x for pair in by_hand for x in pair])


def test_single_vertex_line(spark):
    vertices = spark.createDataFrame([("g", 5.0, 1.0, 2.0)], "g string, m double, lon double, lat double")
    targets = spark.createDataFrame([("g", 0.0)], "g string, fraction double")
    got = lines.place_on_lines(targets, vertices, ["g"]).first()
    assert (got.new_lon, got.new_lat) == (1.0, 2.0)


def _points(spark, rows):
    schema = "link_id string, chainage double, lon double, lat double"
    return spark.createDataFrame(rows, schema).select(
        F.lit("f").alias("file_name"), F.lit("2022-02-14").cast("date").alias("date"), "*",
        F.lit(0.0).alias("event_str"), F.lit("lost").alias("status"), F.lit(False).alias("gps_imputed"),
    )


def test_island_breaks_where_chainage_jumps(spark):
    rows = [("a", 5.0 * i, 1.0 + i, 1.0) for i in range(4)]
    rows += [("a", 20.0, 0.0, 0.0), ("a", 25.0, 0.0, 0.0), ("a", 100.0, 0.0, 0.0), ("a", 105.0, 9.0, 1.0)]
    points = _points(spark, rows)
    span = ("gap_start", "gap_end", "c_p", "meter")
    assert values(gps.gps_islands(points), *span) == [(20.0, 25.0, 2, 10), (100.0, 100.0, 1, 5)]
    assert values(gps.gps_islands(points, Profile(compat=True)), *span) == [(20.0, 100.0, 3, 15)]


def test_repair_lies_between_anchors(spark):
    rows = [("a", 5.0 * i, 10.0 + i, 1.0 + 2 * i) for i in range(20)]
    rows = [(n, c, 0.0, 0.0) if 45 <= c <= 60 else (n, c, x, y) for n, c, x, y in rows]
    # lost up to the end: no anchor behind
    rows += [("a", 100.0, 0.0, 0.0)]
    points = _points(spark, rows)
    gaps = gps.gps_gaps(points)
    repaired = gps.repair_gps(points, gaps)
    moved = repaired.filter("gps_imputed").select("chainage", "lon", "lat").collect()
    assert [tuple(r) for r in moved] == [(50.0, pytest.approx(20.0), pytest.approx(21.0))]
    assert values(gps.unrepaired_points(repaired, gaps), "chainage") == [(100.0,)]
    assert values(reports.one_sided_gaps(points, gaps), "chainage") == [(100.0,)]
    everything = gps.gap_points(points, gps.gps_islands(points), all_points=True)
    assert gps.repair_gps(points, everything).filter("gps_imputed").count() == 4


def _series(spark, numbers_in):
    metrics = ["iri_right", "iri_left", "iri_lane", "rutt_right", "rutt_left", "rutting", "texture", "etd_texture"]
    df = spark.createDataFrame([(5.0 * i, v) for i, v in enumerate(numbers_in)], "chainage double, v double")
    cols = [F.col("v").cast("decimal(8,2)").alias(m) for m in metrics]
    return df.select(
        F.lit("f").alias("file_name"), F.lit("l").alias("link_id"), F.lit(0.0).alias("event_str"),
        "chainage", *cols, F.col("v").cast("decimal(9,3)").alias("iri"),
    )


def test_smoothing_of_a_constant(spark):
    flat = _series(spark, [2.0] * 20)
    got = [r.texture for r in series.smooth_condition(flat).orderBy("chainage").collect()]
    assert got[4:16] == [Decimal("2.00")] * 12
    # the sum of five values is still divided by nine
    assert got[0] == got[-1] == Decimal("1.11")
    counted = series.smooth_condition(flat, denominator="count").select("texture", "iri").distinct()
    assert values(counted, "texture", "iri") == [(Decimal("2.00"), Decimal("2.000"))]


def test_smoothing_of_nulls(spark):
    got = series.smooth_condition(_series(spark, [9.0] * 6 + [None] + [9.0] * 6)).orderBy("chainage").collect()
    assert got[6].texture is None
    assert got[5].texture == Decimal("8.00")


def test_rutting_modes(spark):
    table = _series(spark, [1.0, 50.0, 3.0, 50.0, 5.0, 50.0])
    ref = [r.rutting for r in series.interpolate_rutting(table).orderBy("chainage").collect()]
    assert ref == [1, None, 3, 2, 5, 4]
    centred = [r.rutting for r in series.interpolate_rutting(table, "centred").orderBy("chainage").collect()]
    assert centred == [1, 2, 3, 4, 5, None]


def test_picture_renaming(spark):
    rows = [
        ("r-00010.jpg", 100.0), ("r-00010.jpg", 110.0), ("r-00010.jpg", 200.0),
        ("r-00015.jpg", 0.0), ("r-00015.jpg", 24.0), ("r-00012.jpg", 5.0), ("r-00012.jpg", 6.0),
        ("r-00020.jpg", 7.0), (None, 8.0), (None, 9.0),
    ]
    images = spark.createDataFrame(rows, "filename string, img_id double").select(
        F.concat(F.lit("d/image/"), "filename").alias("directory"), "filename", "img_id",
        F.lit("f").alias("file_name"), F.lit("l").alias("link_id"),
        F.lit("2022-02-14").cast("date").alias("date"), F.lit(1).alias("survey_point_id"),
    )
    got = dedupe_images(images)
    assert got.count() == len(rows)
    changed = got.join(images.select("filename", "img_id"), ["filename", "img_id"], "left_anti")
    named = changed.filter("filename is not null")
    assert values(named, "filename", "directory", "img_id") == [
        ("r-00013.jpg", "d/image/r-00013.jpg", 110.0),
        ("r-00017.jpg", "d/image/r-00017.jpg", 24.0),
    ]


def test_missing_value_precedence(spark):
    rows = [(3.0, None, 1, 1, "1"), (3.0, 1, 1, 1, None), (25.0, 1, 1, 1, None), (25.0, 1, None, 1, "1")]
    df = spark.createDataFrame(rows, "chainage double, iri int, rutting int, texture int, frame_number string")
    df = df.select(F.lit("f").alias("file_name"), F.lit("l").alias("link_id"), "*")
    assert values(reports.missing_values(df, BASIC), "chainage") == [(3.0,), (25.0,), (25.0,)]
    assert values(reports.missing_values(df, WITH_EXPORT), "chainage") == [(3.0,), (25.0,)]
    assert values(reports.missing_values(df, BASIC, grid_only=True), "chainage") == [(25.0,), (25.0,)]


def test_missing_positions_can_count_as_lost(spark):
    rows = [("a", 0.0, 1.0, 1.0), ("a", 25.0, None, None), ("a", 30.0, 2.0, 1.0)]
    points = _points(spark, rows)
    assert gps.gps_islands(points).count() == 0
    assert values(gps.gps_islands(points, Profile(null_is_lost=True)), "gap_start") == [(25.0,)]


@pytest.mark.parametrize("step", [20 / 7, 20 / 11, 8 / 3])
@pytest.mark.parametrize("max_rows", [None, 3])
def test_each_target_on_a_vertex_is_placed_once(spark, step, max_rows):
    ids = spark.range(40).withColumnRenamed("id", "k")
    vertex = F.explode(F.sequence(F.lit(0), F.lit(8))).alias("m")
    vertices = ids.select("k", vertex).select(
        "k", F.col("m").cast("double").alias("m"), (F.col("m") * step * 1e-6).alias("lon"), F.lit(1.0).alias("lat")
    )
    targets = ids.select("k", ((F.col("k") % 9) / 8).alias("fraction"))
    got = place_on_lines(targets, vertices.union(vertices.limit(5)), ["k"], max_rows=max_rows).collect()
    assert sorted(r.k for r in got) == list(range(40))
    assert all(abs(r.new_lon - r.k % 9 * step * 1e-6) < 1e-15 for r in got)


def test_copy_manifest_reads_the_run_from_the_name(spark):
    names = ["20220201_12_00010.jpg", "20220201_2_00015.jpg"]
    rows = spark.createDataFrame([(n, f"a/{n}") for n in names], "filename string, directory string")
    sources = [r.src for r in images.image_copy_manifest(rows).orderBy("src").collect()]
    assert [s.split("\\")[2] for s in sources] == ["20220201_12", "20220201_2"]


def test_rows_of_lines_are_brought_together_once(spark, monkeypatch):
    """One exchange for the distinct vertices, the sums along a line and its totals."""
    staged = []
    monkeypatch.setattr(lines, "stage", lambda df, name: staged.append(df) or df)
    vertices = spark.createDataFrame([("g", *v) for v in VERTICES * 2], "g string, m double, lon double, lat double")
    targets = spark.createDataFrame([("g", 0.5)], "g string, fraction double")
    placed = lines.place_on_lines(targets, vertices, ["g"])
    assert staged[0]._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert [(r.new_lon, r.new_lat) for r in placed.collect()] == [(2.0, 0.0)]


def test_only_grid_points_are_joined_to_positions(spark):
    rows = [("a", c, 0.0, 0.0) for c in (0.0, 5.0, 25.0, 25.0, -0.0, -25.0, None, float("nan"))]
    points = spark.createDataFrame(rows, "link_id string, chainage double, lon double, lat double").withColumns(
        {"file_name": F.lit("r"), "date": F.lit("d"), "gps_imputed": F.lit(False)}
    )
    gaps = [("r", "d", "a", c, c + 1, 2.0) for c in (0.0, 25.0, -25.0)]
    names = "file_name string, date string, link_id string, chainage double, new_lon double, new_lat double"
    positions = spark.createDataFrame(gaps, names)
    moved = gps.move_points(points, positions, 25.0)
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "Join" not in plan.split("\n+- ")[-1]

    def shown(df):
        return sorted(map(str, df.collect()))

    assert shown(moved) == shown(gps.move_points(points, positions))
    assert moved.filter("gps_imputed").count() == 5
