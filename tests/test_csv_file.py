"""One CSV file, put together by tasks."""

import csv

import pytest
from pyspark.sql import functions as F
from roadbed.session import on_workers
from roadbed.sources import sinks

ODD = ['a "quoted" one', "comma, here", " blanks around ", "two\nlines", "Ünïcode", None, "plain"]


def test_file_has_all_rows_in_order(spark, tmp_path):
    on_workers(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        odd = F.get(F.array(*map(F.lit, ODD)), (F.col("id") % len(ODD)).cast("int"))
        df = spark.range(5000).select((F.lit(9999) - F.col("id")).alias("k"), odd.alias("text, odd"), (F.col("id") / 4).alias("v"))
        path = tmp_path / "sub" / "one.csv"
        sinks.write_csv_file(df, str(path), ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [p.name for p in path.parent.iterdir()] == ["one.csv"]
    with open(path, newline="") as file:
        rows = list(csv.reader(file))
    assert rows[0] == ["index", "k", "text, odd", "v"]
    want = [[str(i), str(5000 + i), ODD[(4999 - i) % len(ODD)] or "", str((4999 - i) / 4)] for i in range(5000)]
    assert rows[1:] == want


def test_no_rows_and_no_shared_folder(spark, tmp_path):
    on_workers(spark)
    none = spark.createDataFrame([], "a int, b string")
    sinks.write_csv_file(none, str(tmp_path / "none.csv"), ["a"])
    assert (tmp_path / "none.csv").read_text() == "index,a,b\n"
    with pytest.raises(ValueError):
        sinks.write_csv_file(none, "s3://bucket/none.csv", ["a"])


def test_parts_are_copied_again_without_harm(tmp_path):
    import pyarrow as pa

    (tmp_path / "p0").write_bytes(b"abc\n")
    (tmp_path / "p1").write_bytes(b"de\n")
    whole = tmp_path / "whole"
    whole.write_bytes(b"h\n" + b"\0" * 7)
    batch = pa.record_batch([[str(tmp_path / "p1"), f"file:{tmp_path}/p0"], [6, 2]], ["path", "at"])
    for _ in range(2):
        assert [b["bytes"][0].as_py() for b in sinks._place_parts(iter([batch]), str(whole))] == [3, 4]
        assert whole.read_bytes() == b"h\nabc\nde\n"
