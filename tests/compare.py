"""Run registered queries next to their SQL twins and compare all values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    text = df.map(lambda v: "∅" if v is None else str(int(v)) if isinstance(v, float) else str(v))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(got: pd.DataFrame, expected: pd.DataFrame) -> str:
    """Empty if both hold the same rows in any order."""
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    a, b = _normal(got), _normal(expected)
    wrong = (a != b).any(axis=1)
    if not wrong.any():
        return ""
    columns = [c for c in a.columns if (a[c] != b[c]).any()]
    return f"{wrong.sum()} rows differ in {columns}\n{a[wrong].head(3)}\n{b[wrong].head(3)}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins = open_tables(sf_dir), entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            types = {f.name: f.dataType.simpleString() for f in frame.schema}
            got = frame.toPandas()
            took = time.time() - start
            if name not in twins:
                print(f"{name:24} {len(got):7} rows only {took:.1f}s", flush=True)
                continue
            described = con.execute(f"describe {twins[name]}").fetchall()
            expected_types = {row[0]: row[1].lower() for row in described}
            problem = differences(got, con.execute(twins[name]).df())
            same_type = {"string": "varchar"}
            odd = {
                c: (t, expected_types.get(c))
                for c, t in types.items()
                if same_type.get(t, t) != expected_types.get(c)
            }
            print(f"{name:24} {len(got):7} {'ok' if not problem else 'DIFF'} {took:.1f}s {odd or ''} {problem}", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"{name:24} ERROR {str(error)[:600]}", flush=True)
