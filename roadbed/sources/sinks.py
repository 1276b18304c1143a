"""Publishing tables as parquet, CSV, INSERT statements and script lines."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbed.functions.geometry import line_wkt, point_wkt
from roadbed.operators.ordering import with_row_id
from roadbed.session import remove, stage, stage_root

_BARE = (T.NumericType, T.BooleanType)

#: rows of an INSERT statement, and bytes of a file of them
ROWS_PER_STATEMENT, MAX_FILE_BYTES = 500, 64 << 20

_ROW = "__row"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Write parquet; rows of one partition value are brought together first.

    Rebalancing happens on measured sizes: small values share a task, and one
    that would fill a task is split over several, with a file each. ``cluster_by``
    keeps rows together inside a partition, without a folder each. Of a
    partitioned table only the partitions that ``df`` has are written anew.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def indexed(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Put a row index, from 0, in front."""
    with_index = with_row_id(df, order, start=-1, name=name)
    return with_index.select(name, *df.columns)


def csv_ready(df: DataFrame) -> DataFrame:
    """Structs and arrays as JSON text; all else as it is."""
    nested = {
        f.name: F.to_json(f.name)
        for f in df.schema
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
    }
    return df.withColumns(nested) if nested else df


def write_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """CSV with header and row index."""
    csv_ready(indexed(df, order)).write.mode("overwrite").option("header", True).csv(path)


_COPY_BYTES = 4 << 20


def _place_parts(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """Copies each listed part to its own place in the file; repeating it changes nothing."""
    for batch in batches:
        for path, at in zip(batch["path"].to_pylist(), batch["at"].to_pylist()):
            done = 0
            with open(local_path(path), "rb") as part, open(target, "r+b") as whole:
                whole.seek(at)
                while block := part.read(_COPY_BYTES):
                    done += whole.write(block)
            yield pa.record_batch([pa.array([path]), pa.array([done], pa.int64())], ["path", "bytes"])


def local_path(path: str) -> str:
    """A path below the shared folder, without the scheme ``file``."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: one file needs a folder that can be written at any place")
    return path


def write_csv_file(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """One CSV file at ``path``, with header and row index, rows by ``order``.

    Tasks write lines in ordered parts; the list of parts and their sizes is
    committed, which fixes where each belongs, and tasks copy the parts to their
    places in the file, side by side. It appears under its name once it is whole.
    ``path`` is in a folder all executors share and can write at any place; for
    other stores ``write_csv`` gives the parts. No rows give the header alone.
    """
    spark, target = df.sparkSession, local_path(path)
    ready = csv_ready(indexed(df, order))
    index = ready.columns[0]
    header = ",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n') else c for c in ready.columns) + "\n"
    # marks as Spark's CSV reader takes them: doubled, not escaped
    line = F.to_csv(F.struct(*ready.columns), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    lines = ready.select(index, line.alias("line")).repartitionByRange(index).sortWithinPartitions(index)
    parts = f"{stage_root(spark)}/csv-{uuid.uuid4().hex}"
    lines.select("line").write.text(parts)
    # names of parts follow their order; sizes are of what the job committed
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(parts)
    listed = with_row_id(listed.select("path", F.col("length").alias("bytes")), ["path"], name="part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    at = F.coalesce(F.sum("bytes").over(before), F.lit(0)) + len(header.encode())
    listed = stage(listed.withColumn("at", at.cast("bigint")), "csv-parts")
    size = listed.agg(F.max(F.col("at") + F.col("bytes"))).first()[0] or len(header.encode())
    growing = f"{target}.{uuid.uuid4().hex}"
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    with open(growing, "wb") as whole:
        whole.write(header.encode())
        whole.truncate(size)
    tasks = max(1, min(listed.count(), spark.sparkContext.defaultParallelism))
    copied = listed.repartition(tasks, "part").mapInArrow(lambda b: _place_parts(b, growing), "path string, bytes bigint")
    if (copied.agg(F.sum("bytes")).first()[0] or 0) + len(header.encode()) != size:
        os.remove(growing)
        raise OSError(f"{path}: parts are not whole")
    os.replace(growing, target)
    remove(spark, parts)


def _is_position(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and {"lon", "lat"} <= set(kind.names)


def _literal(field: T.StructField) -> Column:
    value = F.col(field.name)
    if _is_position(field.dataType):
        text = point_wkt(value.lon, value.lat)
    elif isinstance(field.dataType, T.ArrayType) and _is_position(field.dataType.elementType):
        text = line_wkt(value)
    elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    if not isinstance(field.dataType, _BARE):
        quote = F.lit("'")
        text = F.concat(quote, F.replace(text, quote, F.lit("''")), quote)
    return F.coalesce(text, F.lit("NULL"))


def to_insert_statements(df: DataFrame, table: str) -> DataFrame:
    """One INSERT statement per row, in the column ``statement``.

    Positions and lines of them are written as WKT.
    """
    head = f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("
    values = F.concat_ws(", ", *[_literal(f) for f in df.schema])
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("statement"))


def multi_row_statements(
    df: DataFrame, table: str, order: Sequence[str], rows_per_statement: int = ROWS_PER_STATEMENT
) -> DataFrame:
    """(statement_no, n_rows, statement): INSERT statements of several rows each, in ``order``.

    Rows are numbered in order across tasks; a statement has the next
    ``rows_per_statement`` of them, the last one what is left.
    """
    values = F.concat(F.lit("("), F.concat_ws(", ", *[_literal(f) for f in df.schema]), F.lit(")"))
    numbered = with_row_id(df, order, start=-1, name=_ROW)
    rows = F.sort_array(F.collect_list(F.struct(_ROW, "values")))  # rows_per_statement at most
    grouped = (
        numbered.select(_ROW, values.alias("values"))
        .groupBy(F.expr(f"{_ROW} div {rows_per_statement}").alias("statement_no"))
        .agg(F.count("*").alias("n_rows"), rows.alias("rows"))
    )
    head = f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES "
    text = F.array_join(F.transform("rows", lambda r: r["values"]), ", ")
    return grouped.select("statement_no", "n_rows", F.concat(F.lit(head), text, F.lit(";")).alias("statement"))


def write_insert_files(
    tables: Sequence[tuple[str, DataFrame, Sequence[str]]],
    folder: str,
    rows_per_statement: int = ROWS_PER_STATEMENT,
    max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """Files of INSERT statements that load in order; writes and returns their list.

    ``tables`` are (name, rows, order), parents before children. The list has
    (load_no, table, path, lines, bytes), also written as ``folder/load_order``:
    files loaded by ascending number give the tables back. No file is longer
    than ``max_bytes`` unless one statement is. A table without rows has none.
    """
    spark, listed = tables[0][1].sparkSession, []
    for place, (name, df, order) in enumerate(tables):
        path = f"{folder}/{name}"
        statements = stage(multi_row_statements(df, name, order, rows_per_statement), "statements")
        longest = statements.agg(F.max(F.octet_length("statement"))).first()[0] or 0
        # ranges become files in order of their names; a long range is cut into several
        ordered = statements.repartitionByRange("statement_no").sortWithinPartitions("statement_no")
        per_file = max(1, max_bytes // (longest + 1))
        ordered.select("statement").write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path)
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
        size = F.sum(F.octet_length("value") + 1)
        found = lines.groupBy("path").agg(F.count("*").alias("lines"), size.alias("bytes"))
        listed.append(found.select(F.lit(place).alias("place"), F.lit(name).alias("table"), "path", "lines", "bytes"))
    numbered = with_row_id(reduce(DataFrame.union, listed), ["place", "path"], name="load_no")
    numbered = numbered.select("load_no", "table", "path", "lines", "bytes")
    numbered.coalesce(1).write.mode("overwrite").parquet(f"{folder}/load_order")  # a row for each file
    return spark.read.parquet(f"{folder}/load_order")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)
