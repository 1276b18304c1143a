"""Helpers the operators share: input columns, ordered shards, sorted runs."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbed.operators.ordering import with_row_id
from roadbed.session import stage

#: key of rows whose id is NULL: they come last in every order
NULL_KEY = 2**63 - 1


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so other columns cannot clash; NULL text is empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    A cluster installs the package or ships it with ``--py-files``; this is for
    sessions that were started in another folder.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def held_out(doc_id: Column) -> Column:
    """Third of the ids that no model may learn from; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


#: what this Python worker keeps from task to task, by owner: of one owner at a time
_KEPT: dict = {}


def kept(owner: Hashable, make: Callable):
    """What ``make`` gives, for later tasks of this worker as well, until ``slices`` serves another owner."""
    if owner not in _KEPT:
        _KEPT[owner] = make()
    return _KEPT[owner]


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = 256, owner: Hashable = None
) -> Iterator[pa.RecordBatch]:
    """Short batches, so that a task holds few texts as Python objects at once.

    Spark uses a worker again for other operators; what they kept in it goes.
    """
    if others := [other for other in _KEPT if other != owner]:
        for other in others:
            del _KEPT[other]
        gc.collect()  # else freed memory stays with the worker
        pa.default_memory_pool().release_unused()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ordered_shards(
    df: DataFrame, key: str, tie: str, rows_per_shard: int, max_shards: int = 4096
) -> list[tuple[int, int]]:
    """First (key, tie) of each of at most ``max_shards`` ranges of equal row count.

    ``key`` and ``tie`` are BIGINT columns without NULLs. The bounds are exact
    ranks, so the same rows give the same ranges in every run. Identical rows
    share a range. Empty input gives no bounds.
    """
    ranked = with_row_id(df.select(key, tie), [key, tie])
    n = ranked.count()
    if not n:
        return []
    step = max(rows_per_shard, -(-n // max_shards))
    firsts = ranked.filter((F.col("row_id") - 1) % step == 0).select(key, tie)
    return sorted({(r[0], r[1]) for r in firsts.collect()})  # max_shards rows at most


def shard_of(bounds: list[tuple[int, int]], key: str, tie: str) -> Column:
    """Number of the range a row falls in: a binary search over the bounds."""
    if len(bounds) < 2:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(a).alias("k"), F.lit(b).alias("t")) for a, b in bounds])
    row = F.struct(F.col(key).alias("k"), F.col(tie).alias("t"))
    powers = [2**i for i in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, power: Column) -> Column:
        bound = F.get(table, at + power)
        return F.when(bound.isNotNull() & (bound <= row), at + power).otherwise(at)

    return F.aggregate(F.array(*[F.lit(p) for p in powers]), F.lit(0), step)


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of a sorted stream, cut where whole groups end, and the group starts.

    The first ``n_keys`` columns are the key. Yields (columns, starts) where
    ``starts`` has the first row of each group and a last entry for the end.
    """
    held: list[list[np.ndarray]] = []  # parts of the group that is open
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held:
            if all((key == was[-1]).all() for key, was in zip(now[:n_keys], held[-1])):
                held.append(now)  # a large group is put together once, at its end
                continue
            now = [np.concatenate(parts) for parts in zip(*held, now)]
        starts = _starts(now[:n_keys])
        cut = starts[-1]  # the last group may go on in the next batch
        held = [[c[cut:] for c in now]]
        if cut:
            yield [c[:cut] for c in now], np.append(starts[:-1], cut)
    if held:
        rest = [np.concatenate(parts) for parts in zip(*held)]
        yield rest, np.array([0, len(rest[0])])


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


#: marks of rows that are looked up, and of rows that look up, within a group
INDEX, PROBE = 1, 2

#: keys of large groups are broadcast up to this many
MAX_BROADCAST_KEYS = 100_000


def in_cells(keyed: DataFrame, by: str, max_rows: int) -> DataFrame:
    """``keyed`` (with key and kind) and columns cell and role: rows that meet share key and cell.

    Most keys are one cell. One of ``b`` times ``max_rows`` rows is a square of
    ``b`` x ``b`` cells, in which a row has its place by ``by``: as ``INDEX`` it goes to all
    cells of a line, as ``PROBE`` to all of a column, so a pair meets in one cell for
    each way round its kinds allow. ``role`` is what of its kind a row plays in a cell.
    """
    large = keyed.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > max_rows)
    large = staged(large.select("key", F.ceil(F.col("rows") / max_rows).cast("int").alias("b")), "large-keys")
    # at most rows / max_rows keys, counted before they are sent around
    large = F.broadcast(large) if large.count() <= MAX_BROADCAST_KEYS else large
    own = F.pmod(F.xxhash64(by), F.col("b")).cast("int")
    others = F.sequence(F.lit(0), F.col("b") - 1)

    def cells(kind: int, place) -> Column:
        line = F.transform(others, lambda j: F.struct(place(j).alias("cell"), F.lit(kind).cast("tinyint").alias("role")))
        return F.when(F.col("kind").bitwiseAND(kind) > 0, line).otherwise(F.slice(line, 1, 0))

    square = F.concat(cells(INDEX, lambda j: own * F.col("b") + j), cells(PROBE, lambda j: j * F.col("b") + own))
    single = F.array(F.struct(F.lit(0).alias("cell"), F.col("kind").alias("role")))
    place = F.explode(F.when(F.col("b").isNull(), single).otherwise(square)).alias("place")
    rest = [c for c in keyed.columns if c != "key"]
    found = keyed.join(large, "key", "left").select("key", *rest, place)
    return found.select("key", "place.cell", *rest, "place.role")


def staged(df: DataFrame, name: str) -> DataFrame:
    return stage(df, f"llm-{name}")
