"""Row order: contiguous ids, neighbours and running totals.

A window puts a whole group into one task. Groups here are survey runs and
links, usually some thousand rows, but one of them may hold a large part of all
rows. ``OrderedGroups`` measures that first: small groups use plain windows,
larger ones are numbered in order across tasks and cut into chunks of equal
row count, with the few border rows a frame needs copied to the next chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadbed.session import stage

#: groups above this many rows are cut into chunks of this size
MAX_GROUP_ROWS = 2_000_000

#: keys of large groups are broadcast up to this many
MAX_BROADCAST_KEYS = 100_000

_RID = "__rid"
_CHUNK = "__chunk"
_HOME = "__home"


def _as_order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def same(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]):
    """Join condition in which NULL equals NULL."""
    condition = F.lit(True)
    for a, b in zip(left_keys, right_keys):
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def with_row_id(
    df: DataFrame, order: Sequence[str | Column], start: int = 0, name: str = "row_id"
) -> DataFrame:
    """Contiguous ids start+1, start+2, … in ``order``, without a one-task window.

    Rows are range-partitioned and sorted, then written once: the place of a row
    is fixed before anything is counted. An id is the row's place in its
    partition plus the rows of all partitions before it; only those counts, one
    per partition, are summed in a single task.
    """
    place, part = "__place", "__part"
    # a hash of the row ends the order, so equal keys still spread and repeat
    keys = [*_as_order(order), F.xxhash64(*df.columns)]
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(place, F.monotonically_increasing_id())
    )
    pinned = stage(ordered, "row-order").withColumn(part, F.shiftright(place, 33))
    before = Window.orderBy("n_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pinned.groupBy(F.col(part).alias("n_part"))
        .agg(F.count("*").alias("n"))
        .select("n_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    )
    # one row per partition: small whatever the data
    numbered = pinned.join(F.broadcast(offsets), F.col(part) == F.col("n_part"))
    row = F.col(place) - F.shiftleft(part, 33) + F.col("n_before") + 1 + F.lit(start)
    return numbered.withColumn(name, row.cast("bigint")).drop(place, part, "n_part", "n_before")


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group; counted on the map side first."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


class OrderedGroups:
    """Rows of ``df`` in ``order`` within ``keys``; see the module text."""

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int | None = None,
        largest: int | None = None,
    ):
        """``largest`` is the size of the largest group, or an upper bound of it
        such as that of coarser groups, if already known; else it is counted."""
        self.keys, self.order = list(keys), list(order)
        self.max_rows = max_rows or MAX_GROUP_ROWS
        self.small, self.large, self.few = df, None, True
        self.largest = largest_group(df, self.keys) if largest is None else largest
        if self.largest <= self.max_rows:
            return
        # read by the count and by both halves of the split
        df = stage(df, "grouped")
        names = [f"__k{i}" for i in range(len(self.keys))]
        sizes = df.groupBy(*[F.col(k).alias(n) for k, n in zip(self.keys, names)]).agg(
            F.count("*").alias("n")
        )
        hot = sizes.filter(F.col("n") > self.max_rows).select(*names)
        # at most rows / max_rows keys, and counted before they are sent around
        hot = stage(hot, "large-groups")
        self.few = hot.count() <= MAX_BROADCAST_KEYS
        hot = self._small_side(hot)
        match = same(df, hot, self.keys, names)
        self.small = df.join(hot, match, "left_anti")
        numbered = with_row_id(
            df.join(hot, match, "left_semi"), [*self.keys, *self.order], start=-1, name=_RID
        )
        self.large = numbered.withColumn(_CHUNK, F.expr(f"{_RID} div {self.max_rows}"))

    def _small_side(self, keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if self.few else keys

    def _next(self, small: DataFrame, large: DataFrame | None) -> OrderedGroups:
        twin = object.__new__(OrderedGroups)
        twin.keys, twin.order = self.keys, self.order
        twin.max_rows, twin.largest, twin.few = self.max_rows, self.largest, self.few
        twin.small, twin.large = small, large
        return twin

    def map(self, change: Callable[[DataFrame], DataFrame]) -> OrderedGroups:
        """Apply a row-wise change."""
        return self._next(change(self.small), None if self.large is None else change(self.large))

    def frames(
        self, columns: Mapping[str, Callable[[WindowSpec], Column]], before: int, after: int
    ) -> OrderedGroups:
        """Add window columns that look at most ``before``/``after`` rows away."""
        window = Window.partitionBy(*self.keys).orderBy(*_as_order(self.order))
        small = self.small.withColumns({n: make(window) for n, make in columns.items()})
        if self.large is None:
            return self._next(small, None)
        size, chunk, row = self.max_rows, F.col(_CHUNK), F.col(_RID)
        if max(before, after) > size:
            raise ValueError("a frame cannot be wider than a chunk")
        targets = F.array_compact(
            F.array(
                chunk,
                F.when(row % size >= size - before, chunk + 1),
                F.when(row % size < after, chunk - 1),
            )
        )
        copies = self.large.withColumn(_HOME, chunk).withColumn(_CHUNK, F.explode(targets))
        window = Window.partitionBy(*self.keys, _CHUNK).orderBy(_RID)
        large = copies.withColumns({n: make(window) for n, make in columns.items()})
        return self._next(small, large.filter(chunk == F.col(_HOME)).drop(_HOME))

    def row_number(self, name: str) -> OrderedGroups:
        """1-based number of the row in its group."""
        window = Window.partitionBy(*self.keys).orderBy(*_as_order(self.order))
        small = self.small.withColumn(name, F.row_number().over(window).cast("bigint"))
        if self.large is None:
            return self._next(small, None)
        names = [f"__k{i}" for i in range(len(self.keys))]
        firsts = self.large.groupBy(*[F.col(k).alias(n) for k, n in zip(self.keys, names)]).agg(
            F.min(_RID).alias("__first")
        )
        large = (
            self.large.join(self._small_side(firsts), same(self.large, firsts, self.keys, names))
            .withColumn(name, F.col(_RID) - F.col("__first") + 1)
            .drop("__first", *names)
        )
        return self._next(small, large)

    def running_sum(
        self, name: str, value: Column, peers_by: Sequence[str] | None = None
    ) -> OrderedGroups:
        """Sum from the first row of the group to this one.

        With ``peers_by`` (a prefix of the order) rows that are equal there
        share the total of the last of them, as SQL's default frame has it.
        """
        order = _as_order(peers_by or self.order)
        frame = Window.partitionBy(*self.keys).orderBy(*order)
        if peers_by is None:
            frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        small = self.small.withColumn(name, F.sum(value).over(frame))
        if self.large is None:
            return self._next(small, None)
        large = self._running_sum_large(name, value)
        if peers_by is not None:
            on = [*self.keys, *peers_by]
            names = [f"__p{i}" for i in range(len(on))]
            last = large.groupBy(*[F.col(k).alias(n) for k, n in zip(on, names)]).agg(
                F.max_by(F.col(name), F.col(_RID)).alias("__last")
            )
            large = (
                large.join(last, same(large, last, on, names))
                .withColumn(name, F.col("__last"))
                .drop("__last", *names)
            )
        return self._next(small, large)

    def _running_sum_large(self, name: str, value: Column) -> DataFrame:
        rows = self.large.withColumn("__v", value)
        on = [*self.keys, _CHUNK]
        names = [f"__c{i}" for i in range(len(on))]
        totals = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(on, names)]).agg(
            F.sum("__v").alias("__total")
        )
        earlier = (
            Window.partitionBy(*names[:-1])
            .orderBy(names[-1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        totals = totals.withColumn("__before", F.sum("__total").over(earlier)).drop("__total")
        here = (
            Window.partitionBy(*on)
            .orderBy(_RID)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        local = F.sum("__v").over(here)
        known = local.isNotNull() | F.col("__before").isNotNull()
        total = F.when(known, F.coalesce(local, F.lit(0)) + F.coalesce("__before", F.lit(0)))
        return (
            rows.join(totals, same(rows, totals, on, names))
            .withColumn(name, total)
            .drop("__v", "__before", *names)
        )

    def to_df(self) -> DataFrame:
        if self.large is None:
            return self.small
        return self.small.unionByName(self.large.drop(_RID, _CHUNK))
