"""Publications: several tables that appear together, and the ids they were given.

The tables of a publication are written beside the live ones, in a folder of their own.
Then one row is appended to the manifest, as one file: it names every table's folder
and the ids it used. Readers go by the newest row, so they see all tables
of a publication or none, and a run that fails in between shows nothing. The
same rows are the id ledger: a new publication goes on behind the highest id, and
one that is made again gets the ids it had.

One publication is written at a time; that is for the scheduler of the jobs to see to.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from roadbed.session import exists, list_folders, remove

_ENTRY = "struct<name:string,path:string,n:bigint,id:string,before:bigint,last:bigint>"
_MANIFEST = f"version bigint, key string, tables array<{_ENTRY}>"


@dataclass(frozen=True)
class Publisher:
    """Publications in ``root``.

    ``ids`` names the id column of each table whose ids go on from one
    publication to the next.
    """

    spark: SparkSession
    root: str
    ids: Mapping[str, str]

    @property
    def _manifest(self) -> str:
        return f"{self.root}/_manifest"

    def history(self) -> DataFrame:
        """(version, key, tables): one row for each publication."""
        if not exists(self.spark, self._manifest):
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(self._manifest)

    def _rows(self) -> list[Row]:
        """The manifest, newest first: a row for each publication there ever was."""
        return self.history().orderBy(F.desc("version")).collect()

    def tables(self, version: int | None = None) -> dict[str, Row]:
        """Entries of a publication, the newest one if not told, by table name."""
        found = [r for r in self._rows() if version is None or r.version == version]
        return {e.name: e for e in found[0].tables} if found else {}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A published table; one that was not published is an error."""
        entry = self.tables(version).get(name)
        if entry is None:
            raise LookupError(f"{name} is not in publication {version or 'newest'} of {self.root}")
        return self.spark.read.parquet(f"{self.root}/{entry.path}")

    def start_ids(self, key: str) -> dict[str, int]:
        """The id that ids of each table go on from, for the publication ``key``.

        A key that was published before starts where it started then.
        """
        rows = self._rows()
        starts = dict.fromkeys(self.ids, 0)
        for row in rows:
            for entry in row.tables:
                if entry.name in starts:
                    starts[entry.name] = max(starts[entry.name], entry.last)
        own = next((r for r in rows if r.key == key), None)
        return starts | {e.name: e.before for e in (own.tables if own else []) if e.name in starts}

    def next_version(self) -> int:
        return 1 + max((r.version for r in self._rows()), default=0)

    def publish(self, key: str, tables: Mapping[str, DataFrame], version: int | None = None) -> int:
        """Write ``tables`` and make them the newest publication; returns its version.

        Ids must be those that ``start_ids`` told: above its start, and below what
        later publications use. A key that is published again replaces its tables; the ids of
        its old rows stay taken. ``version`` must be the next one, if told.
        """
        rows, starts, coming = self._rows(), self.start_ids(key), self.next_version()
        if version not in (None, coming):
            raise ValueError(f"version {coming} comes next, not {version}")
        version = coming
        folder = f"v{version}-{uuid.uuid4().hex}"
        entries = []
        for name, table in tables.items():
            path = f"{folder}/{name}"
            table.write.parquet(f"{self.root}/{path}")
            entries.append((name, path, *self._ids_of(name, path, key, starts, rows)))
        row = self.spark.createDataFrame([(version, key, entries)], _MANIFEST)
        # one row, one file: it is there or it is not
        row.coalesce(1).write.mode("append").parquet(self._manifest)
        return version

    def _ids_of(self, name: str, path: str, key: str, starts: Mapping[str, int], rows: list[Row]) -> tuple:
        """(rows, id column, id before the first, last id) of a written table, checked."""
        written = self.spark.read.parquet(f"{self.root}/{path}")
        column = self.ids.get(name)
        if column is None:
            return written.count(), None, None, None
        value = F.col(column)
        n, different, low, high = written.agg(F.count("*"), F.countDistinct(value), F.min(value), F.max(value)).first()
        before = starts[name]
        last = before if high is None else high
        others = [e for r in rows if r.key != key for e in r.tables if e.name == name and e.n]
        if different < n or (low is not None and low <= before):
            raise ValueError(f"{name}: {n} rows have {different} ids from {low}; they must be different and above {before}")
        if clash := [e for e in others if e.before < last and before < e.last]:
            raise ValueError(f"{name}: ids {before + 1} to {last} meet those of {clash[0].path}")
        return n, column, before, last

    def remove_unpublished(self) -> list[str]:
        """Delete folders that no publication names: what failed runs have left. Not while one is written."""
        named = {e.path.split("/")[0] for r in self._rows() for e in r.tables}
        gone = [f for f in list_folders(self.spark, self.root) if f.startswith("v") and f not in named]
        for folder in gone:
            remove(self.spark, f"{self.root}/{folder}")
        return gone
