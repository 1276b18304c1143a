"""Conditioning only the runs that changed.

Runs do not touch each other: every operator works within ``file_name``, and only
ids are counted over all of them. So a publication holds the rows of the runs it
worked out, and a ledger that names for every run the publication that has its rows
and a digest of what went in. Runs whose digest is the ledger's are left alone,
with the ids they have; the others are worked out again and get new ids.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.operators import export, survey_points
from roadbed.plans.pipeline import Inputs, run_pipeline
from roadbed.schema import Profile
from roadbed.session import stage, stage_scope
from roadbed.sources.publication import Publisher

RUN = "file_name"
LEDGER = "runs"
#: published tables whose rows belong to one run each
RUN_TABLES = ("survey", "survey_point_local", "survey_image")
#: tables whose ids go on from one publication to the next
IDS = {"survey": "survey_id", "survey_point_local": "survey_point_id"}

Work = Callable[[Inputs, Profile], Mapping[str, DataFrame]]


def _rows_digest(df: DataFrame, name: str) -> DataFrame:
    """(file_name, name): number of rows of each run and two sums over their hashes.

    Order and layout of the rows do not matter; values, NULLs and copies do.
    """
    columns = sorted(c for c in df.columns if c != RUN)
    # a hash leaves NULLs out, so where they stand is hashed as well
    values: list[Column] = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")).cast("string")
    parts = F.concat_ws(":", F.lit(",".join(columns)), F.count("*").cast("string"), total(1), total(2))
    return df.groupBy(RUN).agg(parts.alias(name))


def run_digests(inputs: Inputs, cfg: Profile) -> DataFrame:
    """(file_name, digest) of every run: what its laser, events, pictures and corrections
    hold, and the settings that decide what is made of them."""
    tables = {"laser": inputs.laser, "key": inputs.key, "pic": inputs.pic, "corrections": inputs.corrections}
    found = [_rows_digest(df, name) for name, df in tables.items() if df is not None]
    joined = reduce(lambda a, b: a.join(b, RUN, "full"), found)
    settings = replace(cfg, survey_start_id=0, survey_point_start_id=0)
    parts = [F.coalesce(F.col(c), F.lit("-")) for c in joined.columns if c != RUN]
    return joined.select(RUN, F.sha2(F.concat_ws("|", F.lit(repr(settings)), *parts), 256).alias("digest"))


def only_runs(df: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of the runs told; ``runs`` has a row for each."""
    return df.join(runs.select(RUN), RUN, "left_semi").select(*df.columns)


@dataclass(frozen=True)
class Conditioned:
    """Tables of all runs after an incremental run, and what it worked out.

    ``changed`` has the runs that were worked out, ``reports`` their reports.
    """

    version: int
    changed: DataFrame
    reports: dict[str, DataFrame]


def _ledger(publisher: Publisher, version: int | None = None) -> DataFrame:
    if LEDGER in publisher.tables(version):
        return publisher.read(LEDGER, version)
    return publisher.spark.createDataFrame([], f"{RUN} string, digest string, version bigint")


def read_runs(publisher: Publisher, name: str, version: int | None = None) -> DataFrame:
    """A table of all runs, each from the publication that worked it out last.

    There are as many parts as publications that still have a run in use.
    """
    ledger = _ledger(publisher, version)
    versions = [r[0] for r in ledger.select("version").distinct().orderBy("version").collect()]
    if not versions:
        raise LookupError(f"{name} is not in {publisher.root}")
    parts = [only_runs(publisher.read(name, v), ledger.filter(F.col("version") == v)) for v in versions]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def condition_changed(
    publisher: Publisher,
    key: str,
    inputs: Inputs,
    cfg: Profile = Profile(),
    work: Work = run_pipeline,
    tables: Sequence[str] = RUN_TABLES,
) -> Conditioned:
    """Work out the runs of ``inputs`` that are new or changed, and publish them under ``key``.

    ``inputs`` are all runs there are: runs that are missing leave the ledger,
    and with it the tables. Stage tables are removed at the end. Equal inputs
    and settings publish an empty part.
    """
    spark = publisher.spark
    with stage_scope(spark):
        now = stage(run_digests(inputs, cfg), "run-digests")
        before = stage(_ledger(publisher), "run-ledger")
        kept = now.join(before, [RUN, "digest"]).select(RUN, "digest", "version")
        changed = stage(now.join(kept, RUN, "left_anti"), "changed-runs")
        own = replace(
            inputs,
            **{
                name: only_runs(df, changed)
                for name in ("laser", "key", "pic", "corrections")
                if (df := getattr(inputs, name)) is not None
            },
        )
        starts = publisher.start_ids(key)
        cfg = replace(
            cfg,
            survey_start_id=starts.get("survey", 0),
            survey_point_start_id=starts.get("survey_point_local", 0),
        )
        made = work(own, cfg)
        version = publisher.next_version()
        ledger = kept.union(changed.select(RUN, "digest", F.lit(version).cast("bigint").alias("version")))
        reports = {name: df for name, df in made.items() if name.startswith("qa_")}
        publisher.publish(
            key, {LEDGER: ledger, **{name: made[name] for name in tables}, **reports}, version=version
        )
    worked = _ledger(publisher, version).filter(F.col("version") == version).select(RUN)
    return Conditioned(version, worked, {name: publisher.read(name, version) for name in reports})


def read_survey_points(publisher: Publisher) -> DataFrame:
    """The published 25 m points of all runs."""
    return survey_points.build_survey_point(read_runs(publisher, "survey_point_local"))


def read_interval_export(publisher: Publisher, section_dim: DataFrame, cfg: Profile = Profile()) -> DataFrame:
    """The interval export of all runs; sections are looked up as they are now."""
    local, pictures, lines = (read_runs(publisher, name) for name in ("survey_point_local", "survey_image", "survey"))
    return export.interval_export(local, pictures, lines, section_dim, cfg)
