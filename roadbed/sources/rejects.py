"""Landing CSV lines of any quality: good rows typed, bad ones told apart.

``read_landed`` stops at the first bad field. Here every line is kept: it is split once
into text fields, each field is cast on its own, and what does not fit is named by
line, column and rule. Both results come from one written pass over the lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbed.schema import KEY, LASER, PIC, SECTION_DIM
from roadbed.session import stage
from roadbed.sources.landing import run_from_path

_SCHEMAS = {"laser": LASER, "key": KEY, "pic": PIC, "section_dim": SECTION_DIM}
#: fields a row cannot do without
_KEYS = {
    "laser": ("chainage", "file_name"),
    "key": ("event_str", "event_end", "link_id"),
    "pic": ("chainage_pic",),
    "section_dim": ("section_part_id",),
}
#: text fields that hold a day
_DATES = {"key": {"survey_date": "yyyy-MM-dd"}}

_LINE, _FIELDS, _N = "__line", "__fields", "__n"


@dataclass(frozen=True)
class Landed:
    """Rows that fit the declared schema, and what is wrong with the others.

    ``rejects`` has (file_path, line, column, rule): a row for each fault. Rules are
    ``too_few_fields``, ``too_many_fields`` and ``open_quote`` (column NULL, the
    fields are not looked at), ``bad_number``, ``bad_date`` and ``missing``.
    """

    good: DataFrame
    rejects: DataFrame


def _n_fields(line: Column) -> Column:
    """Commas outside quotes, and one."""
    bare = _bare(line)
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _bare(line: Column) -> Column:
    """A line without its quoted fields."""
    return F.regexp_replace(line, '"(?:[^"]|"")*"', "")


def _typed(field: T.StructField) -> Column:
    value = F.col(f"{_FIELDS}.{field.name}")
    return F.rtrim(value) if isinstance(field.dataType, T.StringType) else value.try_cast(field.dataType)


def _faults(kind: str) -> Column:
    """Array of (column, rule) of one line."""
    schema = _SCHEMAS[kind]

    def fault(column: str | None, rule: str) -> Column:
        return F.struct(F.lit(column).cast("string").alias("column"), F.lit(rule).alias("rule"))

    none = F.lit(None).cast("struct<column:string,rule:string>")
    found = []
    for field in schema:
        text, value = F.col(f"{_FIELDS}.{field.name}"), _typed(field)
        if not isinstance(field.dataType, T.StringType):
            found.append(F.when(text.isNotNull() & value.isNull(), fault(field.name, "bad_number")))
        if form := _DATES.get(kind, {}).get(field.name):
            day = F.try_to_date(F.trim(text), form)
            found.append(F.when((F.trim(text) != "") & day.isNull(), fault(field.name, "bad_date")))
        if field.name in _KEYS[kind]:
            found.append(F.when(F.coalesce(F.trim(text), F.lit("")) == "", fault(field.name, "missing")))
    in_fields = F.array_compact(F.array(*found, none))
    return (
        F.when(F.contains(_bare(F.col(_LINE)), F.lit('"')), F.array(fault(None, "open_quote")))
        .when(F.col(_N) < len(schema), F.array(fault(None, "too_few_fields")))
        .when(F.col(_N) > len(schema), F.array(fault(None, "too_many_fields")))
        .otherwise(in_fields)
    )


def read_with_rejects(spark: SparkSession, path: str | list[str], kind: str) -> Landed:
    """Landed table of header-less CSV files, and its rejected lines.

    On clean files the good rows are those of ``read_landed``. Blank fields are NULL;
    empty lines are no rows; a field does not go over several lines. Numbers
    may have blanks around them. Files without lines give two empty tables.
    """
    schema = _SCHEMAS[kind]
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    # the parser would take a missing field for a blank one, so fields are counted first
    parsed = lines.select(
        F.col("value").alias(_LINE),
        F.col("_metadata.file_path").alias("file_path"),
        _n_fields(F.col("value")).alias(_N),
        F.from_csv("value", texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"mode": "PERMISSIVE", "escape": "\""}).alias(_FIELDS),
        *([run_from_path().alias("file_name")] if kind in ("key", "pic") else []),
    )
    columns = [_typed(f).alias(f.name) for f in schema]
    run = ["file_name"] if kind in ("key", "pic") else []
    judged = stage(parsed.select(*columns, *run, "file_path", _LINE, _faults(kind).alias("__faults")), "judged-lines")
    bad = judged.filter(F.size("__faults") > 0)
    rejects = bad.select("file_path", F.col(_LINE).alias("line"), F.inline("__faults"))
    good = judged.filter(F.size("__faults") == 0).select(*schema.fieldNames(), *run)
    return Landed(good, rejects)
