"""Reading survey extracts and landed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbed.functions.numbers import half
from roadbed.schema import KEY, LASER, PIC, SECTION_DIM

_LANDED = {"laser": LASER, "key": KEY, "pic": PIC, "section_dim": SECTION_DIM}

#: run id in a path, e.g. 20220214_6
RUN_PATTERN = r"(\d{8}_\d+)"


def run_from_path() -> Column:
    """Run id of the file a row was read from; a path without one is an error."""
    path = F.col("_metadata.file_path")
    run = F.regexp_extract(path, RUN_PATTERN, 1)
    wrong = F.raise_error(F.concat(F.lit("no run id in path "), path)).cast("string")
    return F.when(run != "", run).otherwise(wrong)


def read_landed(
    spark: SparkSession,
    path: str | list[str],
    kind: str,
    fmt: str = "csv",
    header: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Landed table of one or many runs with its declared schema.

    Blank CSV fields are NULL. Padding of fixed-width text is cut once, here. A
    table without its own file_name column takes it from the path.
    """
    schema = _LANDED[kind]
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("mode", mode)
    df = reader.format(fmt).load(path)
    text = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    columns = {c: F.rtrim(F.col(c)) for c in text}
    if kind in ("key", "pic"):
        columns["file_name"] = run_from_path()
    return df.withColumns(columns)


def read_extract(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Raw extract of one or many runs, named by the run in its path."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).withColumn("file_name", run_from_path())


def build_laser(gps: DataFrame, iri: DataFrame, tpl: DataFrame, mpd: DataFrame) -> DataFrame:
    """Merge the four instruments of a run on chainage; position decides the rows."""
    metric = "decimal(8,2)"
    on = ["file_name", "chainage"]
    key = ["file_name", F.col("chainage").cast("double").alias("chainage")]
    named = gps.withColumnsRenamed({"LONGITUDE": "lon", "LATITUDE": "lat"})
    joined = named.select(*key, "lon", "lat")
    for table, names in (
        (iri, {"RWP_IRI": "iri_right", "LWP_IRI": "iri_left", "LANE_IRI": "iri_lane"}),
        (tpl, {"RUT_EDG_SE": "rutt_right", "RUT_CTR_SE": "rutt_left", "RUT_SE": "rutting"}),
        (mpd, {"LANE_MPD": "texture"}),
    ):
        values = [F.col(old).cast(metric).alias(new) for old, new in names.items()]
        joined = joined.join(table.select(*key, *values), on, "left")
    # Texture depth estimated from profile depth, in millimetres.
    slope, offset = "0.8", "0.008"
    etd = F.col("texture") * F.lit(slope).cast("decimal(2,1)") + F.lit(offset).cast("decimal(4,3)")
    mean = half(F.col("iri_right") + F.col("iri_left"))
    complete = joined.withColumns(
        {"iri": mean.cast("decimal(9,3)"), "etd_texture": etd.cast(metric)}
    )
    return complete.select([F.col(f.name).cast(f.dataType) for f in LASER])


# Column names of the raw event extract.
KEY_COLUMNS = {
    "CHAINAGE_START": "event_str",
    "CHAINAGE_END": "event_end",
    "EVENT": "event_num",
    "SWITCH_GROUP": "event_type",
    "EVENT_DESC": "event_name",
    "LATITUDE_START": "lat_str",
    "LATITUDE_END": "lat_end",
    "LONGITUDE_START": "lon_str",
    "LONGITUDE_END": "lon_end",
}


def build_key(raw: DataFrame, names: dict[str, str] = KEY_COLUMNS) -> DataFrame:
    """Event table from a raw extract; ``names`` maps raw to landed columns."""
    renamed = raw.withColumnsRenamed(names)
    columns = [F.col(f.name).cast(f.dataType) for f in KEY]
    return _trimmed(renamed.select(*columns, "file_name"))


def build_pic(
    raw: DataFrame, chainage: str = "CHAINAGE", frame: str = "FRAME"
) -> DataFrame:
    """Picture table from a raw extract."""
    columns = [
        F.col(chainage).cast("double").alias("chainage_pic"),
        F.col(frame).cast("string").alias("frame_number"),
    ]
    return _trimmed(raw.select(*columns, "file_name"))


def _trimmed(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.rtrim(F.col(c)) for c in text})


def read_section_dim(spark: SparkSession, path: str) -> DataFrame:
    """External road sections; route and control come as text or number."""
    raw = spark.read.parquet(path)
    return raw.select([F.col(f.name).cast(f.dataType) for f in SECTION_DIM])
