"""Pictures of the 25 m points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.functions.identifiers import district
from roadbed.functions.numbers import bround_int, ceil_to, pad_frame
from roadbed.operators.ordering import OrderedGroups
from roadbed.schema import Profile

LINK = ["file_name", "date", "link_id"]


def build_survey_image(
    local: DataFrame, points: DataFrame, cfg: Profile = Profile()
) -> DataFrame:
    """One row per 25 m point and picture at (or just past) its chainage."""
    frames = (
        points.filter(F.col("chainage_pic").isNotNull())
        .select(*LINK, bround_int(F.col("chainage_pic")).alias("at"), "frame_number")
        .distinct()
    )
    placed = local.withColumn("at", ceil_to(F.col("chainage"), 5)).join(
        frames, [*LINK, "at"], "left"
    )
    filename = F.concat(
        F.col("file_name"), F.lit("-ROW-0-"), pad_frame(F.col("frame_number")), F.lit(".jpg")
    )
    directory = F.concat(
        F.lit(cfg.path_root.rstrip("/") + "/"),
        district(F.col("link_id")),
        F.lit("/"),
        F.col("date").cast("string"),
        F.lit("/"),
        F.col("survey_code"),
        F.lit("/Run"),
        F.col("run_code"),
        F.lit("/image/"),
        F.col("filename"),
    )
    return (
        placed.withColumn("filename", filename)
        .select(
            directory.alias("directory"),
            "filename",
            "date",
            F.col("chainage").alias("img_id"),
            "km",
            F.lit("True").alias("imagepath"),
            "lon",
            "lat",
            "survey_id",
            F.lit(cfg.image_remark).alias("remark"),
            "file_name",
            "link_id",
            "survey_point_id",
        )
        .distinct()
    )


def dedupe_images(images: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Give a repeated picture another name.

    Where the same file is used again less than 25 m on, the last digit of its
    number becomes 3 for 0 and 7 for 5, in file and folder name, for every row
    of that run and link at that place. Other digits, repeats further apart and
    missing names stay. The search looks at names used more than once only.
    """
    named = images.filter(F.col("filename").isNotNull())
    repeated = named.groupBy("filename").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    uses = named.join(repeated.select("filename"), "filename", "left_semi").select(
        "filename", *LINK, "img_id", "survey_point_id"
    )
    followed = (
        OrderedGroups(uses, ["filename"], ["img_id", *LINK, "survey_point_id"], max_rows)
        .frames({"before": lambda w: F.lag("img_id").over(w)}, before=1, after=0)
        .to_df()
    )
    on = ["filename", "img_id"]
    close = followed.filter(F.col("img_id") - F.col("before") < 25).select(*on).distinct()
    marked = images.join(close.withColumn("again", F.lit(True)), on, "left")

    def renamed(name: str) -> Column:
        old = F.col(name)
        new = F.regexp_replace(F.regexp_replace(old, r"0\.jpg$", "3.jpg"), r"5\.jpg$", "7.jpg")
        return F.when(F.col("again"), new).otherwise(old)

    changed = {name: renamed(name) for name in ("filename", "directory")}
    return marked.withColumns(changed).select(*images.columns)


def _folder() -> Column:
    return F.regexp_replace("directory", r"/[^/]*$", "")


def _windows(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("\\"))


def image_dirs(images: DataFrame, root: str = "E:\\images\\") -> DataFrame:
    """Folders the pictures are copied to, each once."""
    folder = F.concat(F.lit(root), _windows(_folder()))
    dirs = images.filter(F.col("directory").isNotNull()).select(folder.alias("folder")).distinct()
    return dirs.select("folder", F.concat(F.lit("mkdir "), F.col("folder")).alias("line"))


def image_copy_manifest(
    images: DataFrame,
    src_root: str = "E:\\",
    dst_root: str = "E:\\images\\",
    run: str | None = None,
) -> DataFrame:
    """Source and target of every picture: <src_root><day>\\<day>_<run>\\ROW-0\\<file>.

    The run is the one the file is named after; ``run`` puts another in its place.
    """
    name = F.col("filename")
    day = F.left(name, F.lit(8))
    run_folder = F.regexp_extract(name, r"^\d{8}_\d+", 0)
    if run is not None:
        run_folder = F.concat(day, F.lit(f"_{run}"))
    src = F.concat(F.lit(src_root), day, F.lit("\\"), run_folder, F.lit("\\ROW-0\\"), name)
    dst = F.concat(F.lit(dst_root), _windows(_folder()), F.lit("\\"), name)
    manifest = images.filter(name.isNotNull() & F.col("directory").isNotNull())
    manifest = manifest.select(src.alias("src"), dst.alias("dst"))
    return manifest.withColumn(
        "line", F.concat(F.lit("copy "), F.col("src"), F.lit(" "), F.col("dst"))
    )
