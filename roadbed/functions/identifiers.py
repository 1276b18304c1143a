"""What a link id says about its road, lane and surface."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lane_group(link: Column) -> Column:
    """1..6 for L1..L6, -1..-6 for R1..R6, else 0."""
    side = F.substring(F.right(link, F.lit(6)), 1, 1)
    digit = F.substring(F.right(link, F.lit(6)), 2, 1)
    return (
        F.when(side.isin("L", "R") & digit.isin(*"123456"),
               F.when(side == "L", digit.try_cast("int")).otherwise(-digit.try_cast("int")))
        .otherwise(0)
    )


def surface(link: Column) -> Column:
    return F.left(F.right(link, F.lit(4)), F.lit(2))


def survey_type(link: Column) -> Column:
    """1 concrete, 2 asphalt."""
    return F.when(surface(link) == "CC", 1).when(surface(link) == "AC", 2)


def survey_code(link: Column) -> Column:
    return F.concat(surface(link), F.left(link, F.lit(11)))


def run_code(link: Column) -> Column:
    return F.right(link, F.lit(2)).try_cast("int").cast("string")


def district(link: Column) -> Column:
    return F.left(link, F.lit(3))


def route(link: Column) -> Column:
    return F.substring(link, 4, 4)


def control(link: Column) -> Column:
    return F.substring(link, 8, 4)


def lane_number(lane_no: Column) -> Column:
    """Last digit of the lane name; names ending in L or R mean lane 2."""
    last = F.right(lane_no, F.lit(1))
    return F.when(last.isin("L", "R"), 2).otherwise(last.try_cast("int"))


def decode_link(df: DataFrame, link: str = "link_id") -> DataFrame:
    col = F.col(link)
    return df.withColumns(
        {
            "district": district(col),
            "route": route(col).try_cast("int"),
            "control": control(col).try_cast("int"),
            "road_code": F.left(col, F.lit(11)),
            "lane_group": lane_group(col),
            "survey_type": survey_type(col),
            "survey_code": survey_code(col),
            "run_code": run_code(col),
        }
    )
