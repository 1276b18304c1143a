"""Survey-shaped tables derived from ``orders`` and ``customer``.

The texts run unchanged in Spark SQL and in other SQL engines; FIXTURES.md
explains them. A point is an order, an event is a customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbed.functions.numbers import from_cents, half

_RUN = """'202202' || lpad(cast(1 + cast(floor({k}/{a}) as bigint) % 28 as varchar(10)), 2, '0') || '_' ||
         cast(1 + cast(floor({k}/{b}) as bigint) as varchar(10))"""
_POINT_RUN = _RUN.format(k="o_orderkey", a="5e3", b="14e4")
_EVENT_RUN = _RUN.format(k="c_custkey", a="5e2", b="14e3")
# the receiver freezes for a few points in every 200
_SEEN = "(o_orderkey - case when o_orderkey % 200 between 101 and 105 then o_orderkey % 200 - 100 else 0 end)"
_PRICE = "cast(round(o_totalprice*100) as bigint)"

LASER = f"""
select {_POINT_RUN} as file_name,
       (o_orderkey % 5000) * 5 as chainage,
       case when o_orderkey % 60 between 20 and 26 then 0e0 else (100500000 + {_SEEN}*40)/1e6 end as lon,
       case when o_orderkey % 60 between 20 and 26 then 0e0 else (13700000 + {_SEEN} % 7)/1e6 end as lat,
       {_PRICE} % 1000 as iri_right_c,
       ({_PRICE} % 7919) % 1000 as iri_left_c,
       ({_PRICE} % 6151) % 1000 as iri_lane_c,
       ({_PRICE} % 5003) % 400 as rutt_right_c,
       ({_PRICE} % 4001) % 400 as rutt_left_c,
       case when o_orderkey % 41 = 0 then null else ({_PRICE} % 6007) % 400 end as rutting_c,
       case when o_orderkey % 67 = 0 then null else ({_PRICE} % 3001) % 300 end as texture_c
from orders
"""

PIC = f"""
select {_POINT_RUN} as file_name,
       (o_orderkey % 5000) * 5 as chainage_pic,
       cast(case when o_orderkey % 500 = 0 and o_orderkey % 5000 > 0 then o_orderkey % 5000 - 5 else o_orderkey % 5000 end as varchar(10)) as frame_number
from orders
where o_orderkey % 53 <> 1
"""

KEY = f"""
select file_name, event_str, event_end, event_type, 'link ' || cast(k as varchar(10)) as event_name,
       case when k % 97 = 5 then 'construction'
            else '336' || lpad(cast(k % 10000 as varchar(10)), 4, '0') || '0201' || side || cast(g as varchar(10)) || surf || '01' end as link_id,
       cast(k as varchar(10)) as section_id,
       cast(cast(floor(km_a/1e3) as bigint) as varchar(10)) || '+' || lpad(cast(km_a % 1000 as varchar(10)), 3, '0') as km_start,
       cast(cast(floor(km_b/1e3) as bigint) as varchar(10)) || '+' || lpad(cast(km_b % 1000 as varchar(10)), 3, '0') as km_end,
       '0.050' as length,
       case when k % 83 = 7 then null
            else case when g = 1 then '' else substring('-FIUBT', cast(case when k % 29 = 3 then 2 else g end as int), 1) end
                 || side || case when k % 5 = 0 then '' else '2' end end as lane_no,
       survey_date,
       (100500000 + k*400 + (k % 3)*7)/1e6 as lon_str, (13700000 + (k*10) % 7)/1e6 as lat_str,
       (100500000 + (k+1)*400 + (k % 3)*7)/1e6 as lon_end, (13700000 + (k*10+10) % 7)/1e6 as lat_end
from (
  select c_custkey as k,
         {_EVENT_RUN} as file_name,
         '2022-02-' || lpad(cast(1 + cast(floor(c_custkey/5e2) as bigint) % 28 as varchar(10)), 2, '0') || ' ' as survey_date,
         (c_custkey % 500) * 50 + case c_custkey % 8 when 1 then 22 when 5 then -3 else 0 end as event_str,
         (c_custkey % 500) * 50 + 50 + case (c_custkey + 1) % 8 when 1 then 22 when 5 then -3 else 0 end as event_end,
         case when c_mktsegment = 'MACHINERY' then 'other.' else 'pave type. ' end as event_type,
         case when c_custkey % 2 = 0 then 'L' else 'R' end as side,
         1 + c_custkey % 6 as g,
         case when c_nationkey % 2 = 0 then 'CC' else 'AC' end as surf,
         10000 + (c_custkey % 500) * 50 + case when (c_custkey % 2 = 0) = (c_custkey % 37 <> 4) then 0 else 50 end as km_a,
         10000 + (c_custkey % 500) * 50 + case when (c_custkey % 2 = 0) = (c_custkey % 37 <> 4) then 50 else 0 end as km_b
  from customer) c
"""

SECTION_DIM = """
select 'R' || cast(c_custkey as varchar(10)) as road_id, 1 as road_revision, 1 + c_nationkey % 3 as section_revision,
       c_custkey as section_part_id, c_custkey % 10000 as route, cast(201 as bigint) as control
from customer
where c_custkey % 13 <> 0
"""

CORRECTIONS = f"""
select {_POINT_RUN} as file_name,
       (o_orderkey % 5000) * 5 as chainage,
       (100500000 + o_orderkey*40)/1e6 as lon, (13700000 + o_orderkey % 7)/1e6 as lat
from orders
where o_orderkey % 60 = 23
"""


def _view(spark: SparkSession, sf_dir: str, text: str, source: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(text.replace(f"from {source}", "from {source}"), source=table)


def _cents(name: str) -> Column:
    return from_cents(F.col(name))


def raw_laser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point measurements as landed by the instruments, in hundredths."""
    return _view(spark, sf_dir, LASER, "orders")


def extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four instrument tables, each with some chainages missing."""
    rows = raw_laser(spark, sf_dir).withColumn("chainage", F.col("chainage").cast("double"))
    key = ["file_name", "chainage"]
    m = F.col("chainage")
    gps = rows.select(*key, "lon", "lat")
    iri = rows.filter(m % 35 != 0).select(
        *key,
        _cents("iri_right_c").alias("RWP_IRI"),
        _cents("iri_left_c").alias("LWP_IRI"),
        _cents("iri_lane_c").alias("LANE_IRI"),
    )
    tpl = rows.filter(m % 10 == 0).select(
        *key,
        _cents("rutt_right_c").alias("RUT_EDG_SE"),
        _cents("rutt_left_c").alias("RUT_CTR_SE"),
        _cents("rutting_c").alias("RUT_SE"),
    )
    mpd = rows.filter(m % 55 != 0).select(*key, _cents("texture_c").alias("LANE_MPD"))
    return gps, iri, tpl, mpd


def laser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged point table with nothing missing from the merge."""
    rows = raw_laser(spark, sf_dir)
    right, left, depth = _cents("iri_right_c"), _cents("iri_left_c"), _cents("texture_c")
    etd = depth * F.lit("0.8").cast("decimal(2,1)") + F.lit("0.008").cast("decimal(4,3)")
    return rows.select(
        "file_name",
        F.col("chainage").cast("double").alias("chainage"),
        "lon",
        "lat",
        right.alias("iri_right"),
        left.alias("iri_left"),
        half(right + left).cast("decimal(9,3)").alias("iri"),
        _cents("iri_lane_c").alias("iri_lane"),
        _cents("rutt_right_c").alias("rutt_right"),
        _cents("rutt_left_c").alias("rutt_left"),
        _cents("rutting_c").alias("rutting"),
        depth.alias("texture"),
        etd.cast("decimal(8,2)").alias("etd_texture"),
    )


def key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view(spark, sf_dir, KEY, "customer")
    ends = {c: F.col(c).cast("double") for c in ("event_str", "event_end")}
    number = F.right(F.col("section_id"), F.lit(2))
    return rows.withColumns({**ends, "event_num": number})


def pic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _view(spark, sf_dir, PIC, "orders")
    return rows.withColumn("chainage_pic", F.col("chainage_pic").cast("double"))


def section_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SECTION_DIM, "customer")


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by run and chainage; link ids are added by the caller."""
    rows = _view(spark, sf_dir, CORRECTIONS, "orders")
    return rows.withColumn("chainage", F.col("chainage").cast("double"))
