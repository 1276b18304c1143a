"""Plain SQL for the registered queries, over the same tables.

Every text is assembled from named pieces (CTEs), so that a query and the ones
it builds on are stated once. Values are hundredths, thousandths and 1e-9
degrees as whole numbers; see FIXTURES.md.
"""

from __future__ import annotations

from roadbed.sources import sample_views as views

_LINK = ["file_name", "date", "link_id"]
_GAP = [*_LINK, "gap_start", "gap_end", "c_p"]
_METRICS = [
    "iri_right", "iri_left", "iri", "iri_lane",
    "rutt_right", "rutt_left", "rutting", "texture", "etd_texture",
]
_LINE = [
    "event_name", "link_id", "section_id", "km_start", "km_end",
    "length", "lane_no", "date", "file_name",
]
_EPS = "0.00004e0"


def _c(columns, alias=""):
    prefix = f"{alias}." if alias else ""
    return ", ".join(prefix + c for c in columns)


def _on(columns, a, b):
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in columns)


def _on_null(columns, a, b):
    return " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in columns)


def deg(column, name=None):
    return f"cast(round({column}*1e9) as bigint) as {name or column.split('.')[-1]}"


class Sql:
    """CTEs in the order they were added."""

    def __init__(self):
        self.parts: dict[str, str] = {}

    def add(self, name, text):
        self.parts.setdefault(name, text)
        return self

    def select(self, text):
        head = ",\n".join(f"{name} as ({body})" for name, body in self.parts.items())
        return f"with {head}\n{text}" if head else text


LOST = "(lon = 0 or lat = 0)"


def inputs(q: Sql) -> Sql:
    q.add("laser_v", views.LASER).add("key_v", views.KEY).add("pic_v", views.PIC)
    q.add(
        "laser",
        """select file_name, chainage, lon, lat, iri_right_c as iri_right, iri_left_c as iri_left,
             (iri_right_c + iri_left_c)*5 as iri, iri_lane_c as iri_lane, rutt_right_c as rutt_right,
             rutt_left_c as rutt_left, rutting_c as rutting, texture_c as texture,
             (8*texture_c + 13)//10 as etd_texture from laser_v""",
    )
    q.add(
        "ev",
        """select *, right(section_id, 2) as event_num, cast(trim(survey_date) as date) as date
           from key_v where replace(event_type, ' ', '') = 'pavetype.'""",
    )
    return q


def rutting_between(q: Sql) -> Sql:
    """Measured points whose rutting between 10 m values is their mean."""
    inputs(q)
    rut = ["rutt_right", "rutt_left", "rutting"]
    landed = q.parts.pop("laser")
    q.add("landed", landed)
    q.add(
        "tens",
        f"select file_name, chainage + 5 as spot, {', '.join(f'({c} + lag({c}) over w + 1)//2 as {c}' for c in rut)} "
        "from landed where chainage % 10 = 0 window w as (partition by file_name order by chainage)",
    )
    return q.add(
        "laser",
        f"""select l.* replace ({', '.join(f'case when t.spot is null then l.{c} else t.{c} end as {c}' for c in rut)})
            from landed l left join tens t on t.file_name = l.file_name and t.spot = l.chainage""",
    )


def in_events(q: Sql) -> Sql:
    inputs(q)
    q.add(
        "capped",
        """select file_name, chainage, lon, lat, iri_right as iri_right_raw, iri_left as iri_left_raw,
             least(iri_right, 800) as iri_right, least(iri_left, 800) as iri_left, iri as iri_old,
             (least(iri_right, 800) + least(iri_left, 800))*5 as iri,
             iri_lane, rutt_right, rutt_left, rutting, texture, etd_texture from laser""",
    )
    q.add(
        "pts0",
        """select e.*, l.* exclude (file_name), p.chainage_pic, p.frame_number,
             cast(replace(km_start, '+', '') as bigint) + l.chainage - event_str as km2
           from ev e join capped l on l.file_name = e.file_name
             and l.chainage between e.event_str and e.event_end
           left join pic_v p on p.file_name = l.file_name and p.chainage_pic = l.chainage""",
    )
    return q


def status(q: Sql) -> Sql:
    inputs(q)
    q.add(
        "counts",
        f"""select e.file_name, e.date, e.link_id, count(*) filter (where {LOST}) as n_lost,
              count(*) filter (where lon <> 0 or lat <> 0) as n_fix
            from ev e join laser l on l.file_name = e.file_name and l.chainage % 25 = 0
              and l.chainage between e.event_str - 5 and e.event_end + 5
            group by all""",
    )
    q.add(
        "status",
        """select file_name, date, link_id, case when n_lost > 0 then n_lost else n_fix end as count,
             case when n_lost > 0 then 'lost' else 'ok' end as status,
             case when n_lost > 1 then 'stop' else 'continue' end as status_type
           from counts where n_lost > 0 or n_fix > 0""",
    )
    return q


def points(q: Sql) -> Sql:
    status(in_events(q))
    return q.add(
        "pts",
        f"select p.*, s.status, s.status_type, false as gps_imputed from pts0 p join status s on {_on(_LINK, 'p', 's')}",
    )


def islands(q: Sql, pts="pts") -> Sql:
    q.add(
        "marked",
        f"""select *, {LOST} as lost, lag({LOST}) over w as was_lost, lag(chainage) over w as c0
            from {pts} window w as (partition by {_c(_LINK)} order by chainage, event_str, lon, lat)""",
    )
    q.add(
        "opened",
        f"""select *, sum(case when lost and not coalesce(was_lost and chainage - c0 <= 5, false)
              then 1 else 0 end) over (partition by {_c(_LINK)} order by chainage, event_str, lon, lat
              rows unbounded preceding) as island from marked""",
    )
    return q.add(
        "islands",
        f"""select {_c(_LINK)}, min(chainage) as gap_start, max(chainage) as gap_end,
              count(*) as c_p, count(*)*5 as meter from opened where lost group by {_c(_LINK)}, island""",
    )


def all_gaps(q: Sql, pts="pts") -> Sql:
    """Every lost point of a gap, of the same link."""
    islands(q, pts)
    return q.add(
        "gaps",
        f"""select distinct i.*, p.chainage, gap_start - 6 as new_p_min, gap_end + 6 as new_p_max
            from islands i join {pts} p on {_on(_LINK, 'p', 'i')} and p.chainage between gap_start and gap_end
            where {LOST} and status = 'lost'""",
    )


def gaps(q: Sql, pts="pts") -> Sql:
    islands(q, pts)
    return q.add(
        "gaps",
        f"""select distinct i.*, p.chainage, gap_start - 6 as new_p_min, gap_end + 6 as new_p_max
            from islands i join {pts} p on p.file_name = i.file_name and p.chainage between gap_start and gap_end
            where p.chainage % 25 = 0 and {LOST} and status = 'lost'""",
    )


def gap_vertices(q: Sql, pts="pts") -> Sql:
    q.add(
        "gap_vertices",
        f"""select distinct {_c(_GAP, 'g')}, p.chainage as m, p.lon, p.lat from gaps g join {pts} p
            on p.file_name = g.file_name and p.chainage between new_p_min and new_p_max
            where lon <> 0 and lat > 0 and status = 'lost'""",
    )
    return q.add(
        "gap_spans",
        f"select {_c(_GAP)}, min(m) as chainage_str, max(m) as chainage_end from gap_vertices group by all",
    )


def place(q: Sql, name, by, targets, vertices) -> Sql:
    """Position at ``fraction`` of the planar length of the target's line."""
    order = f"partition by {_c(by)} order by m, lon, lat"
    q.add(
        f"{name}_seg",
        f"select *, lead(lon) over w as lon2, lead(lat) over w as lat2 from {vertices} window w as ({order})",
    )
    q.add(
        f"{name}_len",
        f"""select *, coalesce(sqrt((lon2-lon)*(lon2-lon) + (lat2-lat)*(lat2-lat)), 0e0) as len from {name}_seg""",
    )
    q.add(
        f"{name}_run",
        f"select *, sum(len) over ({order} rows unbounded preceding) as run_end from {name}_len",
    )
    q.add(f"{name}_total", f"select {_c(by)}, max(run_end) as total from {name}_run group by all")
    # the last segment that starts at or before the aim, whatever its end
    q.add(f"{name}_start", f"select *, run_end - len as run_start, row_number() over ({order}) as seg_no from {name}_run")
    return q.add(
        name,
        f"""select t.* exclude (tid),
              s.lon + case when len > 0 then least(1e0, (fraction*total - run_start)/len) else 0e0 end * (coalesce(lon2, lon) - lon) as new_lon,
              s.lat + case when len > 0 then least(1e0, (fraction*total - run_start)/len) else 0e0 end * (coalesce(lat2, lat) - lat) as new_lat
            from (select *, row_number() over () as tid from {targets}) t
            join {name}_total x on {_on_null(by, 't', 'x')} join {name}_start s on {_on_null(by, 't', 's')}
            where fraction between 0 and 1 and fraction*total >= run_start
            qualify row_number() over (partition by tid order by seg_no desc) = 1""",
    )


def repaired(q: Sql, pts="pts") -> Sql:
    gap_vertices(gaps(q, pts), pts)
    q.add(
        "gap_targets",
        f"""select {_c(_GAP, 'g')}, chainage, cast(chainage - chainage_str as double)/(chainage_end - chainage_str) as fraction
            from gaps g join gap_spans s on {_on(_GAP, 'g', 's')} where chainage_end > chainage_str""",
    )
    place(q, "gap_placed", _GAP, "gap_targets", "gap_vertices")
    return q.add(
        "repaired",
        f"""select p.* exclude (lon, lat, gps_imputed), coalesce(r.new_lon, p.lon) as lon,
              coalesce(r.new_lat, p.lat) as lat, r.new_lon is not null as gps_imputed
            from {pts} p left join (select {_c(_LINK)}, chainage, min(new_lon) as new_lon, min(new_lat) as new_lat
              from gap_placed group by all) r on {_on([*_LINK, 'chainage'], 'p', 'r')}""",
    )


def endpoints(q: Sql, pts="pts") -> Sql:
    rest = [c for c in _LINE]
    return q.add(
        "ends",
        f"""select {_c(rest)}, event_str as chainage, lon_str as lon, lat_str as lat, 'str' as direction from {pts}
            union select {_c(rest)}, event_end, lon_end, lat_end, 'end' from {pts}""",
    )


def near(q: Sql, pts="pts") -> Sql:
    endpoints(q, pts)
    q.add(
        "measured",
        """select distinct l.file_name, l.chainage, l.lon, l.lat from ev e join laser l
           on l.file_name = e.file_name and l.chainage between event_str - 5 and event_end + 5
           where replace(link_id, ' ', '') <> ''""",
    )
    return q.add(
        "close",
        f"""select e.*, m.chainage as point_chainage from ends e join measured m on m.file_name = e.file_name
            and (e.lon-m.lon)*(e.lon-m.lon) + (e.lat-m.lat)*(e.lat-m.lat) <= {_EPS}*{_EPS}""",
    )


def snapped(q: Sql, pts="pts") -> Sql:
    near(q, pts)
    q.add("snap_at", "select distinct file_name, chainage as spot from close where point_chainage <> chainage")
    q.add(
        "snap_vertices",
        """select distinct a.file_name, a.spot, l.chainage as m, l.lon, l.lat from snap_at a join laser l
           on l.file_name = a.file_name and l.chainage between spot - 5 and spot + 5 where lon <> 0 and lat <> 0""",
    )
    q.add(
        "snap_targets",
        """select file_name, spot, (spot - min(m))/case when max(m) = min(m) then 0.0001e0
             else cast(max(m) - min(m) as double) end as fraction from snap_vertices group by file_name, spot""",
    )
    place(q, "snap", ["file_name", "spot"], "snap_targets", "snap_vertices")
    return q.add(
        "snapped",
        f"""select p.* exclude (lon_str, lat_str, lon_end, lat_end),
              coalesce(a.new_lon, lon_str) as lon_str, coalesce(a.new_lat, lat_str) as lat_str,
              coalesce(b.new_lon, lon_end) as lon_end, coalesce(b.new_lat, lat_end) as lat_end
            from {pts} p left join snap a on a.file_name = p.file_name and a.spot = p.event_str
            left join snap b on b.file_name = p.file_name and b.spot = p.event_end""",
    )


def smoothed(q: Sql, pts="pts", run="file_name") -> Sql:
    sums = ["iri_right", "iri_left", "iri_lane", "rutt_right", "rutt_left", "texture", "etd_texture"]
    frame = f"(partition by {run} order by chainage, event_str, link_id rows between 4 preceding and 4 following)"
    q.add(
        "sums",
        f"select *, {', '.join(f'case when {c} is not null then cast(sum({c}) over w as bigint) end as s_{c}' for c in sums)} "
        f"from {pts} window w as {frame}",
    )
    means = ", ".join(f"(2*s_{c} + 9)//18 as {c}" for c in sums)
    return q.add(
        "smoothed",
        f"""select * exclude ({_c([f's_{c}' for c in sums])}) replace ({means},
              ((s_iri_right + s_iri_left)*2 + 18)//36*10 as iri,
              ((s_rutt_right + s_rutt_left)*2 + 18)//36 as rutting) from sums""",
    )


_A, _E2 = "6378137e0", "0.0066943799901413165e0"


def survey(q: Sql, pts="pts") -> Sql:
    rest = _c(_LINE)
    q.add(
        "vertices",
        f"""select * from (
              select {rest}, event_str as chainage, lon_str as lon, lat_str as lat from {pts}
              union select {rest}, event_end, lon_end, lat_end from {pts}
              union select {rest}, chainage, lon, lat from {pts}
                where chainage between event_str and event_end and chainage % 25 = 0 and (lon > 0 or lat > 0))
            where link_id <> 'construction' and cast(replace(length, ' ', '') as double) > 0""",
    )
    q.add(
        "steps",
        f"""select *, lag(lon) over w as lon0, lag(lat) over w as lat0, row_number() over w as vertex_no
            from vertices window w as (partition by {rest} order by chainage, lon, lat)""",
    )
    q.add(
        "metres",
        f"""select *, sqrt(pow({_A}*(1-{_E2})/(w*sqrt(w))*radians(lat-lat0), 2)
              + pow({_A}/sqrt(w)*cos(mid)*radians(lon-lon0), 2)) as len
            from (select *, 1e0 - {_E2}*sin(mid)*sin(mid) as w
              from (select *, radians((lat0+lat)/2) as mid from steps))""",
    )
    side = "substr(right(link_id, 6), 1, 1)"
    group = (
        f"case when right(left(right(link_id, 6), 2), 1) between '1' and '6' and {side} in ('L', 'R') "
        f"then case when {side} = 'L' then 1 else -1 end * cast(substr(right(link_id, 6), 2, 1) as bigint) else 0 end"
    )
    q.add("lane_groups", f"select distinct link_id, {group} as lane_group from key_v where link_id <> 'construction'")
    return q.add(
        "survey",
        f"""select row_number() over (order by chainage_str, link_id, file_name, event_name, section_id, km_start, km_end) as survey_id, *
            from (select cast(null as bigint) as subsection_id, cast(section_id as bigint) as section_id, v.link_id,
              left(right(v.link_id, 4), 2) || left(v.link_id, 11) as survey_code,
              cast(cast(right(v.link_id, 2) as int) as varchar) as run_code, g.lane_group,
              case when right(lane_no, 1) in ('L', 'R') then 2 else cast(right(lane_no, 1) as bigint) end as lane_no,
              cast(null as bigint) as lane_reverse,
              cast(replace(km_start, '+', '') as bigint) as km_start, cast(replace(km_end, '+', '') as bigint) as km_end,
              cast(replace(km_end, '+', '') as bigint) - cast(replace(km_start, '+', '') as bigint) as rise,
              cast(round(coalesce(sum(len), 0)) as bigint) as distance_odo,
              cast(round(coalesce(sum(len), 0)) as bigint) as distance_gps,
              cast(year(date) as bigint) as year,
              cast(case left(right(v.link_id, 4), 2) when 'CC' then 1 when 'AC' then 2 end as bigint) as survey_type,
              date, 'road_survey' as remark, 'run' as run_new, cast(25 as bigint) as "interval", event_name, file_name,
              min(chainage) as chainage_str, cast(1 as bigint) as line_parts
            from metres v join lane_groups g on g.link_id = v.link_id
            group by event_name, v.link_id, section_id, v.km_start, v.km_end, length, v.lane_no, date, file_name, g.lane_group)""",
    )


def _avg(c):
    """Mean in hundredths, half away from zero (values are not negative)."""
    return f"cast((2*sum({c}) + count({c}))//(2*count({c})) as bigint) as {c}"


_AVG = ", ".join(
    "cast((2*sum(iri) + 10*count(iri))//(20*count(iri)) as bigint) as iri" if c == "iri" else _avg(c)
    for c in _METRICS
)


def point_local(q: Sql, pts="pts", laser="laser") -> Sql:
    """25 m points; iri leaves here in hundredths, like the other values."""
    survey(q, pts)
    q.add(
        "lent",
        f"""select {_c(_LINK)}, spot as chainage, {_AVG} from (
              select *, case when chainage - event_str < 5 then event_str when chainage - event_end < 5 then event_end end as spot
              from {pts} where event_str between chainage - 6 and chainage + 6 or event_end between chainage - 4 and chainage + 4)
            where spot <> chainage group by {_c(_LINK)}, spot""",
    )
    q.add(
        "start_rows",
        f"""select {_c([*_LINK, 'chainage'], 's')}, s.lon, s.lat, {_c(_METRICS)} from (
              select distinct {_c(_LINK)}, event_str as chainage, lon_str as lon, lat_str as lat from {pts}
              where event_str <> chainage) s
            join lent l on {_on([*_LINK, 'chainage'], 's', 'l')}""",
    )
    inside = "chainage between event_str and event_end"
    q.add(
        "values_at",
        f"""select file_name, chainage, {_c(_METRICS)} from {pts} where {inside}
            union select l.file_name, l.chainage, {_c(_METRICS, 'l')} from {laser} l join {pts} p
              on p.file_name = l.file_name and l.chainage = p.chainage + 5 where l.chainage > p.event_end""",
    )
    q.add("means", f"select file_name, chainage, {_AVG} from values_at group by file_name, chainage")
    q.add(
        "grid_rows",
        f"""select {_c([*_LINK, 'chainage'], 'a')}, b.lon, b.lat, {_c(_METRICS, 'm')}, bool_or(b.gps_imputed) as gps_imputed
            from {pts} a join {pts} b on {_on([*_LINK, 'chainage'], 'a', 'b')}
            join means m on m.file_name = a.file_name and m.chainage = a.chainage
            where a.chainage between a.event_str and a.event_end and a.chainage % 25 = 0 group by all""",
    )
    q.add(
        "rows25",
        f"""select r.*, s.survey_id, s.survey_code, s.run_code, s.lane_group, s.km_start as km0
            from (select * exclude (gps_imputed), bool_or(gps_imputed) as gps_imputed
                  from (select *, false as gps_imputed from start_rows union all select * from grid_rows) group by all) r
            left join survey s on {_on(_LINK, 'r', 's')} where r.link_id <> 'construction'""",
    )
    order = f"order by chainage, lon, lat, {', '.join(f'{c} nulls last' for c in _METRICS)}"
    q.add(
        "counted",
        f"""select *, row_number() over (partition by {_c(_LINK)} {order}, survey_id nulls last) - 1 as order_row,
              row_number() over (partition by {_c(_LINK)}, survey_id {order}) - 1 as n_survey from rows25""",
    )
    three = ("iri_right", "iri_left", "iri")
    caps = ", ".join(f"least({c}, 800) as {c}" for c in three)
    marks = ", ".join(f"{c} as {c}_raw, coalesce({c} > 800, false) as {c}_imputed" for c in three)
    return q.add(
        "local",
        f"""select row_number() over (order by km nulls last, file_name, date, link_id, survey_id nulls last, order_row) as survey_point_id, *
            from (select order_row, case when lane_group > 0 then km0 + 25*n_survey when lane_group < 0 then km0 - 25*n_survey end as km,
              chainage, link_id, date, lon, lat, file_name, {caps}, {_c(_METRICS[3:])}, survey_id, survey_code, run_code,
              {marks}, gps_imputed from counted)""",
    )


def images(q: Sql, pts="pts") -> Sql:
    return q.add(
        "images",
        f"""select distinct 'survey/images/' || left(a.link_id, 3) || '/' || cast(a.date as varchar) || '/' || survey_code
              || '/Run' || run_code || '/image/' || a.file_name || '-ROW-0-' || lpad(frame_number, cast(greatest(5, length(frame_number)) as int), '0') || '.jpg' as directory,
              a.file_name || '-ROW-0-' || lpad(frame_number, cast(greatest(5, length(frame_number)) as int), '0') || '.jpg' as filename,
              a.date, a.chainage as img_id, km, 'True' as imagepath, a.lon, a.lat, survey_id, 'road_images' as remark,
              a.file_name, a.link_id, survey_point_id
            from local a left join (select distinct {_c(_LINK)}, chainage_pic, frame_number from {pts}) b
              on {_on(_LINK, 'a', 'b')} and chainage_pic = (a.chainage + 4)//5*5""",
    )


def renamed(q: Sql) -> Sql:
    q.add("dup_names", "select filename from images group by filename having count(*) > 1")
    q.add(
        "followed",
        """select filename, img_id, lag(img_id) over (partition by filename order by img_id, file_name, date, link_id, survey_point_id) as before
           from images join dup_names using (filename)""",
    )
    q.add("again", "select distinct filename, img_id from followed where img_id - before < 25")

    def swap(c):
        return (
            f"case when a.filename is null then i.{c} when right(i.{c}, 5) = '0.jpg' then left(i.{c}, length(i.{c}) - 5) || '3.jpg' "
            f"when right(i.{c}, 5) = '5.jpg' then left(i.{c}, length(i.{c}) - 5) || '7.jpg' else i.{c} end as {c}"
        )

    return q.add(
        "renamed",
        f"""select i.* replace ({swap('filename')}, {swap('directory')}) from images i
            left join again a on a.filename = i.filename and a.img_id = i.img_id""",
    )


def intervals(q: Sql) -> Sql:
    q.add(
        "interval_rows",
        """select l.*, s.section_id, s.lane_group, s.km_start, substr(s.link_id, 4, 4) as route, substr(s.link_id, 8, 4) as control
           from local l left join survey s on s.survey_id = l.survey_id""",
    )
    q.add(
        "interval_len",
        """select *, coalesce(lead(chainage) over (partition by survey_id order by chainage, survey_point_id) - chainage, 25) as iv
           from interval_rows""",
    )
    return q.add(
        "interval_sum",
        "select *, cast(sum(iv) over (partition by survey_id order by chainage) as bigint) as km_sum from interval_len",
    )


def exported(q: Sql, pictures="images") -> Sql:
    intervals(q)
    q.add("section_dim", views.SECTION_DIM)
    return q.add(
        "exported",
        f"""select road_id, cast(road_revision as bigint) as road_revision, 'null' as section_id,
              cast(section_revision as bigint) as section_revision, section_part_id, d.route as road_code, d.control as section_code,
              case when lane_group < 0 then km_end + iv when lane_group > 0 then km_end - iv end as km_start, km_end,
              iri, rut, mpd, image_url, lon, lat
            from (select r.*, r.rutting as rut, r.texture as mpd, i.directory as image_url,
                case when lane_group < 0 then km_start - km_sum when lane_group > 0 then km_start + km_sum end as km_end
              from interval_sum r left join {pictures} i on i.survey_id = r.survey_id and i.img_id = r.chainage) a
            left join section_dim d on d.route = cast(a.route as bigint) and d.control = cast(a.control as bigint)
              and d.section_part_id = a.section_id""",
    )


_POINT_COLUMNS = [
    *_LINK, "event_str", "event_end", "event_num", "event_type", "event_name", "section_id",
    "km_start", "km_end", "length", "lane_no", "survey_date", "chainage", "km2", "iri_old",
    *_METRICS, "chainage_pic", "frame_number",
]


def _points_out(columns, relation):
    named = ["cast(date as varchar) as date" if c == "date" else c for c in columns]
    return f"select {_c(named)}, {deg('lon')}, {deg('lat')} from {relation}"


def _local_out(relation="local", columns=None):
    columns = columns or [
        "survey_point_id", "order_row", "km", "chainage", "link_id", "date", "file_name",
        *_METRICS, "survey_id", "survey_code", "run_code", "gps_imputed",
        *[f"{c}_{s}" for c in ("iri_right", "iri_left", "iri") for s in ("raw", "imputed")],
    ]
    return _points_out(columns, relation)


_SURVEY_COLUMNS = [
    "survey_id", "subsection_id", "section_id", "link_id", "survey_code", "run_code", "lane_group",
    "lane_no", "lane_reverse", "km_start", "km_end",
]
_SURVEY_OUT = f"""select {_c(_SURVEY_COLUMNS)},
  case when substr(right(link_id, 6), 1, 1) = 'L' then rise when substr(right(link_id, 6), 1, 1) = 'R' then -rise end as length,
  distance_odo, distance_gps, year, survey_type, cast(date as varchar) as date, remark, run_new, "interval",
  event_name, file_name, line_parts from survey"""


def _images_out(relation):
    return f"""select directory, filename, cast(date as varchar) as date, img_id, km, imagepath, {deg('lon')}, {deg('lat')},
      survey_id, remark, file_name, link_id, survey_point_id from {relation}"""


def _rejects() -> str:
    """Lines as they are spoilt in the event files, their faults, and the good rows of each run."""
    k = "cast(section_id as int) % 50"
    values = {
        "event_str": f"case when {k} in (1, 5) then 'abc' when {k} = 6 then '' else cast(event_str as varchar) end",
        "event_end": f"case when {k} = 2 then '12,5' when {k} = 5 then '1.2.3' else cast(event_end as varchar) end",
        "event_num": "right(section_id, 2)",
        "survey_date": f"case when {k} = 4 then '2022-13-45' else survey_date end",
    }
    for c in ("lat_str", "lat_end", "lon_str", "lon_end"):
        values[c] = f"cast(cast(round({c}*1e6) as bigint) as varchar)"
    fields = [
        "event_str", "event_end", "event_num", "event_type", "event_name", "link_id", "section_id", "km_start", "km_end",
        "length", "lane_no", "survey_date", "lat_str", "lat_end", "lon_str", "lon_end",
    ]
    shown = [f"coalesce({values.get(c, c)}, '')" for c in fields]
    head, last = " || ',' || ".join(shown[:-1]), shown[-1]
    line = f"{head} || case when {k} = 3 then '' when {k} = 7 then ',\"' || {last} else ',' || {last} end"
    faults = [
        (1, "event_str", "bad_number"), (2, None, "too_many_fields"), (3, None, "too_few_fields"), (4, "survey_date", "bad_date"),
        (5, "event_str", "bad_number"), (5, "event_end", "bad_number"), (6, "event_str", "missing"), (7, None, "open_quote"),
    ]
    text = lambda v: "null" if v is None else f"'{v}'"
    rows = " union all ".join(f'select {n} as k, {text(c)} as "column", {text(r)} as rule' for n, c, r in faults)
    return f"""select file_name, {line} as line, "column", rule, cast(null as bigint) as n
        from key_v join ({rows}) f on f.k = {k}
      union all select file_name, null, null, 'good', count(*) from key_v where {k} not between 1 and 7 group by file_name"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}

    q = inputs(Sql())
    out["source_merge"] = q.select(
        f"""select file_name, chainage, {deg('lon')}, {deg('lat')},
          case when chainage % 35 <> 0 then iri_right end as iri_right, case when chainage % 35 <> 0 then iri_left end as iri_left,
          case when chainage % 35 <> 0 then iri end as iri, case when chainage % 35 <> 0 then iri_lane end as iri_lane,
          case when chainage % 10 = 0 then rutt_right end as rutt_right, case when chainage % 10 = 0 then rutt_left end as rutt_left,
          case when chainage % 10 = 0 then rutting end as rutting, case when chainage % 55 <> 0 then texture end as texture,
          case when chainage % 55 <> 0 then etd_texture end as etd_texture from laser"""
    )
    out["landed_csv"] = q.select(
        f"select file_name, chainage, {deg('lon')}, {deg('lat')}, {_c(_METRICS)} from laser"
    )
    out["qa_links_dropped"] = q.select(
        """select distinct file_name, cast(date as varchar) as date, link_id from ev e where link_id is not null
          and not exists (select 1 from laser l join ev o on l.file_name = o.file_name and l.chainage % 200 = 0
            and l.chainage between o.event_str - 5 and o.event_end + 5
            where o.file_name = e.file_name and o.date = e.date and o.link_id = e.link_id)"""
    )
    out["pavement_events"] = q.select(
        "select file_name, event_str, event_end, event_name, link_id, cast(date as varchar) as date from ev"
    )
    side = "substr(right(link_id, 6), 1, 1)"
    out["decode_link"] = q.select(
        f"""select link_id, file_name, section_id, left(link_id, 3) as district, try_cast(substr(link_id, 4, 4) as bigint) as route,
          try_cast(substr(link_id, 8, 4) as bigint) as control, left(link_id, 11) as road_code,
          case when {side} in ('L', 'R') then case {side} when 'L' then 1 else -1 end * try_cast(substr(right(link_id, 6), 2, 1) as bigint) else 0 end as lane_group,
          cast(case left(right(link_id, 4), 2) when 'CC' then 1 when 'AC' then 2 end as bigint) as survey_type,
          left(right(link_id, 4), 2) || left(link_id, 11) as survey_code,
          cast(try_cast(right(link_id, 2) as int) as varchar) as run_code,
          case when right(lane_no, 1) in ('L', 'R') then 2 else try_cast(right(lane_no, 1) as bigint) end as lane_number
          from key_v"""
    )
    out["grid_points"] = q.select(
        f"""select file_name, chainage, {LOST} as is_lost, (lon <> 0 or lat <> 0) as has_any_fix, (lon <> 0 and lat <> 0) as has_fix,
          (lon <> 0 and lat > 0) as has_north_fix, (lon > 0 or lat > 0) as has_positive_fix from laser where chainage % 25 = 0"""
    )
    out["padded_band_join"] = q.select(
        f"""select l.file_name, cast(date as varchar) as date, link_id, event_name, event_str, event_end, l.chainage, {deg('lon')}, {deg('lat')}
          from ev e join laser l on l.file_name = e.file_name and l.chainage between event_str - 5 and event_end + 5"""
    )
    out["padded_sweep_join"] = out["padded_band_join"]
    out["cap_flags"] = q.select(
        """select file_name, chainage, iri_right as iri_right_raw, iri_right > 800 as iri_right_imputed,
          iri_left as iri_left_raw, iri_left > 800 as iri_left_imputed, true as in_range from laser"""
    )
    rut = ["rutt_right", "rutt_left", "rutting"]
    out["interpolate_rutting"] = rutting_between(Sql()).select(f"select file_name, chainage, {_c(rut)} from laser")

    q = in_events(Sql())
    out["band_join_points"] = q.select(_points_out(_POINT_COLUMNS, "pts0"))
    q = status(Sql())
    out["link_status"] = q.select(
        "select file_name, cast(date as varchar) as date, link_id, count, status, status_type from status"
    )
    out["qa_gps_lost"] = q.select(
        "select file_name, cast(date as varchar) as date, link_id, n_lost as count from counts where n_lost > 1"
    )

    q = points(Sql())
    out["assemble_points"] = q.select(_points_out([*_POINT_COLUMNS, "status", "status_type"], "pts"))
    out["event_endpoints"] = endpoints(points(Sql())).select(
        f"select {_c([c if c != 'date' else 'cast(date as varchar) as date' for c in _LINE])}, chainage, {deg('lon')}, {deg('lat')}, direction from ends"
    )
    dated = "file_name, cast(date as varchar) as date, link_id"
    q = gaps(points(Sql()))
    out["gps_islands"] = q.select(f"select {dated}, gap_start, gap_end, c_p, meter from islands")
    out["gps_gaps"] = q.select(
        f"select {dated}, gap_start, gap_end, c_p, meter, chainage, new_p_min, new_p_max from gaps"
    )
    gap_vertices(q)
    anchors = f"""select {_c([c if c != 'date' else 'cast(g.date as varchar) as date' for c in [f'g.{c}' if c != 'date' else c for c in _GAP]])},
      meter, chainage, new_p_min, new_p_max, chainage_str, chainage_end from gaps g join gap_spans s on {_on(_GAP, 'g', 's')}"""
    out["gap_anchors"] = q.select(anchors)
    out["qa_gap_one_sided"] = q.select(anchors + " where chainage_str = chainage_end")
    q = points(Sql()).add(
        "numbered",
        f"""select *, row_number() over (partition by {_c(_LINK)} order by chainage, event_str, lon, lat) as n_link from pts""",
    )
    q.add(
        "grouped",
        f"select *, n_link - row_number() over (partition by {_c(_LINK)}, lat, lon order by n_link) as island from numbered",
    )
    out["gps_islands_compat"] = q.select(
        f"""select {dated}, min(chainage) as gap_start, max(chainage) as gap_end, count(*) as c_p, count(*)*5 as meter
          from grouped where {LOST} group by {_c(_LINK)}, island"""
    )
    q = repaired(points(Sql()))
    out["repair_gps"] = q.select(
        f"select {dated}, event_str, chainage, {deg('lon')}, {deg('lat')}, gps_imputed from repaired"
    )
    q = repaired(all_gaps(points(Sql())))
    out["repair_all_points"] = q.select(
        f"select {dated}, event_str, chainage, {deg('lon')}, {deg('lat')}, gps_imputed from repaired"
    )
    q = near(points(Sql()))
    out["distance_join"] = q.select(
        f"""select file_name, chainage, direction, event_name, link_id, {deg('lon')}, {deg('lat')}, min(point_chainage) as chainage_data,
          count(*) as n_points from close where chainage <> point_chainage group by file_name, chainage, direction, event_name, link_id, lon, lat"""
    )
    out["qa_endpoints"] = q.select(
        f"""select distinct file_name, chainage, direction, event_name, link_id, {deg('lon')}, {deg('lat')} from ends e
          where not exists (select 1 from close c where c.file_name = e.file_name and c.chainage = e.chainage and c.lon = e.lon and c.lat = e.lat)"""
    )
    q = snapped(points(Sql()))
    out["snap_endpoints"] = q.select(
        f"select {dated}, event_str, event_end, chainage, {deg('lon_str')}, {deg('lat_str')}, {deg('lon_end')}, {deg('lat_end')} from snapped"
    )
    q = smoothed(points(Sql()))
    out["smooth_condition"] = q.select(f"select {dated}, event_str, chainage, {_c(_METRICS)} from smoothed")
    q = smoothed(points(Sql()), run="file_name, link_id")
    out["smooth_by_link"] = q.select(f"select {dated}, event_str, chainage, {_c(_METRICS)} from smoothed")
    q = points(Sql()).add("corr_v", views.CORRECTIONS)
    out["apply_corrections"] = q.select(
        f"""select {_c([c if c != 'date' else 'cast(date as varchar) as date' for c in ['p.file_name', 'date', 'link_id']])}, event_str, p.chainage,
          cast(round(coalesce(c.lon, p.lon)*1e9) as bigint) as lon, cast(round(coalesce(c.lat, p.lat)*1e9) as bigint) as lat
          from pts p left join corr_v c on c.file_name = p.file_name and c.chainage = p.chainage"""
    )
    q = points(Sql())
    out["qa_missing"] = q.select(
        """select file_name, link_id, chainage, iri, rutting, texture, frame_number from pts
          where iri is null or rutting is null or texture is null or frame_number is null and chainage % 25 = 0"""
    )
    out["qa_duplicate_positions"] = q.select(
        f"""select file_name, link_id, {deg('lon')}, {deg('lat')}, min(chainage) as min, max(chainage) as max, count(*) as count
          from pts where chainage % 25 = 0 and (lon <> 0 or lat <> 0) group by file_name, link_id, pts.lon, pts.lat having count(*) > 1"""
    )
    lane = f"case when {side} in ('L', 'R') then case {side} when 'L' then 1 else -1 end * try_cast(substr(right(link_id, 6), 2, 1) as bigint) else 0 end"
    q.add(
        "ruled",
        f"""select *, row_number() over (order by km_start, link_id, file_name, date, event_name, section_id, km_end, lane_no) as id from (
          select distinct file_name, date, event_name, link_id, section_id, lane_no, cast(replace(km_start, '+', '') as bigint) as km_start,
          cast(replace(km_end, '+', '') as bigint) as km_end, {lane} as lane_group from pts)""",
    )
    q.add(
        "rules",
        """select *, case when lane_group > 0 and km_end < km_start then 'left_descends' when lane_group < 0 and km_start < km_end then 'right_ascends'
          when lane_no is null then 'lane_missing' when left(lane_no, 1) = 'F' and abs(lane_group) <> 2 then 'not_frontage'
          when left(lane_no, 1) = 'I' and abs(lane_group) <> 3 then 'not_interchange' when left(lane_no, 1) = 'U' and abs(lane_group) <> 4 then 'not_u_turn'
          when left(lane_no, 1) = 'B' and abs(lane_group) <> 5 then 'not_bridge' when left(lane_no, 1) = 'T' and abs(lane_group) <> 6 then 'not_tunnel' end as rule
          from ruled""",
    )
    out["qa_link_rules"] = q.select(
        "select id, file_name, link_id, km_start, km_end, lane_no, lane_group, rule from rules where rule is not null"
    )

    q = point_local(points(Sql()))
    out["build_survey"] = q.select(_SURVEY_OUT)
    out["survey_line_parts"] = q.select(
        f"""select s.survey_id, cast(0 as bigint) as part_no, count(*) as n_vertices,
          string_agg(cast(v.chainage as varchar) || ':' || cast(cast(round(v.lon*1e6) as bigint) as varchar) || ':' || cast(cast(round(v.lat*1e6) as bigint) as varchar), ' ' order by vertex_no) as vertices
          from steps v join survey s on s.event_name = v.event_name and {_on(_LINK, 's', 'v')} and s.km_start = cast(replace(v.km_start, '+', '') as bigint)
            and s.km_end = cast(replace(v.km_end, '+', '') as bigint) and s.section_id = cast(v.section_id as bigint)
          group by s.survey_id"""
    )
    q.add("mid_vertices", f"select {_c(_LINE)}, chainage as m, lon, lat from vertices")
    q.add("mid_targets", f"select distinct {_c(_LINE)}, 0.5e0 as fraction from vertices")
    place(q, "mid", _LINE, "mid_targets", "mid_vertices")
    q.add("line_start", "select * from steps where vertex_no = 1")
    out["line_interpolation"] = q.select(
        f"""select s.survey_id, {deg('new_lon', 'lon')}, {deg('new_lat', 'lat')},
          cast(round(sqrt((new_lon-v.lon)*(new_lon-v.lon) + (new_lat-v.lat)*(new_lat-v.lat))*1e9) as bigint) as reach
          from mid m join line_start v on {_on_null(_LINE, 'm', 'v')} join survey s on s.event_name = v.event_name and {_on(_LINK, 's', 'v')}
            and s.section_id = cast(v.section_id as bigint)"""
    )
    out["survey_point_local"] = q.select(_local_out())
    published = ["survey_point_id", "survey_id", "km", *_METRICS]
    remark = "left(link_id, 3) || '_' || cast(year(date) as varchar) as remark"
    out["survey_point"] = q.select(f"select {_c(published)}, {deg('lon')}, {deg('lat')}, {remark} from local")
    out["csv_export"] = q.select(
        f'select survey_point_id - 1 as "index", {_c(published)}, {deg("lon")}, {deg("lat")}, {remark} from local'
    )
    intervals(q)
    out["interval_lengths"] = q.select(
        'select survey_id, survey_point_id, chainage, iv as "interval", km_sum from interval_sum'
    )
    out["interval_lengths_compat"] = q.select(
        """select survey_id, survey_point_id, chainage, iv as "interval",
          cast(sum(iv) over (partition by km_start order by chainage) as bigint) as km_sum from interval_len"""
    )
    images(q)
    out["survey_image"] = q.select(_images_out("images"))
    out["qa_duplicate_images"] = q.select(
        "select filename, count(filename) as cc from images group by filename having count(filename) > 1 or filename is null"
    )
    renamed(q)
    out["dedupe_images"] = q.select(_images_out("renamed"))
    folder = "left(directory, length(directory) - length(filename) - 1)"
    out["image_dirs"] = q.select(
        rf"""select folder, 'mkdir ' || folder as line from (select distinct 'E:\images\' || replace({folder}, '/', '\') as folder
          from renamed where directory is not null)"""
    )
    src = r"'E:\' || left(filename, 8) || '\' || regexp_extract(filename, '^\d{8}_\d+') || '\ROW-0\' || filename"
    dst = rf"'E:\images\' || replace({folder}, '/', '\') || '\' || filename"
    out["image_copy_manifest"] = q.select(
        f"select {src} as src, {dst} as dst, 'copy ' || {src} || ' ' || {dst} as line from renamed where directory is not null"
    )
    # straight lines of equal steps: the place follows from the step alone
    out["place_on_dense_lines"] = """
        select o_orderkey as k, cast(round(n * step * 1e12) as bigint) as lon, cast(round(n * step / 2 * 1e12) as bigint) as lat
        from (select o_orderkey, (o_orderkey % 5) * ([4, 8, 10][1 + o_orderkey % 3] // 4) as n,
                     case when o_orderkey % 2 = 0 then 20e0/7e0 else 20e0/11e0 end * 1e-6 as step from orders)"""
    exported(q, "renamed")
    export_columns = [
        "road_id", "road_revision", "section_id", "section_revision", "section_part_id", "road_code",
        "section_code", "km_start", "km_end", "iri", "rut", "mpd", "image_url",
    ]
    out["interval_export"] = q.select(
        f"select {_c(export_columns)}, {deg('lon')}, {deg('lat')} from exported"
    )
    out["interval_export_csv"] = out["interval_export"]
    quoted = ["link_id", "survey_code", "run_code", "date", "remark", "run_new", "directory", "filename", "imagepath", "file_name"]

    def inserts(table, columns, rows):
        text = " || ', ' || ".join(
            f"coalesce('''' || replace({c}, '''', '''''') || '''', 'NULL')" if c in quoted
            else f"coalesce(cast({c} as varchar), 'NULL')"
            for c in (f'"{c}"' if c == "interval" else c for c in columns)
        )
        return f"select 'INSERT INTO {table} ({_c(columns)}) VALUES (' || {text} || ');' as statement from ({rows})"

    surveyed = [
        *_SURVEY_COLUMNS, "length", "distance_odo", "distance_gps", "year", "survey_type", "date", "remark", "run_new", "interval",
    ]
    pictured = [
        "directory", "filename", "date", "img_id", "km", "imagepath", "lon", "lat", "survey_id", "remark",
        "file_name", "link_id", "survey_point_id",
    ]
    out["insert_statements"] = q.select(
        inserts("survey", surveyed, _SURVEY_OUT) + " union all "
        + inserts("survey_point", [*published, "lon", "lat", "remark"], f"select {_c(published)}, {deg('lon')}, {deg('lat')}, {remark} from local")
        + " union all " + inserts("survey_image", pictured, _images_out("renamed"))
    )

    q = points(Sql())
    gaps(q, "pts")
    snapped(q, "pts")
    repaired(q, "snapped")
    smoothed(q, "repaired")
    point_local(q, "smoothed")
    images(q, "smoothed")
    out["pipeline_survey"] = q.select(_SURVEY_OUT)
    out["pipeline_survey_point"] = q.select(
        f"select {_c(published)}, {deg('lon')}, {deg('lat')}, {remark} from local"
    )
    renamed(q)
    out["pipeline_survey_image"] = q.select(_images_out("renamed"))
    out["pipeline_survey_point_local"] = q.select(_local_out())
    out["pipeline_changed_runs"] = f"select * exclude (survey_id, survey_point_id) from ({out['pipeline_survey_point_local']})"
    out["qa_duplicate_images_after"] = q.select(
        "select filename, count(filename) as cc from renamed group by filename having count(filename) > 1 or filename is null"
    )
    lacking = "iri is null or rutting is null or texture is null or (frame_number is null and chainage % 25 = 0)"
    out["qa_summary"] = q.select(
        f"""select 'points' as metric, count(*) as n from pts
          union all select 'lost_points', count(*) from pts where {LOST}
          union all select 'missing_values', count(*) from pts where {lacking}
          union all select 'gap_points', count(*) from gaps
          union all select 'still_lost', count(*) from smoothed where {LOST}"""
    )
    out["qa_unrepaired"] = q.select(
        f"""select {dated}, gap_start, gap_end, c_p, meter, chainage, new_p_min, new_p_max from gaps g
          where exists (select 1 from smoothed r where {LOST} and {_on([*_LINK, 'chainage'], 'r', 'g')})"""
    )

    # the export programme: rutting between 10 m values is worked out anew first
    q = rutting_between(Sql())
    gaps(points(q), "pts")
    snapped(q, "pts")
    repaired(q, "snapped")
    smoothed(q, "repaired")
    point_local(q, "smoothed")
    images(q, "smoothed")
    renamed(q)
    exported(q, "renamed")
    out["pipeline_export_profile_survey_point"] = q.select(
        f"select {_c(published)}, {deg('lon')}, {deg('lat')}, {remark} from local"
    )
    out["pipeline_interval_export"] = q.select(
        f"select {_c(export_columns)}, {deg('lon')}, {deg('lat')} from exported"
    )

    # files by run, read back
    q = inputs(Sql())
    out["landed_key"] = q.select(
        f"""select file_name, event_str, event_end, right(section_id, 2) as event_num, rtrim(event_type) as event_type, event_name, link_id,
          section_id, km_start, km_end, length, rtrim(lane_no) as lane_no, rtrim(survey_date) as survey_date,
          {deg('lon_str')}, {deg('lat_str')}, {deg('lon_end')}, {deg('lat_end')} from key_v"""
    )
    out["landed_pic"] = q.select("select file_name, chainage_pic, frame_number from pic_v")
    out["raw_extracts"] = out["source_merge"]
    out["event_extract"], out["picture_extract"] = out["landed_key"], out["landed_pic"]
    out["landed_rejects"] = q.select(_rejects())
    out["published_manifest"] = q.select(
        """select version, key, name, n, case when name = 'events' then before end as before,
             case when name = 'events' then before + n end as last
           from (select * from (select cast(1 as bigint) as version, 'rising' as key union all select 2, 'falling' union all select 3, 'rising')) p,
           lateral (
             select 'events' as name, count(*) as n, case when key = 'rising' then 0 else
                 (select count(*) from key_v where km_start < km_end) end as before
               from key_v where (km_start < km_end) = (key = 'rising')
             union all select 'sections', count(*), 0 from customer where c_custkey % 13 <> 0) t"""
    )
    lines = point_local(points(Sql()))
    lines.add("halves", "select *, cast(substr(file_name, 8, 1) as int) % 2 as odd from survey")
    lines.add("publication", "select cast(1 as bigint) as version, 1 as odd union all select 2, 0 union all select 3, 1")
    out["survey_ids_continue"] = lines.select(
        """select version, row_number() over (partition by version order by survey_id)
             + case when odd = 1 then 0 else (select count(*) from halves where odd = 1) end as survey_id,
             file_name, link_id, km_start, km_end
           from halves join publication using (odd)"""
    )
    bare = lambda c: f"coalesce(cast({c} as varchar), 'NULL')"
    told = lambda c: f"coalesce('''' || replace({c}, '''', '''''') || '''', 'NULL')"

    def loaded(table, columns, numbers, rows, order):
        values = " || ', ' || ".join(bare(c) if c in numbers else told(c) for c in columns)
        return f"""select '{table}' as "table",
            'INSERT INTO {table} ({_c(columns)}) VALUES ' || string_agg('(' || vals || ')', ', ' order by rn) || ';' as statement
          from (select {values} as vals, row_number() over (order by {order}) - 1 as rn from ({rows}) r) v group by rn // 40"""

    events = ["file_name", "event_str", "event_end", "event_name", "link_id", "section_id", "km_start", "km_end", "lane_no"]
    sections = ["road_id", "road_revision", "section_revision", "section_part_id", "route", "control"]
    out["insert_files"] = inputs(Sql()).select(
        loaded("sections", sections, sections[1:], views.SECTION_DIM, "section_part_id") + " union all "
        + loaded("events", events, ["event_str", "event_end"], "select * from key_v", "file_name, event_str, section_id")
    )
    out["report_order"] = f"""select row_number() over (order by link_id, date, file_name) - 1 as "index", *
      from ({out["qa_gps_lost"]})"""
    out["section_lookup"] = (
        "select road_id, cast(road_revision as bigint) as road_revision, cast(section_revision as bigint) as section_revision, "
        f"section_part_id, route, control from ({views.SECTION_DIM})"
    )
    return out
