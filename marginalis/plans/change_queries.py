"""Queries of the general data problems: changes, instants, history, threads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, resolve_threads
from ..operators.instants import normalised_instants, union_all
from ..operators.snapshots import snapshot_changes
from ..operators.validity import attribute_history
from ..session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "versions"), table(spark, d, "entries"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    desks, abbreviations = table(spark, d, "desks"), table(spark, d, "zone_abbreviations")
    return union_all(
        [
            normalised_instants(table(spark, d, name), fields, key, desks, abbreviations, name)
            for name, fields, key in (("annotations", ["created", "modified"], "entry_id"), ("files", ["processed_at"], "file_log_id"))
        ]
    )


def _history(spark: SparkSession, d: str, keep: bool) -> DataFrame:
    return attribute_history(
        table(spark, d, "entry_history"),
        ["document_key", "entry_id"],
        ["entry_signature", "canonical_author"],
        F.unix_micros(F.try_to_timestamp("recorded_at")),
        F.upper(F.trim("change_type")) == "REMOVED",
        keep,
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d, False)


def p4_history(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d, True)


def _threads(spark: SparkSession, d: str) -> DataFrame:
    return resolve_threads(table(spark, d, "annotations"), is_child=F.upper(F.trim("relation_type")) == "REPLY")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    threads = _threads(spark, d)
    # roots are no cases; a reply always has a depth other than 0
    return threads.where("depth <> 0").select(F.col("node").alias("entry_id"), F.col("root").alias("root_entry_id"), "depth").distinct()


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    return descendants(_threads(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p4_found, p4_history, p5_found, p5_descendants)}

_BLANKS = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_ID = "upper(trim(replace({0}, '-', '_')))"
_STATE = "coalesce(trim(entry_signature), '') || chr(31) || coalesce(trim(canonical_author), '')"

_HISTORY = f"""
with e as (
  select trim(document_key) as document_key, trim(entry_id) as entry_id, epoch_us(cast(recorded_at as timestamptz)) as u,
         max(case when upper(trim(change_type)) = 'REMOVED' then '' else {_STATE} end) as s
  from entry_history where recorded_at is not null group by all),
l as (select *, lag(s) over (partition by document_key, entry_id order by u) as p from e),
c as (select * from l where p is null or p <> s),
n as (select *, lead(u) over (partition by document_key, entry_id order by u) as t from c)
select document_key, entry_id, u as valid_from_us, coalesce(t, -1) as valid_to_us"""

THREADS = """
with recursive
n as (select trim(source_sha256) as scope, trim(entry_id) as node,
             nullif(min(case when upper(trim(relation_type)) = 'REPLY' then coalesce(trim(parent_entry_id), '') else '' end), '') as parent
      from annotations where trim(entry_id) <> '' group by 1, 2),
r as (select scope, node, node as root, 0 as depth, [node] as path from n where parent is null
      union all
      select n.scope, n.node, r.root, r.depth + 1, list_append(r.path, n.node) from r join n on n.scope = r.scope and n.parent = r.node),
o as (select n.scope, n.node, 1 as depth, [n.node] as path from n left join n m on m.scope = n.scope and m.node = n.parent
      where n.parent is not null and m.node is null
      union all
      select n.scope, n.node, o.depth + 1, list_append(o.path, n.node) from o join n on n.scope = o.scope and n.parent = o.node),
a as (select scope, node, root, depth, path from r union all select scope, node, '', depth, path from o)
"""

_FOUND_SNAPSHOTS = f"""
with v as (select drive_file_id, {_ID.format('version_id')} as k, min(version_id) as version_id, min(modified_time) as m
           from versions where drive_file_id is not null and modified_time is not null group by 1, 2),
w as (select *, lag(k) over (partition by drive_file_id order by m, k) as pk from v),
e as (select {_ID.format('version_id')} as k, trim(entry_id) as entry_id, {_ID.format('entry_signature')} as s, active,
             row_number() over (partition by {_ID.format('version_id')}, trim(entry_id) order by last_seen desc, active desc, s desc) as r
      from entries where trim(entry_id) <> ''),
x as (select k, entry_id, s from e where r = 1 and active),
n as (select w.drive_file_id, w.version_id, w.k, x.entry_id, x.s from w join x using (k) where pk is not null),
p as (select w.drive_file_id, w.version_id, w.k, x.entry_id, x.s from w join x on x.k = w.pk)
select coalesce(n.drive_file_id, p.drive_file_id) as drive_file_id, coalesce(n.version_id, p.version_id) as version_id,
       coalesce(n.entry_id, p.entry_id) as entry_id,
       case when p.s is null then 'NEW' when n.s is null then 'REMOVED' else 'UPDATED' end as change_type
from n full join p on n.k = p.k and n.entry_id = p.entry_id where n.s is distinct from p.s"""

# The formats in groups, each by a pattern of its own.  DuckDB takes wall time that occurs twice for the
# later instant, so the one an hour or, on Lord Howe, half an hour before is tried.
_INSTANTS = r"""
with z as (select * from desks), raw as (
 select 'annotations' as table_name, trim(entry_id) as record_key, 'created' as field, desk_id, created as v from annotations
 union all select 'annotations', trim(entry_id), 'modified', desk_id, modified from annotations
 union all select 'files', cast(file_log_id as varchar), 'processed_at', desk_id, processed_at from files),
t as (select distinct r.table_name, r.record_key, r.field, z.zone_name, z.date_order, translate(trim(v), '٠١٢٣٤٥٦٧٨٩', '0123456789') as v
 from raw r left join z using (desk_id) where v is not null and not regexp_matches(v, '^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$')),
a as (select *, regexp_extract(v, '^(?:D:)?(\d{4})-?(\d\d)-?(\d\d)[T ]?(\d\d):?(\d\d)(?::?(\d\d))?(?:\.(\d+))?(Z|Z00''00''|[+-]\d\d[:'']?\d\d''?)?(?:\[[^\]]+\]| ([A-Za-z_]+(?:/[A-Za-z_]+)*))?$', ['y','mo','d','h','mi','s','f','off','zn']) as x,
 regexp_extract(v, '^(\d{1,4})/(\d{1,2})/(\d{1,4}) (\d{1,2}):(\d\d)(?::(\d\d))?(?: ([AP])M)?$', ['a','b','c','h','mi','s','ap']) as n,
 regexp_extract(v, '^([A-Z][a-z][a-z]) (\d{1,2}), (\d{4}) (\d{1,2}):(\d\d) ([AP])M$', ['mo','d','y','h','mi','ap']) as m,
 regexp_extract(v, '^(?:[A-Z][a-z][a-z], )?(\d{1,2}) ([A-Z][a-z][a-z]) (\d{4}) (\d\d):(\d\d):(\d\d) (\S+)$', ['d','mo','y','h','mi','s','off']) as r from t),
c as (select table_name, record_key, field, v, zone_name,
 case when x.y <> '' then x.y || '-' || x.mo || '-' || x.d || ' ' || x.h || ':' || x.mi || ':' || coalesce(nullif(x.s, ''), '00')
  when n.mi <> '' then case when length(n.a) = 4 then n.a || '-' || n.b || '-' || n.c when date_order = 'MDY' then n.c || '-' || n.a || '-' || n.b else n.c || '-' || n.b || '-' || n.a end
   || ' ' || case when n.ap = '' then n.h else cast(try_cast(n.h as int) % 12 + case n.ap when 'P' then 12 else 0 end as varchar) end || ':' || n.mi || ':' || coalesce(nullif(n.s, ''), '00')
  when m.y <> '' then m.y || '-' || list_position(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'], m.mo) || '-' || m.d || ' ' || cast(try_cast(m.h as int) % 12 + case m.ap when 'P' then 12 else 0 end as varchar) || ':' || m.mi || ':00'
  when r.y <> '' then r.y || '-' || list_position(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'], r.mo) || '-' || r.d || ' ' || r.h || ':' || r.mi || ':' || r.s end as wall,
 coalesce(nullif(x.off, ''), nullif(r.off, ''), '') as off, coalesce(nullif(x.zn, ''), zone_name) as zone, rpad(left(x.f, 6), 6, '0') as f from a),
e as (select c.*, try_strptime(wall, '%Y-%m-%d %H:%M:%S') as local, ab.offset_minutes from c left join zone_abbreviations ab on ab.abbreviation = c.off),
g as (select *, case when off = '' and local is not null then (local at time zone zone) end as late from e),
h as (select *, case when regexp_matches(v, '^\d{10}$') then try_cast(v as bigint) * 1000000 when regexp_matches(v, '^\d{13}$') then try_cast(v as bigint) * 1000
  when off like 'Z%' then epoch_us(local) when regexp_matches(off, '^[+-]') then epoch_us(local) - (try_cast(substr(off, 2, 2) as bigint) * 60 + try_cast(regexp_extract(off, '^...[:'']?(\d\d)', 1) as bigint)) * 60000000 * case when off like '-%' then -1 else 1 end
  when off <> '' then epoch_us(local) - offset_minutes::bigint * 60000000
  when ((late - interval 1 hour) at time zone zone) = local then epoch_us(late - interval 1 hour)
  when ((late - interval 30 minute) at time zone zone) = local then epoch_us(late - interval 30 minute) else epoch_us(late) end as us from g)
select distinct table_name, record_key, field, us + coalesce(try_cast(nullif(f, '') as bigint), 0) as utc_us from h where us is not null"""

ORACLES = {
    "p1_found": _FOUND_SNAPSHOTS,
    "p2_found": _INSTANTS,
    "p4_found": _HISTORY + " from n where s <> ''",
    "p4_history": _HISTORY + ", split_part(s, chr(31), 1) as entry_signature, split_part(s, chr(31), 2) as canonical_author from n where s <> ''",
    "p5_found": THREADS
    + """select distinct n.node as entry_id, coalesce(a.root, '') as root_entry_id, cast(coalesce(a.depth, -1) as bigint) as depth
from n left join a on a.scope = n.scope and a.node = n.node where n.parent is not null""",
    "p5_descendants": THREADS
    + """select scope, unnest(path[1:len(path) - 1]) as ancestor, node, cast(len(path) - unnest(range(1, len(path))) as bigint) as distance
from a where len(path) > 1""",
}
