"""Queries of the review-annotation operators, each with its SQL oracle.

Every query runs over its whole tables.  Rule tables, stored states and human
columns that aren't among the tables are derived from them, by the same rule
in both languages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import alerts, authors, changes, output, pages, registry, review, summaries
from ..operators.hierarchy import resolve_threads
from ..session import table
from .change_queries import THREADS, union_all

QUERIES, ORACLES = {}, {}

#: In DuckDB: white space evened out, as scalars.collapse does for ASCII space.
_WS = r"trim(regexp_replace(coalesce({0}, ''), '[\s\xA0\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{1680}}\x{{85}}\x{{2028}}\x{{2029}}\x{{0b}}]+', ' ', 'g'))"
ws = _WS.format
_SPACE = _WS[_WS.index("'[") + 2 : _WS.index("]+'")]
_STRIP = "regexp_replace(coalesce({0}, ''), '^[" + _SPACE + "]+|[" + _SPACE + "]+$', '', 'g')"
stripped = _STRIP.format


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_ONE_ANNOTATION = "(select distinct * from annotations)"
_LATEST_FILE = "(select * from (select *, row_number() over (partition by drive_file_id order by file_log_id desc) as rn from files where trim(drive_file_id) <> '') where rn = 1)"


@query(f"select drive_file_id, file_log_id, status, pdf_sha256, modified_time, size_bytes from {_LATEST_FILE}")
def q01_registry_latest(spark: SparkSession, d: str) -> DataFrame:
    return registry.latest_per_key(table(spark, d, "files"), "drive_file_id", "file_log_id").select("drive_file_id", "file_log_id", "status", "pdf_sha256", "modified_time", "size_bytes")


def _incoming(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "versions").select("version_id", "document_key", "drive_file_id", "pdf_sha256", "modified_time", "size_bytes").distinct()


_INCOMING = "(select distinct version_id, document_key, drive_file_id, pdf_sha256, modified_time, size_bytes from versions)"


@query(
    f"""select v.version_id, v.drive_file_id, case when l.drive_file_id is not null and l.modified_time is not distinct from v.modified_time
 and l.size_bytes is not distinct from v.size_bytes then 'SKIP_UNCHANGED' else 'PROCESS' end as action
from {_INCOMING} v left join {_LATEST_FILE} l on l.drive_file_id = v.drive_file_id"""
)
def q02_precheck(spark: SparkSession, d: str) -> DataFrame:
    return registry.precheck(_incoming(spark, d), table(spark, d, "files")).select("version_id", "drive_file_id", "action")


@query(
    f"""select v.version_id, v.drive_file_id, v.modified_time from {_INCOMING} v
where not exists (select 1 from {_LATEST_FILE} l where l.drive_file_id = v.drive_file_id and l.modified_time = v.modified_time and l.size_bytes = v.size_bytes)"""
)
def q02b_files_to_process(spark: SparkSession, d: str) -> DataFrame:
    return registry.files_to_process(_incoming(spark, d), table(spark, d, "files")).select("version_id", "drive_file_id", "modified_time")


@query(
    f"""with o as (select lower(pdf_sha256) as sha, max(drive_file_id) as owner from (
  select *, row_number() over (partition by pdf_sha256 order by file_log_id desc) as rn from files where trim(pdf_sha256) <> '') where rn = 1 group by 1)
select v.version_id, v.drive_file_id, o.owner as owner_file_id,
 case when o.owner is not null and o.owner <> v.drive_file_id then 'SKIP_DUPLICATE_FILE' else 'PROCESS' end as action
from {_INCOMING} v left join o on o.sha = lower(trim(v.pdf_sha256))"""
)
def q03_sha_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return registry.hash_precheck(_incoming(spark, d), table(spark, d, "files")).select("version_id", "drive_file_id", "owner_file_id", "action")


@query()
def q04_normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.normalize_text(F.col("text")).alias("normal_text"))


@query(f"select doc_id, {ws('text')} as plain_text, sha256({ws('text')}) as fingerprint from documents")
def q04b_collapsed_text(spark: SparkSession, d: str) -> DataFrame:
    plain = S.collapse(F.col("text"))
    return table(spark, d, "documents").select("doc_id", plain.alias("plain_text"), S.fingerprint(plain).alias("fingerprint"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("source = 'page_text'").select("doc_id", "document_key", "text", "pdf_page", "book_page")


_MASTER = f"""m as (select sha256({ws('text')}) as fp, arg_max(coalesce(book_page, ''), (pdf_page, coalesce(book_page, ''))) as book_page
 from documents where source = 'page_text' and trim(book_page) <> '' and {ws('text')} <> '' group by 1),
p as (select d.doc_id, d.document_key, coalesce(nullif(m.book_page, ''), nullif(trim(d.book_page), ''), '') as mapped_page,
 case when m.book_page <> '' then 'master_text_fingerprint' when trim(d.book_page) <> '' then 'pdf_page_label' else 'unresolved' end as mapping_method
 from documents d left join m on m.fp = sha256({ws('d.text')}) where d.source = 'page_text')"""


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d)
    return pages.map_pages(rows, pages.master_index(rows.where("trim(book_page) <> ''"), "text", "pdf_page", "book_page"), "text", "book_page")


@query(f"with {_MASTER} select * from p")
def q05_page_match(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).select("doc_id", "document_key", "mapped_page", "mapping_method")


@query(
    f"""with {_MASTER}, c as (select document_key, count(*) as pages, count(*) filter (where mapped_page <> '') as mapped_pages from p group by 1)
select document_key, pages, mapped_pages, pages - mapped_pages as unresolved_pages, round_even(mapped_pages / pages, 4) as coverage,
 round_even(mapped_pages / pages, 4) < 0.8 as master_suspect, greatest(pages - 30, 0) as pages_beyond_master from c"""
)
def q06_mapping_coverage(spark: SparkSession, d: str) -> DataFrame:
    return pages.mapping_coverage(_mapped(spark, d), "document_key", "mapped_page", 30)


@query(
    f"""{THREADS} select n.scope, n.node, case when a.node is null then 'cycle' when a.root = '' then 'orphan' else 'ok' end as status,
 coalesce(a.root, '') as root, cast(coalesce(a.depth, -1) as bigint) as depth from n left join a on a.scope = n.scope and a.node = n.node"""
)
def q07_thread_roots(spark: SparkSession, d: str) -> DataFrame:
    return resolve_threads(table(spark, d, "annotations"), is_child=F.col("relation_type") == "REPLY").select("scope", "node", "status", "root", "depth")


_LIST = "array_to_string(list_transform(list_sort(list(distinct {0}) filter (where {1})), lambda x: {2}), ', ')"
_SUMMARY = f"""select source_sha256, count(*) as entries_found, count(*) filter (where import_candidate) as import_candidates, count(*) filter (where not coalesce(import_candidate, false)) as skipped,
 count(*) filter (where relation_type = 'ROOT') as root_relations, count(*) filter (where relation_type = 'REPLY') as reply_relations, count(*) filter (where relation_type = 'GROUP') as group_relations,
 count(*) filter (where entry_type = 'COMMENT') as comments_found, count(*) filter (where entry_type = 'REPLY') as replies_found, coalesce(max(reply_depth), 0) as max_reply_depth,
 coalesce({_LIST.format(stripped('reviewer'), stripped('reviewer') + " <> ''", 'x')}, '') as reviewers,
 coalesce({_LIST.format(f"struct_pack(k := lower({stripped('raw_author')}), v := {stripped('raw_author')})", stripped('raw_author') + " <> ''", 'x.v')}, '') as raw_authors,
 coalesce({_LIST.format(f"struct_pack(t := not regexp_full_match({stripped('book_page')}, '[0-9]{{1,18}}'), n := coalesce(try_cast({stripped('book_page')} as bigint), 0), v := {stripped('book_page')})", stripped('book_page') + " <> ''", 'x.v')}, '') as book_pages,
 coalesce({_LIST.format('pdf_page', stripped('book_page') + " = ''", 'cast(x as varchar)')}, '') as pages_unresolved,
 coalesce({_LIST.format('pdf_page', "footer_status = 'footer_mismatch'", 'cast(x as varchar)')}, '') as footer_mismatches
from """


def _summary(rows: DataFrame) -> DataFrame:
    return summaries.file_summary(rows, ["source_sha256"])


@query(f"{_SUMMARY}{_ONE_ANNOTATION} group by 1")
def q08_extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _summary(table(spark, d, "annotations").distinct())
    return s.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ", ") for c, kind in s.dtypes if kind.startswith("array")})


@query(
    f"""select source_sha256, map_from_entries(list((skip_reason, n) order by skip_reason)) as skipped from (
 select source_sha256, skip_reason, count(*) as n from {_ONE_ANNOTATION} where skip_reason <> '' group by 1, 2) group by 1"""
)
def q08b_skipped_by_reason(spark: SparkSession, d: str) -> DataFrame:
    return summaries.skipped_by_reason(table(spark, d, "annotations").distinct(), ["source_sha256"])


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").distinct()


def _rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of five scopes as the stored entries imply them."""
    e = table(spark, d, "entries").where("author_status = 'RESOLVED' and trim(canonical_author) <> ''")

    def make(scope: str, keys: list[str], rows: DataFrame) -> DataFrame:
        value = lambda c: F.col(c) if c in keys else F.lit("")
        return rows.groupBy(*keys).agg(F.min("canonical_author").alias("canonical_author")).select(
            F.concat_ws("::", F.lit(scope), *keys).alias("rule_id"), F.lit(scope).alias("scope"), *[value(c).alias(c) for c in ("document_key", "version_id", "root_entry_id", "entry_id", "raw_author")],
            "canonical_author", F.lit("APPROVED").alias("status"), F.lit(0).cast("long").alias("rule_ord"),
        )

    return (
        make("ENTRY", ["document_key", "entry_id"], e.where("category = 'Typo'"))
        .unionByName(make("THREAD", ["document_key", "root_entry_id"], e.where("trim(root_entry_id) <> '' and relation_type = 'REPLY'")))
        .unionByName(make("VERSION", ["version_id", "raw_author"], e.where("category = 'Art'")))
        .unionByName(make("DOCUMENT_RAW", ["document_key", "raw_author"], e.where("author_resolution_method = 'DOCUMENT_RAW'")))
        .unionByName(make("GLOBAL_ALIAS", ["raw_author"], e.where("author_resolution_method = 'GLOBAL_ALIAS'")))
    )


_RAW = f"(case when lower({ws('raw_author')}) in ('', 'user', 'reviewer', 'author', 'unknown', 'anonymous', 'admin') then '=' || {ws('raw_author')} else '~' || lower({ws('raw_author')}) end)"
_GENERIC = f"lower({ws('raw_author')}) in ('', 'user', 'reviewer', 'author', 'unknown', 'anonymous', 'admin')"
_RESOLVED = f"""e0 as (select * from entries where author_status = 'RESOLVED' and trim(canonical_author) <> ''),
r0 as (
 select 1 as p, 'ENTRY' as scope, 'ENTRY::' || document_key || '::' || entry_id as rule_id, document_key, '' as version_id, entry_id, '' as raw_author, '' as root_entry_id, min(canonical_author) as author from e0 where category = 'Typo' group by document_key, entry_id
 union all select 2, 'THREAD', 'THREAD::' || document_key || '::' || root_entry_id, document_key, '', '', '', root_entry_id, min(canonical_author) from e0 where trim(root_entry_id) <> '' and relation_type = 'REPLY' group by document_key, root_entry_id
 union all select 3, 'VERSION', 'VERSION::' || version_id || '::' || raw_author, '', version_id, '', raw_author, '', min(canonical_author) from e0 where category = 'Art' group by version_id, raw_author
 union all select 4, 'DOCUMENT_RAW', 'DOCUMENT_RAW::' || document_key || '::' || raw_author, document_key, '', '', raw_author, '', min(canonical_author) from e0 where author_resolution_method = 'DOCUMENT_RAW' group by document_key, raw_author
 union all select 5, 'GLOBAL_ALIAS', 'GLOBAL_ALIAS::' || raw_author, '', '', '', raw_author, '', min(canonical_author) from e0 where author_resolution_method = 'GLOBAL_ALIAS' group by raw_author),
r as (select *, {_RAW} as rk from r0 where not (scope = 'GLOBAL_ALIAS' and {_GENERIC})),
e as (select distinct * from entries), k as (select distinct document_key, version_id, entry_id, root_entry_id, raw_author, {_RAW} as rk from e),
c as (
 select k.*, r.p, r.scope, r.rule_id, r.author from k join r on r.scope = 'ENTRY' and r.document_key = trim(k.document_key) and r.entry_id = trim(k.entry_id)
 union all select k.*, r.p, r.scope, r.rule_id, r.author from k join r on r.scope = 'THREAD' and r.document_key = trim(k.document_key) and trim(r.root_entry_id) = trim(k.root_entry_id)
 union all select k.*, r.p, r.scope, r.rule_id, r.author from k join r on r.scope = 'VERSION' and trim(r.version_id) = trim(k.version_id) and r.rk = k.rk
 union all select k.*, r.p, r.scope, r.rule_id, r.author from k join r on r.scope = 'DOCUMENT_RAW' and r.document_key = trim(k.document_key) and r.rk = k.rk
 union all select k.*, r.p, r.scope, r.rule_id, r.author from k join r on r.scope = 'GLOBAL_ALIAS' and r.rk = k.rk),
b as (select * from (select *, row_number() over (partition by document_key, version_id, entry_id, root_entry_id, raw_author order by p, rule_id) as rn from c) where rn = 1),
z as (select e.document_key, e.version_id, e.entry_id, e.raw_author, e.last_seen, e.entry_signature, coalesce(trim(b.author), '') as canonical_author,
 case when b.p is null then 'UNRESOLVED' else 'RESOLVED' end as author_status,
 coalesce(b.scope, case when {_GENERIC.replace('raw_author', 'e.raw_author')} then 'GENERIC_RAW_UNRESOLVED' else 'DISTINCTIVE_RAW_UNMAPPED' end) as author_resolution_method,
 coalesce(b.rule_id, '') as author_rule_id
 from e left join b on b.document_key = e.document_key and b.version_id = e.version_id and b.entry_id = e.entry_id and b.root_entry_id is not distinct from e.root_entry_id and b.raw_author is not distinct from e.raw_author)"""


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return authors.resolve_authors(_entries(spark, d), _rules(spark, d))


@query(f"with {_RESOLVED} select document_key, version_id, entry_id, last_seen, entry_signature, canonical_author, author_status, author_resolution_method, author_rule_id from z")
def q09_author_resolution(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).select("document_key", "version_id", "entry_id", "last_seen", "entry_signature", "canonical_author", "author_status", "author_resolution_method", "author_rule_id")


@query(
    f"""with {_RESOLVED} select document_key, count(*) as total, count(*) filter (where author_status = 'RESOLVED') as resolved, count(*) filter (where author_status <> 'RESOLVED') as unresolved,
 coalesce(array_to_string(list_transform(list_sort(list(distinct (lower(canonical_author), canonical_author)) filter (where author_status = 'RESOLVED' and canonical_author <> '')), lambda x: x[2]), '; '), '') as canonical_authors,
 coalesce(array_to_string(list_transform(list_sort(list(distinct (lower(trim(coalesce(raw_author, ''))), trim(coalesce(raw_author, '')))) filter (where author_status <> 'RESOLVED')), lambda x: x[2]), '; '), '') as unresolved_raw_authors
from z group by 1"""
)
def q10_author_summary(spark: SparkSession, d: str) -> DataFrame:
    return authors.author_summary(_resolved(spark, d), ["document_key"])


_AUTHOR = ("canonical_author", "author_status")
_FIELDS = ("raw_author", "pdf_page", "book_page", "annotation_type", "relation_type", "content", "selected_text")


def _current(spark: SparkSession, d: str) -> DataFrame:
    """The newest state of each entry: the extractor's rows."""
    reviewer = S.strip(F.col("reviewer"))
    a = table(spark, d, "annotations").select(
        "document_key", F.trim("entry_id").alias("entry_id"), F.concat(S.text(F.col("document_key")), F.lit("@"), S.text(F.col("source_sha256"))).alias("version_id"), *[F.col("comment" if f == "content" else f).alias(f) for f in _FIELDS],
        reviewer.alias("canonical_author"), F.when(reviewer == "", "UNRESOLVED").otherwise("RESOLVED").alias("author_status"),
    )
    return _unique(a.withColumn("entry_signature", S.entry_signature(*[F.col(f) for f in _FIELDS])))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """The stored state: the last row of each entry by last_seen."""
    e = table(spark, d, "entries").select("document_key", F.trim("entry_id").alias("entry_id"), F.col("version_id"), *_FIELDS, "active", "first_seen", "last_seen", *_AUTHOR)
    e = e.withColumn("entry_signature", S.entry_signature(*[F.col(f) for f in _FIELDS]))
    rest = [c for c in e.columns if c not in ("document_key", "entry_id", "last_seen")]
    return e.groupBy("document_key", "entry_id").agg(F.max(F.struct("last_seen", "entry_signature", *[c for c in rest if c != "entry_signature"])).alias("r")).select("document_key", "entry_id", "r.*")


def _unique(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("document_key", "entry_id", "entry_signature")]
    return df.groupBy("document_key", "entry_id").agg(F.max(F.struct("entry_signature", *rest)).alias("r")).select("document_key", "entry_id", "r.*")


_T = lambda c: f"coalesce(cast({c} as varchar), '')"
_SIG_C = "sha256(to_json({" + ", ".join(f"'f{i:02d}': {_T('comment' if f == 'content' else f)}" for i, f in enumerate(_FIELDS)) + "}))"
_SIG_S = "sha256(to_json({" + ", ".join(f"'f{i:02d}': {_T(f)}" for i, f in enumerate(_FIELDS)) + "}))"
_PLAN = f"""cur as (select * from (select *, row_number() over (partition by document_key, entry_id order by entry_signature desc, version_id desc, canonical_author desc) as rn from (
  select document_key, trim(entry_id) as entry_id, coalesce(document_key, '') || '@' || coalesce(source_sha256, '') as version_id, raw_author, {stripped('reviewer')} as canonical_author, case when {stripped('reviewer')} = '' then 'UNRESOLVED' else 'RESOLVED' end as author_status, {_SIG_C} as entry_signature from annotations)) where rn = 1),
sto as (select * from (select *, row_number() over (partition by document_key, entry_id order by last_seen desc, entry_signature desc, version_id desc, active desc, first_seen desc, canonical_author desc, author_status desc) as rn from (
  select document_key, trim(entry_id) as entry_id, version_id, raw_author, canonical_author, author_status, {_SIG_S} as entry_signature, active, first_seen, last_seen from entries)) where rn = 1),
plan as (select * from (select coalesce(c.document_key, p.document_key) as document_key, coalesce(c.entry_id, p.entry_id) as entry_id,
  case when p.entry_id is null then 'NEW' when c.entry_id is null then case when p.active then 'REMOVED' end when not coalesce(p.active, false) then 'UPDATED'
   when c.entry_signature <> p.entry_signature then 'UPDATED' when c.canonical_author <> {stripped('p.canonical_author')} or c.author_status <> {stripped('p.author_status')} then 'AUTHOR_UPDATED' else 'UNCHANGED' end as change_type,
  c.canonical_author as c_author, p.canonical_author as p_author, c.author_status as c_status, p.author_status as p_status,
  c.version_id as c_version, p.version_id as p_version, c.entry_signature as c_sig, p.entry_signature as p_sig, c.raw_author as c_raw, p.raw_author as p_raw, p.first_seen as first_seen
 from cur c full join sto p on c.document_key = p.document_key and c.entry_id = p.entry_id) where change_type is not null)"""


def _plan(spark: SparkSession, d: str) -> DataFrame:
    return changes.change_plan(_current(spark, d), _stored(spark, d), author_fields=_AUTHOR)


@query(f"with {_PLAN} select document_key, entry_id, change_type from plan")
def q11_change_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).select("document_key", "entry_id", "change_type")


@query(
    f"""with {_PLAN} select document_key, count(*) filter (where change_type = 'NEW') as new, count(*) filter (where change_type = 'UPDATED') as updated,
 count(*) filter (where change_type = 'AUTHOR_UPDATED') as author_updated, count(*) filter (where change_type = 'UNCHANGED') as unchanged, count(*) filter (where change_type = 'REMOVED') as removed from plan group by 1"""
)
def q11b_change_counts(spark: SparkSession, d: str) -> DataFrame:
    return changes.change_counts(_plan(spark, d), ["document_key"])


_NOW = "2026-01-01T00:00:00Z"
_COLUMNS = ["document_key", "entry_id", "version_id", "raw_author", "entry_signature", *_AUTHOR]


@query(
    f"""with {_PLAN} select case change_type when 'NEW' then 'insert' when 'REMOVED' then 'deactivate' else 'update' end as write, document_key, entry_id,
 case when change_type = 'REMOVED' then p_version else c_version end as version_id, case when change_type = 'REMOVED' then p_sig else c_sig end as entry_signature,
 case when change_type = 'REMOVED' then p_author else c_author end as canonical_author, case when change_type = 'REMOVED' then p_status else c_status end as author_status,
 change_type <> 'REMOVED' as active, case when change_type = 'REMOVED' then 'HISTORICAL' else 'CURRENT' end as source_state,
 case when change_type = 'NEW' then '{_NOW}' else coalesce(nullif(trim(first_seen), ''), '{_NOW}') end as first_seen, '{_NOW}' as last_seen
from plan where change_type <> 'UNCHANGED'"""
)
def q12_mutations(spark: SparkSession, d: str) -> DataFrame:
    m = changes.mutations(_plan(spark, d), _NOW, _COLUMNS)
    names = ["document_key", "entry_id", "version_id", "entry_signature", *_AUTHOR, "active", "source_state", "first_seen", "last_seen"]
    out = None
    for write, rows in (("insert", m.inserts), ("update", m.updates), ("deactivate", m.deactivations)):
        part = rows.select(F.lit(write).alias("write"), *names)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    f"""with {_PLAN}, h as (select *, change_type = 'REMOVED' as gone from plan where change_type <> 'UNCHANGED')
select document_key || '::' || entry_id || '::' || case when gone then p_version else c_version end || '::' || change_type as history_key, document_key, entry_id, change_type,
 case when gone then p_sig else c_sig end as entry_signature, coalesce(p_sig, '') as previous_signature, case when gone then p_version else c_version end as version_id,
 case when gone then p_raw else c_raw end as raw_author, case when gone then p_author else c_author end as canonical_author, case when gone then p_status else c_status end as author_status, not gone as active, case when gone then 'HISTORICAL' else 'CURRENT' end as source_state, '{_NOW}' as recorded_at from h"""
)
def q13_history(spark: SparkSession, d: str) -> DataFrame:
    return changes.history_rows(_plan(spark, d), _NOW, _COLUMNS)


_ORDER = ["pdf_page", "xref", "entry_id"]


def _samples(value: str, most: int, name: str, between: str) -> str:
    return f"""{name} as (select document_key, version_id, raw_author, array_to_string(list(v order by r), '{between}') as {name} from (
 select *, row_number() over (partition by document_key, version_id, raw_author order by seen, v) as r from (
  select document_key, version_id, raw_author, {value} as v, min(struct_pack(a := coalesce(pdf_page, -1), b := coalesce(xref, -1), c := entry_id)) as seen from o where trim({value}) <> '' group by 1, 2, 3, 4)) where r <= {most} group by 1, 2, 3)"""


_QUEUE = f"""o as (select {stripped('document_key')} as document_key, {stripped('version_id')} as version_id, coalesce(raw_author, '') as raw_author, {stripped('entry_id')} as entry_id,
 {stripped("coalesce(nullif(book_page, ''), nullif(cast(pdf_page as varchar), '0'))")} as page, left({stripped('content')}, 160) as content, pdf_page, xref
 from (select distinct * from entries) where upper({stripped('author_status')}) <> 'RESOLVED'),
{_samples('entry_id', 5, 'sample_entry_ids', ', ')}, {_samples('page', 8, 'sample_pages', ', ')}, {_samples('content', 3, 'sample_content', ' | ')},
queue as (select document_key || '::' || version_id || '::' || raw_author as review_key, document_key, version_id, raw_author, entry_count, coalesce(sample_entry_ids, '') as sample_entry_ids,
 coalesce(sample_pages, '') as sample_pages, coalesce(sample_content, '') as sample_content
from (select document_key, version_id, raw_author, count(*) as entry_count from o group by 1, 2, 3)
 left join sample_entry_ids using (document_key, version_id, raw_author) left join sample_pages using (document_key, version_id, raw_author) left join sample_content using (document_key, version_id, raw_author))"""


def _queue(spark: SparkSession, d: str) -> DataFrame:
    return review.review_queue(_entries(spark, d), _ORDER)


@query(f"with {_QUEUE} select * from queue")
def q14_review_queue(spark: SparkSession, d: str) -> DataFrame:
    return _queue(spark, d)


_HUMAN = ["decision", "canonical_author", "rule_scope"]


def _stored_review(spark: SparkSession, d: str) -> DataFrame:
    """A stored review: the groups of two and more entries, decided by their size."""
    return _queue(spark, d).where("entry_count > 1").withColumns(
        {
            "entry_count": F.col("entry_count") - 1,
            "decision": F.when(F.col("entry_count") > 2, "approve").otherwise(""),
            "canonical_author": F.when(F.col("entry_count") > 3, F.concat(F.lit("Decided "), F.col("raw_author"))).otherwise(""),
            "rule_scope": F.when(F.col("entry_count") > 4, "VERSION").otherwise(""),
        }
    )


@query(
    f"""with {_QUEUE} select *, case when entry_count > 1 then 'UPDATE' else 'INSERT' end as write, case when entry_count > 2 then 'approve' else '' end as decision,
 case when entry_count > 3 then 'Decided ' || raw_author else '' end as canonical_author, case when entry_count > 4 then 'VERSION' else '' end as rule_scope from queue"""
)
def q15_review_upsert(spark: SparkSession, d: str) -> DataFrame:
    return review.review_upsert(_queue(spark, d), _stored_review(spark, d), _HUMAN)


@query(
    f"""with {_QUEUE} select 'PM::' || review_key as rule_id, 'VERSION' as scope, document_key, version_id, '' as root_entry_id, '' as entry_id, raw_author, trim('Decided ' || raw_author) as canonical_author, 'APPROVED' as status
from queue where entry_count > 3 and entry_count <= 6"""
)
def q16_rule_promotion(spark: SparkSession, d: str) -> DataFrame:
    stored = _stored_review(spark, d)
    known = review.approved_rules(stored.where("entry_count + 1 > 6"))
    return review.promote_rules(stored, known)


def _visible(spark: SparkSession, d: str) -> DataFrame:
    rows = output.visible_rows(output.eligible_rows(table(spark, d, "annotations").distinct()), F.lit("link"))
    return output.first_per_key(rows, ["reviewer", "comment_id"], ["ord", "pdf_name"])


_VISIBLE = """vis as (select * from (select *, row_number() over (partition by reviewer, comment_id order by ord, pdf_name, author, category, comment, created_date, last_modified, page, pdf_drive_link, replies, resolved, annotation_type) as rn from (
 select reviewer, ord, coalesce(source_file, '') as pdf_name, 'link' as pdf_drive_link, coalesce(book_page, '') as page, coalesce(comment, '') as comment, '' as category, coalesce(reviewer, '') as author,
  coalesce(created, '') as created_date, coalesce(modified, '') as last_modified, '' as resolved, '' as replies, coalesce(nullif(trim(annotation_id), ''), identity_key, '') as comment_id, coalesce(annotation_type, '') as annotation_type
 from (select distinct * from annotations) where trim(reviewer) <> '' and trim(book_page) <> '' and coalesce(trim(footer_status), '') <> 'footer_mismatch')) where rn = 1)"""


@query(f"with {_VISIBLE} select reviewer, ord, comment_id, pdf_name, page, annotation_type from vis")
def q17_visible_rows(spark: SparkSession, d: str) -> DataFrame:
    return _visible(spark, d).select("reviewer", "ord", "comment_id", "pdf_name", "page", "annotation_type")


def _stored_output(spark: SparkSession, d: str) -> DataFrame:
    """A stored reviewer's table: the entries' last state, older ones without ids."""
    e = _stored(spark, d).join(table(spark, d, "entries").select("document_key", F.trim("entry_id").alias("entry_id"), "category").groupBy("document_key", "entry_id").agg(F.max("category").alias("category")), ["document_key", "entry_id"])
    return e.select(
        F.concat_ws("::", "document_key", "entry_id").alias("row_no"), F.when(F.col("pdf_page") > 10, F.col("entry_id")).otherwise("").alias("comment_id"), S.text(F.col("book_page")).alias("page"), S.text(F.col("content")).alias("comment"),
        S.text(F.col("category")).alias("category"), F.lit("Yes").alias("resolved"), F.lit("seen").alias("replies"), F.lit("Note").alias("annotation_type"),
    )


_MATCH = f"""{_VISIBLE}, {_PLAN.split("plan as")[0].rstrip().rstrip(',')},
e1 as (select * from (select document_key, trim(entry_id) as entry_id, pdf_page, book_page, content, row_number() over (partition by document_key, trim(entry_id) order by last_seen desc, {_SIG_S} desc, version_id desc) as rn from entries) where rn = 1),
cat as (select document_key, trim(entry_id) as entry_id, max(category) as category from entries group by 1, 2),
st as (select e1.document_key || '::' || e1.entry_id as row_no, case when pdf_page > 10 then e1.entry_id else '' end as comment_id, {ws('book_page')} || chr(31) || {ws('content')} as k, coalesce(category, '') as category from e1 join cat using (document_key, entry_id)),
byid as (select comment_id, min(row_no) as row_no from st where comment_id <> '' group by 1),
claimed as (select row_no from byid where comment_id in (select comment_id from vis)),
free as (select k, min(row_no) as row_no, count(*) as n from st where row_no not in (select row_no from claimed) group by 1),
v1 as (select vis.*, byid.row_no as r1, free.row_no as r2, free.n, {ws('page')} || chr(31) || {ws('comment')} as k from vis left join byid using (comment_id) left join free on free.k = {ws('page')} || chr(31) || {ws('comment')}),
v2 as (select *, row_number() over (partition by case when r1 is null and r2 is not null then k else chr(30) || comment_id end order by ord, comment_id) as turn from v1),
mt as (select *, case when r1 is not null then 'ID' when r2 is not null and n > 1 then 'AMBIGUOUS' when r2 is not null and turn = 1 then 'KEY' else 'NONE' end as match,
 coalesce(r1, case when r2 is not null and n = 1 and turn = 1 then r2 end) as stored_id from v2)"""


@query(f"with {_MATCH} select match, count(*) as n, count(stored_id) as with_row, count(distinct stored_id) as stored_rows from mt group by 1")
def q18_output_upsert(spark: SparkSession, d: str) -> DataFrame:
    m = output.match_output(_visible(spark, d), _stored_output(spark, d))
    return m.groupBy("match").agg(F.count("*").alias("n"), F.count("stored_id").alias("with_row"), F.countDistinct("stored_id").alias("stored_rows"))


@query(
    f"""with {_MATCH} select distinct mt.comment_id, mt.reviewer as author, match, st.row_no as stored_id, coalesce(st.category, '') as category, case when st.row_no is null then '' else 'Yes' end as resolved,
 case when st.row_no is null then '' else 'seen' end as replies, coalesce(nullif(mt.annotation_type, ''), case when st.row_no is null then '' else 'Note' end) as annotation_type
from mt left join st on st.row_no = mt.stored_id where match = 'ID'"""
)
def q19_field_merge(spark: SparkSession, d: str) -> DataFrame:
    stored = _stored_output(spark, d)
    merged = output.merge_fields(output.match_output(_visible(spark, d), stored), stored)
    return merged.where("match = 'ID'").select("comment_id", "author", "match", "stored_id", "category", "resolved", "replies", "annotation_type").distinct()


# The same rules with every row told apart: rows of several reviewers may share ord and comment_id.
_MATCH_ROWS = _MATCH.replace("order by ord, comment_id) as turn", "order by ord, comment_id, reviewer) as turn")


@query(f"with {_MATCH_ROWS} select reviewer, comment_id, match, stored_id from mt")
def q18_output_rows(spark: SparkSession, d: str) -> DataFrame:
    return output.match_output(_visible(spark, d), _stored_output(spark, d)).select("reviewer", "comment_id", "match", "stored_id")


@query(
    f"""with {_MATCH_ROWS} select mt.pdf_name, mt.pdf_drive_link, mt.page, mt.comment, coalesce(st.category, '') as category, mt.reviewer as author, mt.created_date, mt.last_modified, case when st.row_no is null then '' else 'Yes' end as resolved,
 case when st.row_no is null then '' else 'seen' end as replies, mt.comment_id, coalesce(nullif(trim(mt.annotation_type), ''), case when st.row_no is null then '' else 'Note' end) as annotation_type, match, mt.stored_id
from mt left join st on st.row_no = mt.stored_id"""
)
def q19_merged_rows(spark: SparkSession, d: str) -> DataFrame:
    stored = _stored_output(spark, d)
    return output.merge_fields(output.match_output(_visible(spark, d), stored), stored).select(*output.VISIBLE, "match", "stored_id")


_ISSUES = """iss as (select source_file, array_to_string(list_filter([case when coalesce(trim(reviewer), '') = '' then 'REVIEWER_UNRESOLVED' end, case when coalesce(trim(book_page), '') = '' then 'PAGE_UNRESOLVED' end,
 case when trim(footer_status) = 'footer_mismatch' then 'PAGE_NUMBER_MISMATCH' end], lambda x: x is not null), '; ') as issue_type, coalesce(raw_author, '') as raw_author, pdf_page,
 coalesce(nullif(trim(footer_page_candidate), ''), book_page, '') as book_page_candidate, coalesce(comment, '') as comment
 from (select distinct * from annotations) where coalesce(trim(reviewer), '') = '' or coalesce(trim(book_page), '') = '' or trim(footer_status) = 'footer_mismatch')"""


@query(
    f"""with {_ISSUES}, old as (select distinct source_file, pdf_page, coalesce(comment, '') as comment from annotations where relation_type = 'ROOT')
select i.* from iss i where not exists (select 1 from old o where o.source_file = i.source_file and o.pdf_page = i.pdf_page and o.comment = i.comment)"""
)
def q20_needs_review(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "annotations").distinct()
    stored = a.where("relation_type = 'ROOT'").select("source_file", "pdf_page", S.text(F.col("comment")).alias("comment"))
    return output.new_issues(output.review_issues(a), stored)


def _processed(spark: SparkSession, d: str) -> DataFrame:
    """Each file's last run with the summary of its annotations, against an edition of 60 pages."""
    files = registry.latest_per_key(table(spark, d, "files"), "drive_file_id", "file_log_id")
    s = _summary(table(spark, d, "annotations").distinct()).withColumnRenamed("source_sha256", "pdf_sha256").drop("entries_found")
    rows = files.drop("reviewer").join(s, "pdf_sha256", "left").withColumns(
        {"pages_unresolved": F.size("pages_unresolved"), "footer_mismatches": F.size("footer_mismatches"), "pages_mapped": F.greatest(F.col("pages") - F.coalesce(F.size("pages_unresolved"), F.lit(0)), F.lit(0)), "reviewers": F.coalesce("reviewers", F.array().cast("array<string>"))}
    )
    edition = spark.createDataFrame([("sha256:0123456789ab", 60)], "version string, expected_pages int")
    return summaries.master_compatibility(rows, edition)


_PROCESSED = f"""s as ({_SUMMARY}{_ONE_ANNOTATION} group by 1), n as (select source_sha256, count(distinct pdf_page) filter (where {stripped('book_page')} = '') as unresolved, count(distinct pdf_page) filter (where footer_status = 'footer_mismatch') as footers from {_ONE_ANNOTATION} group by 1),
r as (select l.*, n.unresolved, n.footers, coalesce(s.reviewers, '') as rev, s.skipped, greatest(pages - coalesce(n.unresolved, 0), 0) as mapped, coalesce(pages, 0) > 0 and coalesce(greatest(pages - coalesce(n.unresolved, 0), 0), 0) / pages < 0.8 as suspect,
 case when coalesce(pages, 0) > 0 then coalesce(greatest(pages - coalesce(n.unresolved, 0), 0), 0) / pages else 0 end as share
 from {_LATEST_FILE} l left join s on s.source_sha256 = l.pdf_sha256 left join n on n.source_sha256 = l.pdf_sha256)"""


@query(
    f"""with {_PROCESSED}
select drive_file_id as file, 'PDF_PROCESSING_ERROR' as code, 'ERROR' as severity, true as pm_actionable, coalesce(nullif(message_error, ''), 'PDF processing failed.') as message from r where status = 'ERROR'
union all select drive_file_id, 'PDF_PROCESSED', 'INFO', false, drive_file_id || ' processed successfully; reviewer=' || coalesce(nullif(rev, ''), 'unresolved') || '; new=' || coalesce(new_count, 0) || '; updated=' || coalesce(updated_count, 0) || '; unchanged=' || coalesce(unchanged_count, 0) || '.' from r where status <> 'ERROR'
union all select drive_file_id, 'REVIEWER_UNRESOLVED', 'WARNING', true, 'Reviewer could not be resolved. Manual reviewer assignment may be required.' from r where status <> 'ERROR' and rev = ''
union all select drive_file_id, 'PAGE_MAPPING_UNRESOLVED', 'WARNING', true, unresolved || ' page(s) could not be mapped automatically.' from r where status <> 'ERROR' and unresolved > 0
union all select drive_file_id, 'PAGE_NUMBER_MISMATCH', 'WARNING', false, footers || ' page-number mismatch(es) detected.' from r where status <> 'ERROR' and footers > 0
union all select drive_file_id, 'MASTER_INDEX_MISMATCH', 'WARNING', false, 'Possible master-index mismatch detected; coverage=' || printf('%.1f', round_even(share, 4) * 100) || '%; master=sha256:0123456789ab.' from r where status <> 'ERROR' and suspect
union all select drive_file_id, 'PAGES_BEYOND_MASTER', 'INFO', false, (pages - 60) || ' page(s) exceed the current master page count.' from r where status <> 'ERROR' and pages > 60
union all select drive_file_id, 'NEEDS_REVIEW', 'WARNING', true, unresolved || ' annotation(s) require manual review.' from r where status <> 'ERROR' and unresolved > 0"""
)
def q21_alerts(spark: SparkSession, d: str) -> DataFrame:
    results = _processed(spark, d).select(
        F.col("drive_file_id").alias("file"), "status", F.col("message_error").alias("error"), F.array_join("reviewers", ", ").alias("reviewers"), F.col("new_count").alias("inserted"), F.col("updated_count").alias("updated"), F.col("unchanged_count").alias("unchanged"),
        "pages_unresolved", "footer_mismatches", F.col("master_mismatch_suspected").alias("master_suspect"), F.col("mapping_coverage").alias("coverage"), "master_index_version", "pages_beyond_master", F.col("pages_unresolved").alias("needs_review"),
    )
    return alerts.classify_results(results).select("file", "code", "severity", "pm_actionable", "message")


@query(
    """select entry_id, coalesce(trim(comment), '') <> '' or lower(trim(annotation_type)) in ('highlight', 'ink') as keep,
 case when coalesce(trim(comment), '') <> '' or lower(trim(annotation_type)) in ('highlight', 'ink') then '' else 'empty_' || lower(trim(annotation_type)) end as reason from annotations"""
)
def q22_should_import(spark: SparkSession, d: str) -> DataFrame:
    keep, reason = S.should_import(F.col("annotation_type"), F.col("comment"), {"Highlight": "keep", "Ink": "keep", "default": "skip"})
    return table(spark, d, "annotations").select("entry_id", keep.alias("keep"), reason.alias("reason"))


_PDF = r"^D:(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(?:(Z).*|([+-]\d{2})''?(\d{2})''?)?$"


@query(
    rf"""select entry_id, case when not regexp_matches(t, '{_PDF}') then t when contains(t, 'Z') then regexp_replace(t, '{_PDF}', '\1-\2-\3T\4:\5:\6') || '+00:00'
 when regexp_matches(t, '[+-]') then regexp_replace(t, '{_PDF}', '\1-\2-\3T\4:\5:\6\8:\9') else regexp_replace(t, '{_PDF}', '\1-\2-\3T\4:\5:\6') end as iso
from (select entry_id, coalesce(trim(created), '') as t from annotations)"""
)
def q23_pdf_date(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").select("entry_id", S.pdf_date(F.col("created")).alias("iso"))


@query(r"select distinct pdf_name, regexp_replace(replace(upper(trim(pdf_name)), '-', '_'), '\s+', '_', 'g') as document_key from files where pdf_name is not null")
def q24_document_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "files").where("pdf_name is not null").select("pdf_name", S.document_key(F.col("pdf_name")).alias("document_key")).distinct()


@query(r"select distinct document_key, source_sha256, case when trim(document_key) <> '' and length(trim(source_sha256)) = 64 then regexp_replace(replace(upper(trim(document_key)), '-', '_'), '\s+', '_', 'g') || '@' || lower(trim(source_sha256)) end as version_id from annotations")
def q25_version_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").select("document_key", "source_sha256", S.version_id(F.col("document_key"), F.col("source_sha256")).alias("version_id")).distinct()


@query(
    """with k as (select distinct replace(upper(trim(document_key)), '-', '_') as d, lower(trim(pdf_sha256)) as h from versions)
select f.file_log_id, f.pdf_sha256, case when k.h is not null then 'DUPLICATE' else 'NEW_VERSION' end as decision
from (select distinct file_log_id, pdf_sha256, regexp_extract(pdf_name, '^([A-Z]+_[A-Z]+_[0-9A-Z]+_[0-9]+|HARBOUR_READER_CORE)', 1) as document_key from files) f
left join k on k.d = f.document_key and k.h = lower(trim(f.pdf_sha256))"""
)
def q26_classify_version(spark: SparkSession, d: str) -> DataFrame:
    key = F.regexp_extract("pdf_name", "^([A-Z]+_[A-Z]+_[0-9A-Z]+_[0-9]+|HARBOUR_READER_CORE)", 1)
    incoming = table(spark, d, "files").select("file_log_id", "pdf_sha256", key.alias("document_key")).distinct()
    return registry.classify_versions(incoming, table(spark, d, "versions")).select("file_log_id", "pdf_sha256", "decision")


@query("""select entry_id, case when coalesce(parent_xref, 0) = 0 then 'ROOT' when lower(ltrim(trim(relation_raw), '/')) = 'group' then 'GROUP' else 'REPLY' end as relation from annotations""")
def q27_relation_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").select("entry_id", S.relation_type(F.col("parent_xref"), F.col("relation_raw")).alias("relation"))


@query(
    """with b as (select distinct source_sha256, pdf_page, entry_id, rect_x0 as x0, rect_y0 as y0, rect_x1 as x1, rect_y1 as y1 from annotations where rect_x1 > rect_x0 and rect_y1 > rect_y0)
select a.source_sha256, a.pdf_page, a.entry_id as id_a, b.entry_id as id_b, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) / ((b.x1 - b.x0) * (b.y1 - b.y0)) as ratio
from b a join b on a.source_sha256 = b.source_sha256 and a.pdf_page = b.pdf_page
where least(a.x1, b.x1) > greatest(a.x0, b.x0) and least(a.y1, b.y1) > greatest(a.y0, b.y0)
 and (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) / ((b.x1 - b.x0) * (b.y1 - b.y0)) >= 0.2"""
)
def q28_box_overlap(spark: SparkSession, d: str) -> DataFrame:
    box = ("rect_x0", "rect_y0", "rect_x1", "rect_y1")
    rows = table(spark, d, "annotations").select("source_sha256", "pdf_page", "entry_id", *box).distinct()
    return pages.box_overlaps(rows, rows, ["source_sha256", "pdf_page"], box, "entry_id", "entry_id")


@query(
    f"""with {_PROCESSED}
select file_log_id, array_to_string(list_filter([case when mapped is not null then mapped || '/' || coalesce(pages, 0) || ' pages mapped' end, case when skipped > 0 then skipped || ' empty annotations skipped' end,
 case when unresolved > 0 then unresolved || ' unresolved pages' end, case when footers > 0 then footers || ' footer mismatches' end, case when pages > 60 then (pages - 60) || ' pages beyond master' end,
 case when suspect then 'possible master-index mismatch' end, 'master=sha256:0123456789ab', nullif(message_error, '')], lambda x: x is not null), '; ') as message,
 rev as reviewer, coalesce(pages, 0) as pages, coalesce(skipped, 0)::int as skipped_empty, coalesce(new_count, 0) as new_count from r"""
)
def q29_registry_message(spark: SparkSession, d: str) -> DataFrame:
    rows = _processed(spark, d).withColumns({"error": F.col("message_error"), "file_id": F.col("drive_file_id"), "name": F.col("pdf_name"), "link": F.col("drive_link"), "sha256": F.col("pdf_sha256"), "inserted": F.col("new_count"), "updated": F.col("updated_count"), "unchanged": F.col("unchanged_count")})
    made = registry.registry_rows(rows, "2026-01-01T00:00:00Z").select("drive_file_id", F.col("message_error").alias("message"), "reviewer", "pages", "skipped_empty", "new_count")
    return rows.select("drive_file_id", "file_log_id").join(made, "drive_file_id").drop("drive_file_id")


#: Headers of the known layouts, by the column that differs.
_HEADERS = {
    "MIGRATED_ANNOTATION_TYPE_E": (*output.HEADER[:4], "Annotation Type", *output.HEADER[5:11]),
    "MIGRATED_ELEVEN_COLUMNS": (*output.HEADER[:4], *output.HEADER[5:11], "Type"),
    "MIGRATED_TYPE_HEADER": (*output.HEADER[:4], "", *output.HEADER[5:11], "Type"),
}


@query(
    f"""with {_VISIBLE} select 'MIGRATED_ANNOTATION_TYPE_E' as layout, comment_id, pdf_name, page, '' as category, author, annotation_type from vis
union all select 'MIGRATED_ELEVEN_COLUMNS', comment_id, pdf_name, page, '', author, annotation_type from vis union all select 'MIGRATED_TYPE_HEADER', comment_id, pdf_name, page, category, author, annotation_type from vis"""
)
def q30_layout_migration(spark: SparkSession, d: str) -> DataFrame:
    rows = _visible(spark, d)
    old = {
        "MIGRATED_ANNOTATION_TYPE_E": [*output.VISIBLE[:4], "annotation_type", *output.VISIBLE[5:11]],
        "MIGRATED_ELEVEN_COLUMNS": [c for c in output.VISIBLE if c != "category"],
        "MIGRATED_TYPE_HEADER": list(output.VISIBLE),
    }
    made = [
        output.migrate_layout(rows.select(F.array(*cells).alias("cells")), _HEADERS[name]).select(F.lit(output.layout_of(_HEADERS[name])[0]).alias("layout"), "comment_id", "pdf_name", "page", "category", "author", "annotation_type")
        for name, cells in old.items()
    ]
    return union_all(made)


@query(
    """select distinct entry_id, case when not regexp_matches(translate(coalesce(trim(book_page), ''), '٠١٢٣٤٥٦٧٨٩', '0123456789'), '^\\d{1,9}$') or try_cast(translate(footer_page_candidate, '٠١٢٣٤٥٦٧٨٩', '0123456789') as int) is null then ''
 when try_cast(translate(footer_page_candidate, '٠١٢٣٤٥٦٧٨٩', '0123456789') as int) = cast(translate(trim(book_page), '٠١٢٣٤٥٦٧٨٩', '0123456789') as int) then 'footer_verified' else 'footer_mismatch' end as footer from annotations""".replace("\\\\d", r"\d")
)
def q31_footer_check(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").select("entry_id", S.footer_status(F.col("book_page"), F.array("footer_page_candidate")).alias("footer")).distinct()


_ALIASES = {"ftamhold": "François Tamhold", "edehaskerin": "Ekaterina De Haskerin", "greyharbour": "Greyharbour Review Department", "slp": "Stonewater Learning Partners"}
_NAME_CASES = " ".join(f"when lower({ws('raw_author')}) = '{a}' then '{n}'" for a, n in sorted(_ALIASES.items()))
_FILE_CASES = " ".join(f"when contains(' ' || lower(w) || ' ', ' {a} ') then '{n}'" for a, n in _ALIASES.items())
_STEM = r"regexp_replace(regexp_replace(coalesce(source_file, ''), '\.[^.]*$', ''), '[_.()\\-]+', ' ', 'g')"
_FILE_WORDS = ", ".join(f"'{w}'" for w in (*S.FILE_WORDS, *S.GENERIC_AUTHORS))


@query(
    rf"""select distinct raw_author, source_file, case {_NAME_CASES} when len(p) >= 2 and not {_GENERIC} and len(list_filter(p[1:4], lambda x: not regexp_matches(x, '\p{{L}}'))) = 0 then {ws('raw_author')} {_FILE_CASES}
 when len(kept) between 2 and 4 and len(list_filter(kept, lambda x: not regexp_matches(x, '\p{{L}}'))) = 0 then array_to_string(kept, ' ') else '' end as reviewer_name
from (select *, list_filter(string_split(w, ' '), lambda x: lower(x) not in ({_FILE_WORDS}) and not regexp_full_match(x, '[0-9]*')) as kept
 from (select raw_author, source_file, string_split({ws('raw_author')}, ' ') as p, {ws(_STEM)} as w from annotations))"""
)
def q32_reviewer_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").select("raw_author", "source_file", S.reviewer_name(F.col("raw_author"), F.col("source_file"), _ALIASES).alias("reviewer_name")).distinct()


@query(
    f"""with {_PLAN.split("plan as")[0].rstrip().rstrip(',')} select coalesce(c.document_key || '::' || c.entry_id, p.document_key || '::' || p.entry_id) as entry_key,
 case when p.entry_id is null then 'inserted' when c.entry_id is null then 'kept' when c.raw_author is distinct from p.raw_author then 'updated' else 'unchanged' end as action,
 case when c.entry_id is not null then c.raw_author else p.raw_author end as raw_author from cur c full join sto p on c.document_key = p.document_key and c.entry_id = p.entry_id"""
)
def q33_ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat_ws("::", "document_key", "entry_id").alias("entry_key")
    return changes.ledger_upsert(_current(spark, d).select(key, "raw_author"), _stored(spark, d).select(key, "raw_author"), "entry_key", ["raw_author"])


_VERSION_ROWS = """select version_id, count(*) as entries_found, count(*) filter (where relation_type <> 'REPLY') as root_comments, count(*) filter (where relation_type = 'REPLY') as replies,
 count(*) filter (where coalesce(author_status, '') <> 'RESOLVED') as unresolved_authors, coalesce(array_to_string(list_sort(list(distinct trim(raw_author)) filter (where trim(raw_author) <> '')), ', '), '') as authors_found,
 case when count(*) filter (where coalesce(author_status, '') <> 'RESOLVED') > 0 then 'NEEDS_AUTHOR_REVIEW' else 'PROCESSED' end as version_status from (select distinct * from entries) group by 1"""


@query(_VERSION_ROWS)
def q34_version_status(spark: SparkSession, d: str) -> DataFrame:
    return registry.version_rows(_entries(spark, d), ["version_id"])


@query(
    """select document_key, versions, v.version_id as current_version_id, v.drive_file_id as current_drive_file_id, v.pdf_sha256 as current_pdf_sha256, v.modified_time as current_modified_time, v.version_status as status
from (select document_key, count(distinct version_id) as versions, max(struct_pack(modified_time := modified_time, version_id := version_id, drive_file_id := drive_file_id, pdf_sha256 := pdf_sha256, version_status := version_status)) as v from versions group by 1)"""
)
def q34b_document_rows(spark: SparkSession, d: str) -> DataFrame:
    return registry.document_rows(table(spark, d, "versions"))


@query(
    """select entry_id, coalesce(nullif(trim(annotation_id), ''), 'fallback:' || coalesce(fallback_fingerprint, '')) as computed_id,
 case when trim(annotation_id) <> '' then sha256('native|' || coalesce(reviewer, '') || '|' || coalesce(book_page, '') || '|' || trim(annotation_id)) else sha256('fallback|' || coalesce(fallback_fingerprint, '')) end as computed_identity from annotations"""
)
def q35_identity_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").select(
        "entry_id", S.entry_id(F.col("annotation_id"), F.col("fallback_fingerprint")).alias("computed_id"),
        S.identity_key(F.col("reviewer"), F.col("book_page"), F.col("annotation_id"), F.col("fallback_fingerprint")).alias("computed_identity"),
    )


@query("select upper(trim(coalesce(version_id, ''))) as version_key, case when upper(trim(version_id)) in (select upper(trim(version_id)) from entries) then 'EXISTING' else 'INSERT' end as write from (select distinct version_id from versions)")
def q36_registry_upsert(spark: SparkSession, d: str) -> DataFrame:
    key = lambda name: table(spark, d, name).select(F.upper(S.strip(F.col("version_id"))).alias("version_key")).distinct()
    return registry.upsert_plan(table(spark, d, "versions").select("version_id").distinct().select(F.upper(S.strip(F.col("version_id"))).alias("version_key")), key("entries"), "version_key", update=False)


