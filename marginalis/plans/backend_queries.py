"""Queries of the flat annotation table and of summaries, each with its SQL
oracle.  Every query runs over its whole tables; stored tables that aren't
among them are derived from them, by the same rule in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import database, output, pages, summaries
from ..session import table
from .reference_queries import _MASTER, _ONE_ANNOTATION, _pages, stripped, ws

QUERIES, ORACLES = {}, {}
_NOW, _BEFORE = "2026-01-01T00:00:00Z", "2025-01-01T00:00:00Z"


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, oracle
        return f

    return add


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotations").distinct()


def _flat(rows: DataFrame, now: str) -> DataFrame:
    return database.database_rows(output.first_per_key(rows, ["identity_key"], ["ord"]), F.lit("file"), F.lit("link"), F.lit(now))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """A stored flat table: the roots, those behind page 10 with another comment."""
    roots = _annotations(spark, d).where("relation_type = 'ROOT'")
    return _flat(roots, _BEFORE).withColumn("comment", F.when(F.col("pdf_page").cast("int") > 10, F.concat("comment", F.lit(" (old)"))).otherwise(F.col("comment")))


_STATE = f"case when {stripped('reviewer')} = '' or {stripped('book_page')} = '' or {stripped('footer_status')} = 'footer_mismatch' then 'NEEDS_REVIEW' else 'CURRENT' end"


def _first(where: str) -> str:
    """The first annotation of each key, of rows equal in ord that which comes first by its columns."""
    return f"""(select * from (select *, row_number() over (partition by identity_key order by ord, schema_version, document_key, desk_id, source_file, source_sha256, reviewer, raw_author, pdf_page, book_page, mapping_method, mapping_confidence, annotation_type, comment) as rn
 from {_ONE_ANNOTATION} where {where}) where rn = 1)"""


_COORDINATES = "concat_ws(',', coalesce(cast(rect_x0 as varchar), ''), coalesce(cast(rect_y0 as varchar), ''), coalesce(cast(rect_x1 as varchar), ''), coalesce(cast(rect_y1 as varchar), ''))"


@query(
    f"""select identity_key as annotation_key, coalesce(reviewer, '') as reviewer, coalesce(source_file, '') as pdf_name, coalesce(cast(pdf_page as varchar), '') as pdf_page, coalesce(comment, '') as comment,
 coalesce(created, '') as created_date, coalesce(cast(reply_to_xref as varchar), '') as reply_to, {_STATE} as source_state, 'true' as active, '' as category from {_first('true')}"""
)
def q37_database_rows(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_annotations(spark, d), _NOW).select("annotation_key", "reviewer", "pdf_name", "pdf_page", "comment", "created_date", "reply_to", "source_state", "active", "category")


_ACTIONS = f"""new as (select *, coalesce(comment, '') as c from {_first('coalesce(import_candidate, true)')}),
old as (select *, case when pdf_page > 10 then coalesce(comment, '') || ' (old)' else coalesce(comment, '') end as c from {_first("relation_type = 'ROOT'")}),
act as (select coalesce(n.identity_key, o.identity_key) as annotation_key, case when o.identity_key is null then 'inserted' when n.identity_key is null then 'kept'
 when n.c <> o.c then 'updated' else 'unchanged' end as action from new n full join old o on n.identity_key = o.identity_key)"""


def _upsert(spark: SparkSession, d: str) -> database.Upsert:
    return database.upsert_database(_annotations(spark, d), _stored(spark, d), F.lit("file"), F.lit("link"), _NOW)


@query(
    f"""with {_ACTIONS} select annotation_key, action, case when action = 'inserted' then '{_NOW}' else '{_BEFORE}' end as first_seen, case when action in ('inserted', 'updated') then '{_NOW}' else '{_BEFORE}' end as last_seen from act"""
)
def q38_database_upsert(spark: SparkSession, d: str) -> DataFrame:
    done = _upsert(spark, d)
    return done.actions.join(done.table.select("annotation_key", "first_seen", "last_seen"), "annotation_key")


@query(
    f"""with {_ACTIONS}, a as (select * from {_ONE_ANNOTATION})
select (select count(*) from act where action = 'inserted') as inserted, (select count(*) from act where action = 'updated') as updated,
 (select count(*) from act where action = 'unchanged') + (select count(*) from a where coalesce(import_candidate, true)) - (select count(*) from new) as unchanged,
 (select count(*) from a where not coalesce(import_candidate, true)) as skipped, (select count(*) from new where {_STATE} = 'NEEDS_REVIEW') as needs_review"""
)
def q38b_sync_stats(spark: SparkSession, d: str) -> DataFrame:
    return _upsert(spark, d).stats


@query(
    f"""select '{_NOW}' as logged_at, 'file' as drive_file_id, coalesce(source_file, '') as source_file, issue as issue_type, coalesce(reviewer, '') as reviewer, coalesce(raw_author, '') as raw_author, coalesce(cast(pdf_page as varchar), '') as pdf_page,
 coalesce(nullif({stripped('footer_page_candidate')}, ''), book_page, '') as page_candidate, coalesce(comment, '') as comment, issue as details, 'OPEN' as status, '' as notes
from (select *, array_to_string(list_filter([case when {stripped('reviewer')} = '' then 'REVIEWER_UNRESOLVED' end, case when {stripped('book_page')} = '' then 'PAGE_UNRESOLVED' end,
 case when {stripped('footer_status')} = 'footer_mismatch' then 'PAGE_NUMBER_MISMATCH' end], lambda x: x is not null), '; ') as issue from {_ONE_ANNOTATION}) where issue <> ''"""
)
def q39_needs_review_rows(spark: SparkSession, d: str) -> DataFrame:
    return database.needs_review_rows(_annotations(spark, d), F.lit("file"), F.lit(_NOW))


#: Two reviewers' tables go by another name.
_TABS = {"Ekaterina": "tab e", "Review": "tab r"}


def _reconciled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The flat table against reviewers' tables that have its roots, every one by its id."""
    flat = _flat(_annotations(spark, d), _NOW)
    roots = database.eligible_database(_stored(spark, d))
    stored = roots.withColumns({"tab": database.tab_of(F.col("reviewer"), _TABS), "row_no": F.concat("reviewer", F.lit("|"), "comment_id"), "resolved": F.lit("Yes"), "category": F.lit("Seen")})
    return (flat, *database.reconcile(flat, stored, _TABS))


_ELIGIBLE = f"""select * from (select *, row_number() over (partition by rv, cid order by identity_key) as k from (
 select {stripped('reviewer')} as rv, coalesce(nullif({stripped('annotation_id')}, ''), {stripped('identity_key')}) as cid, identity_key, coalesce(comment, '') as comment, pdf_page, coalesce(book_page, '') as page, coalesce(annotation_type, '') as annotation_type, coalesce(source_file, '') as pdf_name,
  coalesce(created, '') as created, coalesce(modified, '') as modified from @rows where {_STATE} = 'CURRENT')) where k = 1 and cid <> ''"""
_RECONCILED = f"""want as ({_ELIGIBLE.replace('@rows', _first('true'))}), have as ({_ELIGIBLE.replace('@rows', _first("relation_type = 'ROOT'"))}),
rec as (select w.rv as tab, w.cid as comment_id, h.cid is not null as found, w.comment, h.cid is not null and w.comment = case when h.pdf_page > 10 then h.comment || ' (old)' else h.comment end
 and w.page = h.page and w.pdf_name = h.pdf_name and w.created = h.created and w.modified = h.modified and coalesce(nullif(w.annotation_type, ''), h.annotation_type) = h.annotation_type as same
 from want w left join have h on h.rv = w.rv and h.cid = w.cid)"""


@query(
    f"""with {_RECONCILED} select tab, comment_id, comment, case when found then 'Yes' else '' end as resolved, case when found then 'Seen' else '' end as category,
 case when not found then 'INSERT' when same then 'UNCHANGED' else 'UPDATE' end as write from rec"""
)
def q40_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return _reconciled(spark, d)[1].select("tab", "comment_id", "comment", "resolved", "category", "write")


@query(
    f"""with {_RECONCILED} select tab, tab as reviewer, count(*) as eligible, count(*) filter (where not found) as inserted, count(*) filter (where found and not same) as updated, count(*) filter (where found and same) as unchanged from rec group by 1"""
)
def q40b_reconcile_tabs(spark: SparkSession, d: str) -> DataFrame:
    return _reconciled(spark, d)[2]


@query(
    f"""with {_RECONCILED}, f as (select count(*) as n from {_first('true')}) select f.n::bigint as database_records, count(*) as eligible_records, count(*) filter (where not found) as inserted, count(*) filter (where found and not same) as updated,
 count(*) filter (where found and same) as unchanged, count(distinct tab) as reviewers, f.n - count(*) as skipped_records from rec, f group by f.n"""
)
def q40c_reconcile_totals(spark: SparkSession, d: str) -> DataFrame:
    flat, _, stats = _reconciled(spark, d)
    return database.reconcile_totals(flat, stats)


@query(
    f"""with {_MASTER.split('p as (')[0].rstrip().rstrip(',').replace("arg_max(coalesce(book_page, ''), (pdf_page, coalesce(book_page, ''))) as book_page", "max((pdf_page, coalesce(book_page, ''))) as x")}
select 'sha256:' || left(sha256('edition'), 12) as version, coalesce(max(case when x[1] between 0 and 999999999 then x[1] end), 0) as expected_pages, count(*) as fingerprint_count from m"""
)
def q41_master_metadata(spark: SparkSession, d: str) -> DataFrame:
    rows = _pages(spark, d)
    index = pages.master_index(rows.where("trim(book_page) <> ''"), "text", "pdf_page", "book_page")
    return summaries.master_metadata(index, F.sha2(F.lit("edition"), 256)).drop("sha256")


@query(f"select {stripped('reviewer')} as reviewer, count(*) as rows, count(distinct {ws('comment')}) as comments from {_ONE_ANNOTATION} where {_STATE} = 'CURRENT' group by 1")
def q42_rows_by_reviewer(spark: SparkSession, d: str) -> DataFrame:
    rows = output.eligible_rows(_annotations(spark, d))
    return rows.groupBy(S.strip(F.col("reviewer")).alias("reviewer")).agg(F.count("*").alias("rows"), F.countDistinct(S.collapse(F.col("comment"))).alias("comments"))
