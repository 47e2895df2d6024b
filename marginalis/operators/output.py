"""Tables that reviewers see: projections, two-phase upsert, field merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

# Columns of a reviewer's table, in order.
VISIBLE = ("pdf_name", "pdf_drive_link", "page", "comment", "category", "author", "created_date", "last_modified", "resolved", "replies", "comment_id", "annotation_type")


def needs_review(reviewer: Column, book_page: Column, footer_status: Column) -> Column:
    return (S.strip(reviewer) == "") | (S.strip(book_page) == "") | (S.strip(footer_status) == "footer_mismatch")


def source_state(reviewer: Column, book_page: Column, footer_status: Column) -> Column:
    return F.when(needs_review(reviewer, book_page, footer_status), "NEEDS_REVIEW").otherwise("CURRENT")


def issue_text(reviewer: Column, book_page: Column, footer_status: Column) -> Column:
    """What a person must look at, joined by '; '."""
    found = F.concat_ws(
        "; ",
        F.when(S.strip(reviewer) == "", "REVIEWER_UNRESOLVED"),
        F.when(S.strip(book_page) == "", "PAGE_UNRESOLVED"),
        F.when(S.strip(footer_status) == "footer_mismatch", "PAGE_NUMBER_MISMATCH"),
    )
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("REVIEW_REQUIRED"))


def visible_rows(annotations: DataFrame, link: Column) -> DataFrame:
    """The reviewer's view of annotations; the id is the native one, else the
    identity key."""
    empty = F.lit("")
    return annotations.select(
        "reviewer", "ord",
        S.text(F.col("source_file")).alias("pdf_name"), S.text(link).alias("pdf_drive_link"), S.text(F.col("book_page")).alias("page"), S.text(F.col("comment")).alias("comment"),
        empty.alias("category"), S.text(F.col("reviewer")).alias("author"), S.text(F.col("created")).alias("created_date"), S.text(F.col("modified")).alias("last_modified"),
        empty.alias("resolved"), empty.alias("replies"), F.coalesce(S.blank_null(F.col("annotation_id")), S.text(F.col("identity_key"))).alias("comment_id"), S.text(F.col("annotation_type")).alias("annotation_type"),
    )


def eligible_rows(annotations: DataFrame) -> DataFrame:
    """Annotations with a reviewer that need no review."""
    return annotations.where(~needs_review(F.col("reviewer"), F.col("book_page"), F.col("footer_status")))


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in encounter order, by one aggregation; rows
    equal in ``order`` go by their values."""
    rest = [c for c in rows.columns if c not in order]
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(F.struct(*order, *rest)).alias("r")).select("r.*").select(*rows.columns)


def match_output(desired: DataFrame, stored: DataFrame) -> DataFrame:
    """Match desired rows of a reviewer's table with stored ones.

    By comment id first.  Desired rows left over match by (page, comment),
    white space evened out, if exactly one stored row that no id has claimed
    has that key; the first desired row in ``ord``, comment id and reviewer takes
    it, further ones are appended.  Adds match (ID, KEY, NONE or AMBIGUOUS, for several stored
    candidates) and stored_id, the stored row's ``row_no``.
    """
    key = F.concat_ws("\x1f", S.collapse(F.col("page")), S.collapse(F.col("comment")))
    d = desired.withColumn("_key", key)
    s = stored.select("row_no", F.col("comment_id").alias("_sid"), key.alias("_skey"))
    by_id = s.where(S.strip(F.col("_sid")) != "").groupBy("_sid").agg(F.min("row_no").alias("_row"))
    first = d.join(by_id, F.col("comment_id") == F.col("_sid"), "left").drop("_sid")
    claimed = by_id.join(d.select(F.col("comment_id").alias("_sid")).distinct(), "_sid", "left_semi").select(F.col("_row").alias("row_no"))
    free = s.join(claimed, "row_no", "left_anti").groupBy("_skey").agg(F.min("row_no").alias("_free"), F.count("*").alias("_n"))
    rest = first.join(free, F.col("_key") == F.col("_skey"), "left")
    open_ = F.col("_row").isNull() & F.col("_free").isNotNull()
    turn = F.row_number().over(Window.partitionBy(F.when(open_, F.col("_key")).otherwise(F.concat(F.lit("\x1e"), F.col("comment_id")))).orderBy("ord", "comment_id", *[c for c in desired.columns if c == "reviewer"]))
    matched = rest.withColumn("_turn", turn)
    return matched.select(
        *desired.columns,
        F.when(F.col("_row").isNotNull(), "ID").when(open_ & (F.col("_n") > 1), "AMBIGUOUS").when(open_ & (F.col("_turn") == 1), "KEY").otherwise("NONE").alias("match"),
        F.coalesce("_row", F.when(open_ & (F.col("_n") == 1) & (F.col("_turn") == 1), F.col("_free"))).alias("stored_id"),
    )


def merge_fields(matched: DataFrame, stored: DataFrame, keep_columns: list[str] | None = None) -> DataFrame:
    """Rows to write, with ``keep_columns`` of the desired ones: resolved and replies always from the stored row, category
    and annotation type from it where the desired one is blank."""
    s = stored.select(F.col("row_no").alias("stored_id"), *[F.col(c).alias(f"s_{c}") for c in ("category", "resolved", "replies", "annotation_type")])
    j = matched.join(s, "stored_id", "left")
    keep = lambda c: F.coalesce(S.blank_null(F.col(c)), S.text(F.col(f"s_{c}")))
    values = {"resolved": S.text(F.col("s_resolved")), "replies": S.text(F.col("s_replies")), "category": keep("category"), "annotation_type": keep("annotation_type")}
    return j.select("stored_id", "match", *(keep_columns or []), *[values.get(c, F.col(c)).alias(c) for c in VISIBLE])


def review_issues(annotations: DataFrame) -> DataFrame:
    """Annotations that need review, with their issues joined by '; '; the
    printed page goes before the mapped one."""
    state = [F.col(c) for c in ("reviewer", "book_page", "footer_status")]
    return annotations.where(needs_review(*state)).select(
        "source_file", issue_text(*state).alias("issue_type"), S.text(F.col("raw_author")).alias("raw_author"), "pdf_page",
        F.coalesce(S.blank_null(F.col("footer_page_candidate")), S.text(F.col("book_page"))).alias("book_page_candidate"), S.text(F.col("comment")).alias("comment"),
    )


def new_issues(issues: DataFrame, stored: DataFrame, keys: tuple[str, str, str] = ("source_file", "pdf_page", "comment")) -> DataFrame:
    """Issues whose three-part key isn't stored; rows within the batch stay."""
    return issues.join(stored.select(*keys).distinct(), list(keys), "left_anti").select(*issues.columns)


# What a reviewer's table is headed by.
HEADER = ("PDF Name", "PDF Drive Link", "Page", "Comment", "Category", "Author", "Created Date", "Last Modified", "Resolved?", "Replies", "Comment ID", "Annotation Type")

#: A known layout: its name, what its header says at which place (None: it is
#: blank), and for each column of the current one the place in the old row, or
#: None for a new column.
Layout = tuple[str, dict[int, str | None], tuple[int | None, ...]]

_SAME = tuple(range(12))

# Layouts that such tables had, in the order in which they are tried.
LAYOUTS: tuple[Layout, ...] = (
    ("CANONICAL", dict(enumerate(HEADER)), _SAME),
    ("MIGRATED_ANNOTATION_TYPE_E", {4: "Annotation Type", 5: "Author", 10: "Comment ID", 11: None}, (0, 1, 2, 3, None, 5, 6, 7, 8, 9, 10, 4)),
    ("MIGRATED_CATEGORY_TYPE_HEADER", {4: "Type", 5: "Author", 10: "Comment ID", 11: None}, _SAME),
    ("MIGRATED_CATEGORY_BLANK_HEADER", {4: None, 5: "Author", 10: "Comment ID", 11: None}, _SAME),
    ("MIGRATED_ELEVEN_COLUMNS", {4: "Author", 9: "Comment ID", 10: "Type"}, (0, 1, 2, 3, None, 4, 5, 6, 7, 8, 9, 10)),
    ("MIGRATED_TYPE_HEADER", {4: None, 5: "Author", 10: "Comment ID", 11: "Type"}, _SAME),
)


def layout_of(header: tuple[str, ...], layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout a header belongs to; its first four names are always those
    of the current one.  Fails for an unknown one."""
    cells = [str(c or "") for c in header] + [""] * 12
    for layout in layouts:
        says = dict(enumerate(HEADER[:4])) | layout[1]
        if all(cells[i] == name if name else not cells[i].strip() for i, name in says.items()):
            return layout
    raise ValueError(f"unknown table layout: {header}")


def migrate_layout(rows: DataFrame, header: tuple[str, ...], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Rows of any known layout in the current one.  ``rows`` has one array
    column ``cells``; short rows count as padded, an unknown header fails."""
    order = layout_of(header, layouts)[2]
    return rows.select(*[(F.lit("") if i is None else F.coalesce(F.get("cells", F.lit(i)), F.lit(""))).alias(c) for c, i in zip(VISIBLE, order, strict=True)])
