"""The flat table of annotations: rows, upsert by identity, and reviewers'
tables made from it alone."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import cut
from . import output
from .checks import require

# Columns of the flat table, in order; the last two don't count as content.
DATABASE = (
    "annotation_key", "reviewer", "raw_author", "pdf_name", "drive_file_id", "drive_link", "pdf_sha256", "pdf_page", "book_page", "mapping_method", "mapping_confidence", "annotation_type", "category", "comment",
    "selected_text", "created_date", "modified_date", "annotation_id", "reply_to", "subject", "coordinates", "xref", "active", "source_state", "first_seen", "last_seen",
)
CONTENT = DATABASE[:24]

# Columns of a row for review, in order.
NEEDS_REVIEW = ("logged_at", "drive_file_id", "source_file", "issue_type", "reviewer", "raw_author", "pdf_page", "page_candidate", "comment", "details", "status", "notes")


def database_rows(annotations: DataFrame, file_id: Column, link: Column, now: Column) -> DataFrame:
    """Annotations as rows of the flat table, first and last seen at ``now``."""
    named = {
        "annotation_key": "identity_key", "pdf_name": "source_file", "pdf_sha256": "source_sha256", "mapping_method": "mapping_method", "created_date": "created", "modified_date": "modified", "reply_to": "reply_to_xref",
    }
    made = {
        "drive_file_id": file_id, "drive_link": link, "coordinates": S.coordinates(*[F.col(f"rect_{c}") for c in ("x0", "y0", "x1", "y1")]), "active": F.lit("true"),
        "source_state": output.source_state(F.col("reviewer"), F.col("book_page"), F.col("footer_status")), "first_seen": now, "last_seen": now, "category": F.col("category") if "category" in annotations.columns else F.lit(""),
    }
    return annotations.select(*[S.text(made[c] if c in made else F.col(named.get(c, c))).alias(c) for c in DATABASE])


def needs_review_rows(annotations: DataFrame, file_id: Column, now: Column) -> DataFrame:
    """The rows that a person must look at, one per annotation that isn't
    current; the printed page goes before the mapped one."""
    rows = annotations.where(output.needs_review(F.col("reviewer"), F.col("book_page"), F.col("footer_status")))
    issue = output.issue_text(F.col("reviewer"), F.col("book_page"), F.col("footer_status"))
    made = {
        "logged_at": now, "drive_file_id": file_id, "issue_type": issue, "details": issue, "status": F.lit("OPEN"), "notes": F.lit(""),
        "page_candidate": F.coalesce(S.blank_null(F.col("footer_page_candidate")), S.text(F.col("book_page"))),
    }
    return rows.select(*[S.text(made[c] if c in made else F.col(c)).alias(c) for c in NEEDS_REVIEW])


@dataclass(frozen=True)
class Upsert:
    """The flat table after an upsert, what happened to each key, its counts."""

    table: DataFrame
    actions: DataFrame
    stats: DataFrame


def upsert_database(annotations: DataFrame, stored: DataFrame, file_id: Column, link: Column, now: str) -> Upsert:
    """Insert or update annotations in the flat table by identity key.

    Only import candidates (a null flag counts as one) are taken, the first in
    ``ord`` of rows with one key; later ones count as unchanged.  A stored row
    keeps its first_seen; it is updated if any of its first 24 columns differs
    as text, else it stays as it is.  Of stored rows with one key the one seen
    last counts.  stats has inserted, updated, unchanged, skipped and
    needs_review.  One full outer join by key.
    """
    candidate = F.coalesce(F.col("import_candidate"), F.lit(True))
    taken = annotations.where(candidate)
    first = output.first_per_key(taken, ["identity_key"], ["ord"])
    new = database_rows(first, file_id, link, F.lit(now))
    old = stored.groupBy(F.col("annotation_key").alias("_k")).agg(F.max(F.struct("last_seen", *[c for c in DATABASE if c != "last_seen"])).alias("old"))
    j = new.select(F.col("annotation_key").alias("_n"), F.struct(*DATABASE).alias("new")).join(old, F.col("_n") == F.col("_k"), "full_outer")
    differs = F.struct(*[F.col(f"new.{c}") for c in CONTENT]) != F.struct(*[S.text(F.col(f"old.{c}")) for c in CONTENT])
    action = F.when(F.col("_k").isNull(), "inserted").when(F.col("_n").isNull(), "kept").when(differs, "updated").otherwise("unchanged")
    # written: table, actions and counts all read it
    j = cut(j.withColumn("action", action))
    written = F.col("action").isin("inserted", "updated")
    seen = F.coalesce(S.blank_null(F.col("old.first_seen")), F.lit(now))
    table = j.select(*[F.when(written, seen if c == "first_seen" else F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in DATABASE])
    actions = j.select(F.coalesce("_n", "_k").alias("annotation_key"), "action")
    unresolved = output.needs_review(F.col("reviewer"), F.col("book_page"), F.col("footer_status"))
    names = ("inserted", "updated", "unchanged", "skipped", "needs_review")
    parts = (
        (actions, {a: F.count_if(F.col("action") == a) for a in names[:3]}),
        # a key's further rows change nothing
        (annotations, {"skipped": F.count_if(~candidate), "unchanged": F.count_if(candidate)}),
        (first, {"needs_review": F.count_if(unresolved), "unchanged": -F.count("*")}),
    )
    stats = sum_up([rows.agg(*[(counts[n] if n in counts else F.lit(0).cast("long")).alias(n) for n in names]) for rows, counts in parts], names)
    return Upsert(table, actions, stats)


def sum_up(parts: list[DataFrame], names: tuple[str, ...]) -> DataFrame:
    """One row with the sums of tables of counts."""
    return reduce(DataFrame.unionByName, parts).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def database_visible(rows: DataFrame) -> DataFrame:
    """Rows of the flat table as reviewers see them; the native id is their
    id, else the key."""
    named = {"pdf_drive_link": "drive_link", "page": "book_page", "author": "reviewer", "last_modified": "modified_date"}
    made = {"comment_id": F.coalesce(S.blank_null(F.col("annotation_id")), S.strip(F.col("annotation_key"))), "resolved": F.lit(""), "replies": F.lit("")}
    return rows.select("*", *[S.text(made[c] if c in made else F.col(named.get(c, c))).alias(f"v_{c}") for c in output.VISIBLE]).select(
        "annotation_key", F.col("reviewer"), *[F.col(f"v_{c}").alias(c) for c in output.VISIBLE]
    )


def eligible_database(database: DataFrame, order: str = "annotation_key") -> DataFrame:
    """Visible rows of current, active records with a reviewer and an id, one
    per reviewer and id: the first in ``order``."""
    current = database.where((S.strip(F.col("reviewer")) != "") & S.truthy(F.col("active")) & (S.strip(F.col("source_state")) == "CURRENT"))
    rows = database_visible(current.withColumn("reviewer", S.strip(F.col("reviewer"))))
    return output.first_per_key(rows.where(F.col("comment_id") != ""), ["reviewer", "comment_id"], [order])


def tab_of(reviewer: Column, tabs: dict[str, str]) -> Column:
    """The table a reviewer's rows go to: the one configured, else by name."""
    if not tabs:
        return S.strip(reviewer)
    named = F.create_map(*[F.lit(x) for item in tabs.items() for x in item])
    return S.strip(F.coalesce(F.try_element_at(named, reviewer), reviewer))


def reconcile(database: DataFrame, stored: DataFrame, tabs: dict[str, str] | None = None, order: str = "annotation_key") -> tuple[DataFrame, DataFrame]:
    """(rows, stats) of all reviewers' tables from the flat table alone.

    ``stored`` has the tables' rows with ``tab`` and a ``row_no`` that tells
    them apart.  rows: tab, write (INSERT, UPDATE or UNCHANGED), stored_id and
    the merged columns.  stats: per tab its reviewer, how many are eligible and
    how many of each write; tables of which nothing is eligible have no row.
    Fails before any write if a reviewer's table has a blank name or several
    stored rows fit one comment.  Rows match within their table only.
    """
    desired = eligible_database(database, order).withColumn("tab", tab_of(F.col("reviewer"), tabs or {}))
    require(desired, F.col("tab") != "", "a reviewer's table has no name")
    # a table's name goes into every key, so all tables are matched at once
    at = lambda c: F.concat(F.col("tab"), F.lit("\x1d"), S.text(F.col(c)))
    d = desired.withColumns({"comment_id": at("comment_id"), "page": at("page"), "ord": F.col("comment_id")})
    s = stored.withColumns({"comment_id": F.when(S.strip(F.col("comment_id")) == "", "").otherwise(at("comment_id")), "page": at("page")})
    matched = cut(output.match_output(d, s))
    require(matched, F.col("match") != "AMBIGUOUS", "several stored rows fit one comment")
    plain = lambda c: F.element_at(F.split(c, "\x1d", 2), 2)
    merged = output.merge_fields(matched, stored, ["tab", "reviewer"]).withColumns({"comment_id": plain("comment_id"), "page": plain("page")})
    before = stored.select(F.col("row_no").alias("_row"), F.struct(*[S.text(F.col(c)).alias(c) for c in output.VISIBLE]).alias("_before"))
    same = F.struct(*[S.text(F.col(c)).alias(c) for c in output.VISIBLE]) == F.col("_before")
    rows = merged.join(before, F.col("stored_id") == F.col("_row"), "left").withColumn("write", F.when(F.col("stored_id").isNull(), "INSERT").when(same, "UNCHANGED").otherwise("UPDATE")).drop("_row", "_before", "match")
    count = lambda w: F.count_if(F.col("write") == w)
    stats = rows.groupBy("tab", "reviewer").agg(F.count("*").alias("eligible"), count("INSERT").alias("inserted"), count("UPDATE").alias("updated"), count("UNCHANGED").alias("unchanged"))
    return rows, stats


def reconcile_totals(database: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: records, eligible and skipped ones, reviewers, and the writes
    of all tables."""
    names = ("database_records", "eligible_records", "inserted", "updated", "unchanged", "reviewers")
    parts = (
        (database, {"database_records": F.count("*")}),
        (stats, {"eligible_records": F.sum("eligible"), **{n: F.sum(n) for n in names[2:5]}, "reviewers": F.countDistinct("reviewer")}),
    )
    out = sum_up([rows.agg(*[(counts[n] if n in counts else F.lit(0).cast("long")).alias(n) for n in names]) for rows, counts in parts], names)
    return out.withColumn("skipped_records", F.col("database_records") - F.col("eligible_records"))


#: Columns of a reviewer's table that the public view leaves out.
HIDDEN = ("created_date", "last_modified", "comment_id", "annotation_type")


def public_view(rows: DataFrame) -> DataFrame:
    return rows.drop(*HIDDEN)
