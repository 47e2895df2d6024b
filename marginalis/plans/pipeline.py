"""One version of a document from extracted rows to committed state."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import authors, changes, checks, output, registry, review
from ..operators.hierarchy import resolve_threads
from ..schemas import DOCUMENTS, ENTRIES, FILES, HISTORY, REVIEW, RULES
from ..session import cut
from ..sources.store import SHARED, Store

SIGNED = ("raw_author", "pdf_page", "book_page", "annotation_type", "relation_type", "parent_entry_id", "root_entry_id", "reply_depth", "comment", "selected_text", "subject", "created", "modified", "rect_x0", "rect_y0", "rect_x1", "rect_y1")


@dataclass(frozen=True)
class Version:
    """What is known of a file before it is read."""

    document_key: str
    pdf_sha256: str
    drive_file_id: str = ""
    pdf_name: str = ""
    drive_link: str = ""
    modified_time: str = ""
    size_bytes: int = 0
    pages: int = 0
    processed_at: str = ""

    @property
    def version_id(self) -> str:
        if not self.document_key.strip() or len(self.pdf_sha256) != 64:
            raise checks.CheckFailed("a version needs a document key and a hash of 64 characters")
        return f"{self.document_key}@{self.pdf_sha256.lower()}"


@dataclass(frozen=True)
class Prepared:
    """The decision package of a run: lazy tables, nothing written."""

    version: Version
    entries: DataFrame
    plan: DataFrame
    mutations: changes.Mutations
    summary: DataFrame


def with_threads(rows: DataFrame) -> DataFrame:
    """Parent, root and depth of each row by its parent's number; of rows with
    one number the last counts as the parent."""
    keyed = rows.withColumn("relation_type", S.relation_type(F.col("parent_xref"), F.col("relation_raw")))
    parents = keyed.groupBy(F.col("source_sha256").alias("_s"), F.col("xref").alias("_x")).agg(F.max_by("entry_id", "ord").alias("_parent"))
    linked = keyed.join(parents, (F.col("source_sha256") == F.col("_s")) & (F.col("parent_xref") == F.col("_x")), "left").drop("_s", "_x")
    linked = cut(linked.withColumn("parent_entry_id", F.when(F.col("relation_type") == "ROOT", "").otherwise(F.coalesce("_parent", F.lit("")))))
    # a reply whose parent is missing keeps a parent id that nobody has
    seek = linked.select("source_sha256", "entry_id", F.coalesce("_parent", F.concat(F.lit("missing:"), F.col("parent_xref").cast("string"))).alias("p"), (F.col("relation_type") == "REPLY").alias("is_reply"))
    found = resolve_threads(seek, parent="p", is_child=F.col("is_reply")).select(F.col("scope").alias("source_sha256"), F.col("node").alias("entry_id"), F.col("root").alias("root_entry_id"), F.col("depth").cast("int").alias("reply_depth"))
    return linked.drop("_parent", "root_entry_id", "reply_depth").join(found, ["source_sha256", "entry_id"], "left")


def prepare(store: Store, version: Version, rows: DataFrame, aliases: dict[str, str] | None = None, historical: DataFrame | None = None) -> Prepared:
    """Everything a run would write, from the extractor's rows and the store."""
    spark = rows.sparkSession
    checks.require_keys(rows, ["entry_id"], "extracted entry ids must be present and unique")
    rules = store.read("rules", SHARED).withColumn("rule_ord", F.coalesce("rule_ord", F.lit(0))).select("rule_id", "scope", "document_key", "version_id", "root_entry_id", "entry_id", "raw_author", "canonical_author", "status", "rule_ord")
    base = rows.withColumns({"document_key": F.lit(version.document_key), "version_id": F.lit(version.version_id)})
    resolved = authors.resolve_authors(base, authors.effective_rules(authors.alias_rules(spark, aliases or {}), rules), historical)
    signed = resolved.withColumn("entry_signature", S.entry_signature(*[F.col(c) for c in SIGNED]))
    values = {
        "entry_key": F.concat_ws("::", "document_key", "entry_id"), "drive_file_id": F.lit(version.drive_file_id), "pdf_name": F.lit(version.pdf_name), "drive_link": F.lit(version.drive_link),
        "pdf_sha256": F.lit(version.pdf_sha256), "page_mapping_method": F.col("mapping_method"), "page_mapping_confidence": F.col("mapping_confidence"), "category": F.lit(None).cast("string"),
        "content": F.col("comment"), "created_date": F.col("created"), "modified_date": F.col("modified"), "coordinates": S.coordinates(*[F.col(f"rect_{c}") for c in ("x0", "y0", "x1", "y1")]),
        "active": F.lit(True), "source_state": F.lit("CURRENT"), "first_seen": F.lit(version.processed_at), "last_seen": F.lit(version.processed_at), "entry_type": F.when(F.col("relation_type") == "REPLY", "REPLY").otherwise("COMMENT"),
    }
    entries = cut(signed.select(*[(values[c] if c in values else F.col(c)).cast(ENTRIES[c].dataType).alias(c) for c in ENTRIES.fieldNames()]))
    stored = store.read("entries", version.document_key)
    checks.require_keys(stored, ["document_key", "entry_id"], "stored entries must be unique")
    plan = cut(changes.change_plan(entries, stored))
    written = [c for c in ENTRIES.fieldNames() if c not in ("active", "source_state", "first_seen", "last_seen")]
    return Prepared(version, entries, plan, changes.mutations(plan, version.processed_at, written), registry.version_rows(entries, ["document_key", "version_id"]))


@dataclass
class Result:
    action: str
    version_id: str
    counts: dict[str, int] = field(default_factory=dict)
    promoted_rules: int = 0


def execute(store: Store, version: Version, rows: DataFrame, aliases: dict[str, str] | None = None, historical: DataFrame | None = None, log_id: int | None = None, message: str = "") -> Result:
    """Commit one extracted version: approvals first, then the guard for known
    versions, then all tables of the document in one commit.  Every check runs
    before it.  Nothing of other documents is read or written."""
    spark = rows.sparkSession
    if not version.pdf_sha256:
        raise ValueError("rows without a content hash belong to no version")
    key = version.document_key
    stored_rules, stored_review = store.read("rules", SHARED), store.read("review", key)
    fresh = cut(review.promote_rules(stored_review, stored_rules))
    promoted = fresh.count()
    if promoted:
        # rules keep the order in which they were stored; a document's decisions are few
        last = stored_rules.agg(F.max("rule_ord")).first()[0] or 0
        numbered = fresh.withColumn("rule_ord", F.lit(last) + F.row_number().over(Window.orderBy("rule_id")))
        store.commit(append={"rules": numbered.select(*[F.col(c) if c in numbered.columns else F.lit("").alias(c) for c in RULES.fieldNames()])})
    prepared = prepare(store, version, rows, aliases, historical)
    counts = changes.change_counts(prepared.plan).first().asDict()
    known = not store.read("versions", key).where(F.lower("pdf_sha256") == version.pdf_sha256.lower()).isEmpty()
    if known:
        checks.require_unchanged(prepared.plan)
        if not counts["author_updated"]:
            return Result("DUPLICATE_VERSION", version.version_id, counts, promoted)
    queue = review.review_queue(prepared.entries, ["pdf_page", "xref", "entry_id"])
    human = ["suggested_canonical_author", "decision", "canonical_author", "rule_scope", "reviewed_by", "reviewed_at", "notes"]
    reviewed = review.review_upsert(queue, stored_review, human).select(*[F.col(c).cast(REVIEW[c].dataType) for c in REVIEW.fieldNames()])
    everything = store.read("entries", key)
    m = prepared.mutations
    touched = m.updates.select("document_key", "entry_id").unionByName(m.deactivations.select("document_key", "entry_id"))
    checks.require_targets(touched, everything, ["document_key", "entry_id"])
    after = changes.apply_mutations(everything, m)
    history = m.history.select(*[(F.col(c) if c in m.history.columns else F.lit(None)).cast(HISTORY[c].dataType).alias(c) for c in HISTORY.fieldNames()])
    status = "NEEDS_AUTHOR_REVIEW" if prepared.summary.agg(F.sum("unresolved_authors")).first()[0] else "PROCESSED"
    v = version
    row = prepared.summary.select(
        "version_id", "document_key", F.lit(v.drive_file_id).alias("drive_file_id"), F.lit(v.pdf_name).alias("pdf_name"), F.lit(v.drive_link).alias("drive_link"), F.lit(v.modified_time).alias("modified_time"), F.lit(v.size_bytes).cast("long").alias("size_bytes"),
        F.lit(v.pdf_sha256).alias("pdf_sha256"), "version_status", "authors_found", F.lit(v.pages).alias("pages"), F.col("entries_found").cast("int"), F.col("root_comments").cast("int"), F.col("replies").cast("int"), F.lit(v.processed_at).alias("processed_at"), F.lit("").alias("message_error"),
    )
    checks.require_versions(row, store.read("versions", key))
    document = spark.createDataFrame([(v.document_key, v.document_key, "", "", v.version_id, v.drive_file_id, v.pdf_sha256, v.modified_time, status, v.processed_at)], DOCUMENTS)
    log = spark.createDataFrame([(log_id or 0, v.drive_file_id, v.pdf_name, v.drive_link, v.modified_time, v.size_bytes, v.pdf_sha256, "", "PROCESSED", v.pages, sum(counts[k] for k in ("new", "updated", "author_updated", "unchanged")), counts["new"], counts["updated"] + counts["author_updated"], counts["unchanged"], 0, v.processed_at, message)], FILES)
    store.commit(
        replace={"entries": after, "review": reviewed, "documents": document},
        append={"history": history, "files": log} | ({} if known else {"versions": row}),
        document=key,
    )
    return Result("PROCESSED", version.version_id, counts, promoted)


#: Documents that are processed at the same time.
TOGETHER = 4


def _log_row(v: Version, status: str, message: str, log_id: int = 0) -> tuple:
    return (log_id, v.drive_file_id, v.pdf_name, v.drive_link, v.modified_time, v.size_bytes, v.pdf_sha256, "", status, 0, 0, 0, 0, 0, 0, v.processed_at, message)


def log_result(store: Store, v: Version, status: str, message: str) -> None:
    """A registry row of a version that wrote nothing else."""
    store.commit(append={"files": store.spark.createDataFrame([_log_row(v, status, message)], FILES)}, document=v.document_key)


def process_versions(store: Store, batch: list[tuple[Version, DataFrame]], dry_run: bool = False, aliases: dict[str, str] | None = None, historical: DataFrame | None = None) -> list[dict[str, Any]]:
    """Versions of a document one after the other, in the order of modified
    time, name and file: each is compared with what the one before left.
    Documents don't depend on each other; TOGETHER of them run at a time.  A
    failed version is logged and doesn't stop the others; a dry run only
    counts.  Results come in the order of all versions."""
    ordered = sorted(batch, key=lambda x: (x[0].modified_time, x[0].pdf_name, x[0].drive_file_id))

    def one(version: Version, rows: DataFrame) -> dict[str, Any]:
        try:
            if dry_run:
                return {"file": version.pdf_name, "action": "DRY_RUN", "import_candidates": rows.where("import_candidate").count()}
            done = execute(store, version, rows, aliases, historical)
            return {"file": version.pdf_name, "action": done.action, **done.counts}
        except Exception as problem:  # noqa: BLE001  one file's failure is its result
            if not dry_run:
                log_result(store, version, "ERROR", str(problem)[:500])
            return {"file": version.pdf_name, "action": "ERROR", "error": str(problem)}

    by_document: dict[str, list[int]] = {}
    for i, (version, _) in enumerate(ordered):
        by_document.setdefault(version.document_key, []).append(i)
    with ThreadPoolExecutor(TOGETHER) as pool:
        found = dict(item for items in pool.map(lambda numbers: [(i, one(*ordered[i])) for i in numbers], by_document.values()) for item in items)
    return [found[i] for i in range(len(ordered))]


def reconcile_output(annotations: DataFrame, stored: DataFrame) -> DataFrame:
    """A reviewer's table from the backend alone: eligible rows, the first per
    comment, matched with the stored table and merged; ambiguous matches fail."""
    desired = output.first_per_key(output.visible_rows(output.eligible_rows(annotations), F.lit("")), ["reviewer", "comment_id"], ["ord", "pdf_name"])
    matched = cut(output.match_output(desired, stored))
    checks.require(matched, F.col("match") != "AMBIGUOUS", "several stored rows fit one comment")
    return output.merge_fields(matched, stored)
