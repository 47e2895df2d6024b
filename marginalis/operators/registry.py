"""Registries of files and versions: latest row per key, prechecks, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def latest_per_key(log: DataFrame, key: str, sequence: str) -> DataFrame:
    """Of an append-only log, the last row of each key.

    Rows without a key are left out, those without a sequence come first; of
    rows with one sequence the largest counts.  One aggregation with map-side
    combine, no sort of a key's rows.
    """
    row = F.struct(sequence, *[c for c in log.columns if c != sequence])
    return log.where(S.strip(F.col(key)) != "").groupBy(F.col(key).alias("_key")).agg(F.max(row).alias("r")).select("r.*").select(*log.columns)


def precheck(files: DataFrame, log: DataFrame, key: str = "drive_file_id", sequence: str = "file_log_id") -> DataFrame:
    """Add action: SKIP_UNCHANGED if the log's last row of the file has the
    same modified time and size, else PROCESS."""
    last = latest_per_key(log, key, sequence).select(F.col(key).alias("_k"), F.col("modified_time").alias("_m"), F.col("size_bytes").alias("_s"))
    same = F.col("_m").eqNullSafe(F.col("modified_time")) & F.col("_s").eqNullSafe(F.col("size_bytes")) & F.col("_k").isNotNull()
    return files.join(last, files[key] == F.col("_k"), "left").withColumn("action", F.when(same, "SKIP_UNCHANGED").otherwise("PROCESS")).drop("_k", "_m", "_s")


def files_to_process(files: DataFrame, log: DataFrame, key: str = "drive_file_id", sequence: str = "file_log_id") -> DataFrame:
    """The files that precheck wouldn't skip, by an anti join."""
    last = latest_per_key(log, key, sequence)
    return files.join(last.select(key, "modified_time", "size_bytes"), [key, "modified_time", "size_bytes"], "left_anti")


def hash_precheck(files: DataFrame, log: DataFrame, key: str = "drive_file_id", sequence: str = "file_log_id", sha: str = "pdf_sha256") -> DataFrame:
    """Add owner_file_id and action: SKIP_DUPLICATE_FILE if the content's last
    row in the log belongs to another file; files without a hash are processed."""
    owner = latest_per_key(log, sha, sequence).select(F.lower(F.col(sha)).alias("_sha"), F.col(key).alias("owner_file_id"))
    owner = owner.groupBy("_sha").agg(F.max("owner_file_id").alias("owner_file_id"))
    joined = files.join(owner, F.lower(S.strip(F.col(sha))) == F.col("_sha"), "left").drop("_sha")
    return joined.withColumn("action", F.when(F.col("owner_file_id").isNotNull() & (F.col("owner_file_id") != F.col(key)), "SKIP_DUPLICATE_FILE").otherwise("PROCESS"))


def classify_versions(incoming: DataFrame, known: DataFrame, document: str = "document_key", sha: str = "pdf_sha256") -> DataFrame:
    """Add version_id and decision: DUPLICATE if the document has the content
    already, in any spelling of the hash, else NEW_VERSION."""
    seen = known.select(S.document_key(F.col(document)).alias("_d"), F.lower(S.strip(F.col(sha))).alias("_h"), F.lit(True).alias("_seen")).distinct()
    return (
        incoming.withColumn("_d", S.document_key(F.col(document)))
        .withColumn("_h", F.lower(S.strip(F.col(sha))))
        .join(seen, ["_d", "_h"], "left")
        .withColumn("version_id", S.version_id(F.col(document), F.col(sha)))
        .withColumn("decision", F.when(F.col("_seen"), "DUPLICATE").otherwise("NEW_VERSION"))
        .drop("_d", "_h", "_seen")
    )


def version_rows(entries: DataFrame, by: list[str]) -> DataFrame:
    """Per version: entries, roots, replies, unresolved authors, the raw
    authors found, and the status that follows."""
    unresolved = F.count_if(F.coalesce(F.col("author_status"), F.lit("")) != "RESOLVED")
    return entries.groupBy(*by).agg(
        F.count("*").alias("entries_found"),
        F.count_if(F.col("relation_type") != "REPLY").alias("root_comments"),
        F.count_if(F.col("relation_type") == "REPLY").alias("replies"),
        unresolved.alias("unresolved_authors"),
        F.array_join(F.array_sort(F.collect_set(S.blank_null(F.col("raw_author")))), ", ").alias("authors_found"),
        F.when(unresolved > 0, "NEEDS_AUTHOR_REVIEW").otherwise("PROCESSED").alias("version_status"),
    )


def document_rows(versions: DataFrame) -> DataFrame:
    """Per document the state after its last version by modified time."""
    last = F.max(F.struct("modified_time", "version_id", "drive_file_id", "pdf_sha256", "version_status")).alias("v")
    return versions.groupBy("document_key").agg(last, F.countDistinct("version_id").alias("versions")).select(
        "document_key", F.col("v.version_id").alias("current_version_id"), F.col("v.drive_file_id").alias("current_drive_file_id"),
        F.col("v.pdf_sha256").alias("current_pdf_sha256"), F.col("v.modified_time").alias("current_modified_time"), F.col("v.version_status").alias("status"), "versions",
    )


def upsert_plan(desired: DataFrame, stored: DataFrame, key: str, update: bool) -> DataFrame:
    """Add write: INSERT for new keys; UPDATE (documents) or EXISTING
    (versions, which are written once) for stored ones."""
    known = stored.select(F.col(key).alias("_k")).where("_k is not null").distinct()
    return desired.join(known, desired[key] == F.col("_k"), "left").withColumn("write", F.when(F.col("_k").isNull(), "INSERT").otherwise("UPDATE" if update else "EXISTING")).drop("_k")


def log_message(rows: DataFrame) -> DataFrame:
    """Add message: what there is to say of a processed file, joined by '; '.

    ``rows`` has the numbers pages_mapped, pages, skipped, pages_unresolved,
    footer_mismatches and pages_beyond_master, the flag
    master_mismatch_suspected, and the texts master_index_version and error.
    Nothing is said of null, 0, false or an empty text, but pages_mapped is
    given unless it is null.
    """
    n = lambda c: F.col(c).cast("string")
    counted = lambda c, words: F.when(F.coalesce(F.col(c), F.lit(0)) > 0, F.concat(n(c), F.lit(f" {words}")))
    return rows.withColumn(
        "message",
        F.concat_ws(
            "; ",
            F.when(F.col("pages_mapped").isNotNull(), F.concat(n("pages_mapped"), F.lit("/"), F.coalesce(n("pages"), F.lit("0")), F.lit(" pages mapped"))),
            counted("skipped", "empty annotations skipped"),
            counted("pages_unresolved", "unresolved pages"),
            counted("footer_mismatches", "footer mismatches"),
            counted("pages_beyond_master", "pages beyond master"),
            F.when(F.coalesce(F.col("master_mismatch_suspected"), F.lit(False)), "possible master-index mismatch"),
            F.concat(F.lit("master="), F.nullif(S.text(F.col("master_index_version")), F.lit(""))),
            F.nullif(S.text(F.col("error")), F.lit("")),
        ),
    )


def registry_rows(files: DataFrame, now: str) -> DataFrame:
    """Processed files as rows of the registry: what ``log_message`` takes, and
    file_id, name, link, modified_time, size_bytes, sha256, reviewers (an
    array), status, annotations_found, inserted, updated and unchanged."""
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    return log_message(files).select(
        F.col("file_id").alias("drive_file_id"), F.col("name").alias("pdf_name"), S.text(F.col("link")).alias("drive_link"), S.text(F.col("modified_time")).alias("modified_time"), F.coalesce("size_bytes", F.lit(0)).cast("long").alias("size_bytes"),
        S.text(F.col("sha256")).alias("pdf_sha256"), F.array_join(F.coalesce("reviewers", F.array().cast("array<string>")), ", ").alias("reviewer"), "status", count("pages").alias("pages"), count("annotations_found").alias("annotations_found"),
        count("inserted").alias("new_count"), count("updated").alias("updated_count"), count("unchanged").alias("unchanged_count"), count("skipped").alias("skipped_empty"), F.lit(now).alias("processed_at"), F.col("message").alias("message_error"),
    )
