"""Explicit schemas of the stored tables and of the extractor's rows."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(text: str) -> T.StructType:
    """name[:type] separated by blanks; string where no type is given."""
    kinds = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    out = []
    for item in text.split():
        name, _, kind = item.partition(":")
        out.append(T.StructField(name, kinds.get(kind, T.StringType())))
    return T.StructType(out)


ANNOTATION = _fields(
    """schema_version ord:int document_key source_file source_sha256 reviewer raw_author pdf_page:int book_page mapping_method mapping_confidence:double annotation_type comment selected_text
    subject created modified annotation_id entry_id parent_entry_id root_entry_id entry_type relation_type relation_raw reply_depth:int parent_xref:int identity_key fallback_fingerprint xref:int
    reply_to_xref:int rect_x0:double rect_y0:double rect_x1:double rect_y1:double is_empty:boolean import_candidate:boolean skip_reason footer_page_candidate footer_status"""
)

ENTRIES = _fields(
    """entry_key document_key version_id drive_file_id pdf_name drive_link pdf_sha256 entry_id entry_signature parent_entry_id root_entry_id entry_type reply_depth:int raw_author canonical_author
    author_status author_resolution_method author_rule_id pdf_page:int book_page page_mapping_method page_mapping_confidence:double annotation_type relation_type category content selected_text
    created_date modified_date coordinates xref:int active:boolean source_state first_seen last_seen"""
)

HISTORY = _fields(
    """history_key document_key version_id drive_file_id pdf_sha256 entry_id entry_signature change_type previous_signature raw_author canonical_author author_status parent_entry_id root_entry_id
    entry_type reply_depth:int pdf_page:int book_page annotation_type relation_type category content selected_text created_date modified_date coordinates xref:int active:boolean source_state recorded_at"""
)

VERSIONS = _fields(
    """version_id document_key drive_file_id pdf_name drive_link modified_time size_bytes:long pdf_sha256 version_status authors_found pages:int entries_found:int root_comments:int replies:int
    processed_at message_error"""
)

DOCUMENTS = _fields("document_key document_name output_tab master_version current_version_id current_drive_file_id current_pdf_sha256 current_modified_time status last_processed")

RULES = _fields("rule_id scope document_key version_id root_entry_id entry_id raw_author canonical_author status approved_by approved_at notes rule_ord:long")

REVIEW = _fields(
    """review_key document_key version_id raw_author entry_count:long sample_entry_ids sample_pages sample_content suggested_canonical_author decision canonical_author rule_scope reviewed_by
    reviewed_at notes"""
)

FILES = _fields(
    """file_log_id:long drive_file_id pdf_name drive_link modified_time size_bytes:long pdf_sha256 reviewer status pages:int annotations_found:int new_count:int updated_count:int
    unchanged_count:int skipped_empty:int processed_at message_error"""
)

TABLES = {"entries": ENTRIES, "history": HISTORY, "versions": VERSIONS, "documents": DOCUMENTS, "rules": RULES, "review": REVIEW, "files": FILES}
