"""Summaries of extracted files, and what is known of a reference edition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .pages import LEAST_COVERAGE


def _sorted_texts(col: Column, folded: bool = False) -> Column:
    """Distinct texts that aren't blank, by code point or in any case."""
    values = F.collect_set(S.blank_null(col))
    if not folded:
        return F.array_sort(values)
    return F.transform(F.array_sort(F.transform(values, lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))), lambda x: x["v"])


def sorted_pages(col: Column) -> Column:
    """Distinct page names: numbers first and by value, then the others."""
    key = lambda p: F.struct((~p.rlike(r"^\d{1,18}$")).alias("text"), F.coalesce(p.try_cast("long"), F.lit(0)).alias("number"), p.alias("page"))
    return F.transform(F.array_sort(F.transform(F.collect_set(S.blank_null(col)), key)), lambda x: x["page"])


def file_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per file: entries by relation and kind, import candidates and
    skipped ones, deepest reply, reviewers, raw authors in any case's order,
    book pages (numbers first), pages without a book page, and pages whose
    printed number differs.  One aggregation with map-side combine."""
    count = lambda condition: F.count_if(F.coalesce(condition, F.lit(False)))
    candidate = F.coalesce(F.col("import_candidate"), F.lit(False))
    return rows.groupBy(*by).agg(
        F.count("*").alias("entries_found"),
        count(candidate).alias("import_candidates"),
        count(~candidate).alias("skipped"),
        *[count(F.col("relation_type") == r).alias(f"{r.lower()}_relations") for r in ("ROOT", "REPLY", "GROUP")],
        count(F.col("entry_type") == "COMMENT").alias("comments_found"),
        count(F.col("entry_type") == "REPLY").alias("replies_found"),
        F.coalesce(F.max("reply_depth"), F.lit(0)).alias("max_reply_depth"),
        _sorted_texts(F.col("reviewer")).alias("reviewers"),
        _sorted_texts(F.col("raw_author"), folded=True).alias("raw_authors"),
        sorted_pages(F.col("book_page")).alias("book_pages"),
        F.array_sort(F.collect_set(F.when(S.strip(F.col("book_page")) == "", F.col("pdf_page")))).alias("pages_unresolved"),
        F.array_sort(F.collect_set(F.when(F.col("footer_status") == "footer_mismatch", F.col("pdf_page")))).alias("footer_mismatches"),
    )


def skipped_by_reason(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per file with skipped rows a map of reason to how many."""
    counts = rows.where(S.strip(F.col("skip_reason")) != "").groupBy(*by, "skip_reason").count()
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("skip_reason", "count")))).alias("skipped"))


def master_metadata(index: DataFrame, digest: Column) -> DataFrame:
    """One row: version ('sha256:' and twelve digits of ``digest``), the last
    page of the edition (0 if none is a number), and its fingerprints."""
    page = F.when(S.text(F.col("master_pdf_page")).rlike(r"^\d{1,9}$"), F.col("master_pdf_page").cast("int"))
    return index.agg(F.coalesce(F.max(page), F.lit(0)).alias("expected_pages"), F.count("*").alias("fingerprint_count")).select(
        F.concat(F.lit("sha256:"), F.substring(digest, 1, 12)).alias("version"), digest.alias("sha256"), "expected_pages", "fingerprint_count"
    )


def master_compatibility(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add to files (pages, pages_mapped) what the edition says of them: its
    version, coverage to four decimals, pages beyond it, and whether it is the
    wrong one: only if too few pages are mapped, as a file may well be longer.
    ``metadata`` has one row, which the driver reads."""
    pages, mapped = F.coalesce("pages", F.lit(0)), F.coalesce("pages_mapped", F.lit(0))
    coverage = F.when(pages > 0, F.bround(mapped / pages, 4)).otherwise(0.0)
    edition = metadata.select("version", "expected_pages").first()
    return files.withColumns(
        {
            "master_index_version": F.lit(edition["version"]),
            "mapping_coverage": coverage,
            "pages_beyond_master": F.greatest(pages - edition["expected_pages"], F.lit(0)),
            "master_mismatch_suspected": (pages > 0) & (mapped / F.nullif(pages, F.lit(0)) < LEAST_COVERAGE),
        }
    )
