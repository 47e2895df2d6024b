"""Review queue of unresolved authors, its upsert, and rules from decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

# Samples kept per group, and the length of a content sample.
SAMPLE_IDS, SAMPLE_PAGES, SAMPLE_CONTENTS, CONTENT_LENGTH = 5, 8, 3, 160

KEY = ["document_key", "version_id", "raw_author"]


def _first_values(rows: DataFrame, value: str, order: list[str], most: int, out: str, between: str) -> DataFrame:
    """Per key the first ``most`` distinct values in encounter order, joined.

    Values are made distinct with map-side combine, and a rank limit is applied
    before the shuffle, so a key with very many rows sends few.
    """
    first = rows.where(S.strip(F.col(value)) != "").groupBy(*KEY, F.col(value).alias("_v")).agg(F.min(F.struct(*order)).alias("_at"))
    ranked = first.withColumn("_r", F.row_number().over(Window.partitionBy(*KEY).orderBy("_at", "_v"))).where(F.col("_r") <= most)
    return ranked.groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_v"))), lambda x: x["_v"].cast("string")), between).alias(out))


def review_queue(entries: DataFrame, order: list[str]) -> DataFrame:
    """One row per (document, version, raw author as typed) with unresolved
    entries: how many, and the first few ids, pages and contents in ``order``.

    A page is the book page, else the number of the file's page; a content is
    the entry's, else its comment, where there is such a column.  Contents are
    cut to their sample length before they are made distinct.
    """
    has = lambda c: F.nullif(S.text(F.col(c)), F.lit("")) if c in entries.columns else F.lit(None).cast("string")
    open_ = entries.where(F.upper(S.strip(F.col("author_status"))) != "RESOLVED").select(
        S.strip(F.col("document_key")).alias("document_key"), S.strip(F.col("version_id")).alias("version_id"), S.text(F.col("raw_author")).alias("raw_author"),
        S.strip(F.col("entry_id")).alias("entry_id"), S.strip(F.coalesce(has("book_page"), F.nullif(has("pdf_page"), F.lit("0")))).alias("page"),
        F.substring(S.strip(F.coalesce(has("content"), has("comment"))), 1, CONTENT_LENGTH).alias("content"),
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
    )
    by = [f"_o{i}" for i in range(len(order))]
    out = open_.groupBy(*KEY).agg(F.count("*").alias("entry_count"))
    samples = (("entry_id", SAMPLE_IDS, "sample_entry_ids", ", "), ("page", SAMPLE_PAGES, "sample_pages", ", "), ("content", SAMPLE_CONTENTS, "sample_content", " | "))
    for value, most, name, between in samples:
        out = out.join(_first_values(open_, value, by, most, name, between), KEY, "left").withColumn(name, F.coalesce(name, F.lit("")))
    return out.select(F.concat_ws("::", *KEY).alias("review_key"), *KEY, "entry_count", "sample_entry_ids", "sample_pages", "sample_content")


SYSTEM_COLUMNS = ("document_key", "version_id", "raw_author", "entry_count", "sample_entry_ids", "sample_pages", "sample_content")


def review_upsert(queue: DataFrame, stored: DataFrame, human: list[str]) -> DataFrame:
    """The review table after an upsert: system columns from the queue where it
    has the key, human columns always from the stored row.  Adds write:
    INSERT, UPDATE or KEEP."""
    q = queue.select(F.col("review_key").alias("_q"), *[F.col(c).alias(f"q_{c}") for c in SYSTEM_COLUMNS])
    s = stored.select(F.col("review_key").alias("_s"), *[F.col(c).alias(f"s_{c}") for c in SYSTEM_COLUMNS], *human)
    j = q.join(s, F.col("_q") == F.col("_s"), "full_outer")
    return j.select(
        F.coalesce("_q", "_s").alias("review_key"),
        *[F.when(F.col("_q").isNotNull(), F.col(f"q_{c}")).otherwise(F.col(f"s_{c}")).alias(c) for c in SYSTEM_COLUMNS],
        *[S.text(F.col(h)).alias(h) for h in human],
        F.when(F.col("_s").isNull(), "INSERT").when(F.col("_q").isNull(), "KEEP").otherwise("UPDATE").alias("write"),
    )


def approved_rules(review: DataFrame) -> DataFrame:
    """VERSION rules from rows decided APPROVE with a canonical author; a blank
    scope means VERSION, another one fails."""
    chosen = review.where((F.upper(S.strip(F.col("decision"))) == "APPROVE") & (S.strip(F.col("canonical_author")) != ""))
    scope = F.upper(S.strip(F.col("rule_scope")))
    return chosen.select(
        F.concat(F.lit("PM::"), F.col("review_key")).alias("rule_id"),
        F.when(scope.isin("", "VERSION"), "VERSION").otherwise(F.raise_error(F.concat(F.lit("rule scope must be VERSION, not "), scope))).alias("scope"),
        "document_key", "version_id", F.lit("").alias("root_entry_id"), F.lit("").alias("entry_id"), "raw_author", S.strip(F.col("canonical_author")).alias("canonical_author"), F.lit("APPROVED").alias("status"),
    )


RULE_FIELDS = ("scope", "document_key", "version_id", "root_entry_id", "entry_id", "raw_author", "canonical_author", "status")


def promote_rules(review: DataFrame, stored: DataFrame) -> DataFrame:
    """The approved rules that aren't stored yet.  A stored rule with the same
    id must agree on all eight fields, else the query fails."""
    new = approved_rules(review)
    old = stored.select(F.col("rule_id").alias("_id"), F.struct(*[S.text(F.col(f)).alias(f) for f in RULE_FIELDS]).alias("_old"))
    j = new.join(old, F.col("rule_id") == F.col("_id"), "left")
    same = F.col("_old").eqNullSafe(F.struct(*[S.text(F.col(f)).alias(f) for f in RULE_FIELDS]))
    clash = F.col("_id").isNotNull() & ~same
    return j.where(F.col("_id").isNull() | F.when(clash, F.raise_error(F.concat(F.lit("stored rule differs: "), F.col("rule_id")))).otherwise(F.lit(False))).select(*new.columns)
