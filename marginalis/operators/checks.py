"""Checks that fail before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


class CheckFailed(ValueError):
    """A table breaks a rule; nothing has been written."""


def _first(bad: DataFrame, rule: str) -> None:
    row = bad.limit(1).collect()
    if row:
        raise CheckFailed(f"{rule}: {row[0].asDict()}")


def require(df: DataFrame, condition: Column, rule: str) -> None:
    """Every row fulfils the condition; null counts as no."""
    _first(df.where(~F.coalesce(condition, F.lit(False))), rule)


def require_keys(df: DataFrame, keys: list[str], rule: str = "keys must be present and unique") -> None:
    """Keys are neither null nor blank, and no two rows have the same."""
    blank = F.lit(False)
    for k in keys:
        blank = blank | (S.strip(F.col(k)) == "")
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    _first(counts.where(blank | (F.col("rows") > 1)), rule)


def require_targets(writes: DataFrame, stored: DataFrame, keys: list[str]) -> None:
    """Every row to write has a stored one."""
    _first(writes.select(*keys).join(stored.select(*keys), keys, "left_anti"), "row to write isn't stored")


def require_unchanged(plan: DataFrame) -> None:
    """A version that is known already must not change entries."""
    _first(plan.where("change_type in ('NEW', 'UPDATED', 'REMOVED')").select("change_type"), "known version changes entries")


def require_versions(desired: DataFrame, stored: DataFrame) -> None:
    """A stored version id belongs to the same document and hash."""
    j = desired.select("version_id", "document_key", F.lower("pdf_sha256").alias("sha")).join(stored.select("version_id", F.col("document_key").alias("d2"), F.lower("pdf_sha256").alias("s2")), "version_id")
    _first(j.where((F.col("document_key") != F.col("d2")) | (F.col("sha") != F.col("s2"))), "version id is taken by another document or hash")
