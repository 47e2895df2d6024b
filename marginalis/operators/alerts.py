"""Alerts from the results of processed files."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Code, severity, audience, whether a manager can act on it.
ALERTS = {
    "PDF_PROCESSING_ERROR": ("ERROR", ("ADMIN", "PM"), True),
    "PDF_PROCESSED": ("INFO", ("ADMIN", "PM"), False),
    "REVIEWER_UNRESOLVED": ("WARNING", ("ADMIN", "PM"), True),
    "PAGE_MAPPING_UNRESOLVED": ("WARNING", ("ADMIN", "PM"), True),
    "PAGE_NUMBER_MISMATCH": ("WARNING", ("ADMIN",), False),
    "MASTER_INDEX_MISMATCH": ("WARNING", ("ADMIN",), False),
    "PAGES_BEYOND_MASTER": ("INFO", ("ADMIN",), False),
    "NEEDS_REVIEW": ("WARNING", ("ADMIN", "PM"), True),
}


# What is said, with the places of columns in braces.
MESSAGES = {
    "PDF_PROCESSED": "{file} processed successfully; reviewer={reviewers}; new={inserted}; updated={updated}; unchanged={unchanged}.",
    "REVIEWER_UNRESOLVED": "Reviewer could not be resolved. Manual reviewer assignment may be required.",
    "PAGE_MAPPING_UNRESOLVED": "{pages_unresolved} page(s) could not be mapped automatically.",
    "PAGE_NUMBER_MISMATCH": "{footer_mismatches} page-number mismatch(es) detected.",
    "MASTER_INDEX_MISMATCH": "Possible master-index mismatch detected; coverage={coverage}; master={master_index_version}.",
    "PAGES_BEYOND_MASTER": "{pages_beyond_master} page(s) exceed the current master page count.",
    "NEEDS_REVIEW": "{needs_review} annotation(s) require manual review.",
}


def classify_results(results: DataFrame) -> DataFrame:
    """One to seven alerts per result row, in the order of ALERTS.

    ``results`` has file, status, error, reviewers (text, '' for none),
    inserted, updated, unchanged, pages_unresolved, footer_mismatches,
    master_suspect, coverage, master_index_version, pages_beyond_master,
    needs_review.  A failed file gives its error alone.  One pass: an array of
    conditional structs, exploded.
    """
    ok = F.col("status") != "ERROR"
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    shown = {
        "file": S.text(F.col("file")), "reviewers": F.coalesce(F.nullif(S.text(F.col("reviewers")), F.lit("")), F.lit("unresolved")),
        "coverage": F.format_string("%.1f%%", F.coalesce(F.col("coverage"), F.lit(0.0)) * 100), "master_index_version": S.text(F.col("master_index_version")),
    }

    def say(code: str) -> Column:
        parts = re.split(r"\{(\w+)\}", MESSAGES[code])
        return F.concat(*[F.lit(p) if i % 2 == 0 else shown[p] if p in shown else count(p).cast("string") for i, p in enumerate(parts)])

    conditions = {
        "PDF_PROCESSED": ok,
        "REVIEWER_UNRESOLVED": ok & (S.strip(F.col("reviewers")) == ""),
        "PAGE_MAPPING_UNRESOLVED": ok & (count("pages_unresolved") > 0),
        "PAGE_NUMBER_MISMATCH": ok & (count("footer_mismatches") > 0),
        "MASTER_INDEX_MISMATCH": ok & F.coalesce(F.col("master_suspect"), F.lit(False)),
        "PAGES_BEYOND_MASTER": ok & (count("pages_beyond_master") > 0),
        "NEEDS_REVIEW": ok & (count("needs_review") > 0),
    }
    conditions = {"PDF_PROCESSING_ERROR": (~ok, F.coalesce(F.nullif(S.text(F.col("error")), F.lit("")), F.lit("PDF processing failed.")))} | {code: (when, say(code)) for code, when in conditions.items()}
    structs = [
        F.when(
            cond,
            F.struct(F.lit(ALERTS[code][0]).alias("severity"), F.array(*map(F.lit, ALERTS[code][1])).alias("audience"), F.lit(code).alias("code"), message.alias("message"), F.lit(ALERTS[code][2]).alias("pm_actionable")),
        )
        for code, (cond, message) in conditions.items()
    ]
    return results.select("file", F.explode(F.array_compact(F.array(*structs))).alias("a")).select("file", "a.*")


# Texts of a switch that mean on.
ON = ("1", "true", "yes", "on")


def switched_on(name: str, default: bool = False, environment: dict[str, str] | None = None) -> bool:
    """A switch of the environment; unset means ``default``."""
    given = (os.environ if environment is None else environment).get(name)
    return default if given is None else given.strip().lower() in ON


def deliver(rows: DataFrame, send, enabled: bool) -> int:
    """Hand each notice to ``send`` on the driver, one after the other, and
    return how many were taken; nothing if notices aren't ``enabled``.  A notice
    that fails stops neither the others nor the run."""
    done = 0
    for row in rows.where(F.size("recipients") > 0).toLocalIterator() if enabled else ():
        try:
            send(row.asDict())
            done += 1
        except Exception:  # noqa: BLE001  delivery is not part of the result
            continue
    return done


def notices(alerts: DataFrame, recipients: dict[str, list[str]]) -> DataFrame:
    """Add recipients (by audience, each once), subject and body of a notice."""
    groups = F.map_from_entries(F.array(*[F.struct(F.lit(k), F.array(*map(F.lit, v)).cast("array<string>")) for k, v in recipients.items()]))
    return alerts.withColumns(
        {
            "recipients": F.array_distinct(F.flatten(F.transform(F.col("audience"), lambda a: F.coalesce(F.try_element_at(groups, a), F.array().cast("array<string>"))))),
            "subject": F.concat(F.lit("["), F.col("severity"), F.lit("] "), F.col("code"), F.lit(" - "), F.col("file")),
            "body": F.concat_ws(
                "\n", F.concat(F.lit("Severity: "), F.col("severity")), F.concat(F.lit("Code: "), F.col("code")), F.concat(F.lit("PDF: "), F.col("file")), F.lit(""), F.col("message"), F.lit(""),
                F.concat(F.lit("Manual action required: "), F.when(F.col("pm_actionable"), "Yes").otherwise("No")),
            ),
        }
    )
