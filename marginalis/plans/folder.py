"""A whole run over a folder of documents: list, precheck, read, map pages,
name reviewers, link replies, commit, and say what happened."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import alerts, database, pages, registry, summaries
from ..schemas import ANNOTATION
from ..session import cut
from ..sources import files as F_
from ..sources import records
from ..sources.store import Store
from . import pipeline

#: What an extractor yields of each annotation beside its columns: the text of
#: its page, the page's own label, and the numbers printed at its foot.
EXTRACTED = T.StructType([*ANNOTATION.fields, T.StructField("page_text", T.StringType()), T.StructField("page_label", T.StringType()), T.StructField("footer_candidates", T.ArrayType(T.StringType()))])


def enrich(raw: DataFrame, config: dict[str, Any], master: DataFrame) -> DataFrame:
    """Extracted rows as ANNOTATION: mapped page, reviewer, import rule, ids
    and links between replies; one pass but for the joins with the edition's
    index and of replies with their parents."""
    generic = tuple(v.strip().lower() for v in config["generic_author_values"])
    text = lambda c: S.text(F.col(c))
    mapped = pages.map_pages(raw.drop("mapping_method", "mapping_confidence"), master, "page_text", "page_label", "footer_candidates")
    keep, reason = S.should_import(F.col("annotation_type"), F.col("comment"), config["empty_annotation_rules"])
    footer_only = F.col("mapping_method") == "footer_only_unverified"
    named = mapped.withColumns(
        {
            # a number that is only printed is a candidate, not a mapped page
            "book_page": F.when(footer_only, "").otherwise(F.col("mapped_page")),
            "footer_page_candidate": F.coalesce(F.try_element_at("footer_candidates", F.lit(1)), F.lit("")),
            "footer_status": F.when(footer_only, "footer_only").otherwise(F.regexp_extract("mapping_method", r"\+(\w+)$", 1)),
            "reviewer": S.reviewer_name(F.col("raw_author"), F.col("source_file"), config["reviewer_aliases"], F.lit(config.get("explicit_reviewer", "")), generic),
            "import_candidate": keep,
            "skip_reason": reason,
            "is_empty": S.strip(F.col("comment")) == "",
            "created": S.pdf_date(F.col("created")),
            "modified": S.pdf_date(F.col("modified")),
        }
    )
    printed = S.fingerprint(F.col("reviewer"), F.col("book_page"), F.col("annotation_type"), text("comment"), text("selected_text"), *[S.rounded(F.col(f"rect_{c}")) for c in ("x0", "y0", "x1", "y1")])
    made = named.withColumn("fallback_fingerprint", printed).withColumns(
        {
            "entry_id": S.entry_id(F.col("annotation_id"), F.col("fallback_fingerprint")),
            "identity_key": S.identity_key(F.col("reviewer"), F.col("book_page"), F.col("annotation_id"), F.col("fallback_fingerprint")),
        }
    )
    linked = pipeline.with_threads(made).withColumn("entry_type", F.when(F.col("relation_type") == "REPLY", "REPLY").otherwise("COMMENT"))
    return linked.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ANNOTATION.fields])


@dataclass
class Run:
    """What a run saw and did, and its alerts as rows."""

    files_seen: int
    results: list[dict[str, Any]] = field(default_factory=list)
    dry_run: bool = False
    alerts: DataFrame | None = None
    delivered: int = 0


def process_folder(
    store: Store, folder: str, extractor: F_.Extractor, config: dict[str, Any], master: DataFrame, processed_at: str, document: Callable[[str], str] | None = None, dry_run: bool = False, historical: DataFrame | None = None, pattern: str = "*.pdf", send: Callable[[dict], None] | None = None
) -> Run:
    """Process what is new in a folder.

    Files whose last registry row has the same time and size are skipped before
    anything is read.  The others are read by the cluster; one that can't be
    read, or whose version fails its checks, gives an ERROR result and a
    registry row and doesn't stop the rest.  ``document`` gives a file's
    document key (the configured one if None).  A dry run takes every file and
    writes nothing.  Alerts go to ``send`` only if notices are switched on.

    The driver holds one row per file of the folder.
    """
    spark = store.spark
    listed = F_.list_files(spark, folder, pattern).withColumn("drive_file_id", F.col("path"))
    checked = listed.withColumn("action", F.lit("PROCESS")) if dry_run else registry.precheck(listed, store.read("files"), sequence="processed_at")
    heads = F_.processing_order(checked).collect()
    run = Run(len(heads), [{"file": h["name"], "action": h["action"]} for h in heads if h["action"] != "PROCESS"], dry_run)
    todo = {h["path"]: h for h in heads if h["action"] == "PROCESS"}
    if not todo:
        return run
    chosen = spark.createDataFrame([(p, h["name"]) for p, h in todo.items()], "path string, name string")
    raw = cut(F_.extract(F_.with_contents(spark, chosen, folder, pattern), extractor, EXTRACTED).join(chosen, "path"))
    failed = {r["path"]: r["error"] for r in raw.where("error is not null").select("path", "error").collect()}
    shas = {r["path"]: r["sha256"] for r in raw.select("path", "sha256").distinct().collect()}
    rows = cut(enrich(raw.where("error is null").withColumns({"source_file": F.col("name"), "source_sha256": F.col("sha256")}).drop("path", "sha256", "error", "name"), config, master))
    batch, errors = [], []
    for path, h in todo.items():
        key = document(h["name"]) if document else records.document_key(config)
        version = pipeline.Version(key, shas.get(path, ""), path, h["name"], path, h["modified_time"], h["size_bytes"], 0, processed_at)
        if path in failed:
            errors.append({"file": h["name"], "action": "ERROR", "error": failed[path]})
            if not dry_run:
                pipeline.log_result(store, version, "ERROR", failed[path][:500])
        elif path in shas:
            batch.append((version, rows.where((F.col("source_sha256") == shas[path]) & (F.col("source_file") == h["name"]))))
        else:
            # nothing in it
            if not dry_run:
                pipeline.log_result(store, version, "PROCESSED", "")
            run.results.append({"file": h["name"], "action": "PROCESSED"} | dict.fromkeys(("new", "updated", "author_updated", "unchanged", "removed"), 0))
    run.results += errors + pipeline.process_versions(store, batch, dry_run, config["reviewer_aliases"], historical)
    run.alerts = _alerts(spark, run.results, rows, config)
    if send is not None:
        run.delivered = alerts.deliver(alerts.notices(run.alerts, config.get("recipients", {})), send, alerts.switched_on("NOTIFICATIONS_ENABLED"))
    return run


def _alerts(spark: SparkSession, results: list[dict[str, Any]], rows: DataFrame, config: dict[str, Any]) -> DataFrame:
    done = spark.createDataFrame(
        [(r["file"], "ERROR" if r["action"] == "ERROR" else "PROCESSED", r.get("error", ""), r.get("new", 0), r.get("updated", 0) + r.get("author_updated", 0), r.get("unchanged", 0)) for r in results if r["action"] in ("ERROR", "PROCESSED")],
        "file string, status string, error string, inserted int, updated int, unchanged int",
    )
    s = summaries.file_summary(rows, ["source_file"])
    waiting = rows.groupBy("source_file").agg(F.count_if(database.output.needs_review(F.col("reviewer"), F.col("book_page"), F.col("footer_status"))).alias("needs_review"))
    named = s.select("source_file", F.array_join("reviewers", ", ").alias("reviewers"), F.size("pages_unresolved").alias("pages_unresolved"), F.size("footer_mismatches").alias("footer_mismatches")).join(waiting, "source_file")
    joined = done.join(named, done["file"] == named["source_file"], "left").drop("source_file")
    return alerts.classify_results(joined.withColumns({"master_suspect": F.lit(False), "coverage": F.lit(0.0), "master_index_version": F.lit(""), "pages_beyond_master": F.lit(0), "reviewers": S.text(F.col("reviewers"))}))


@dataclass
class Routed:
    """What either backend did with a version, counted alike."""

    mode: str
    stats: dict[str, int]
    duplicate: bool
    result: Any


def synchronize(store: Store, version: pipeline.Version, rows: DataFrame, versioned: bool, flat: DataFrame | None = None, reviewers: DataFrame | None = None, config: dict[str, Any] | None = None, historical: DataFrame | None = None) -> Routed:
    """One version to the backend of versions, or to the flat table.

    The flat table's mode needs ``flat``, its stored rows, and ``reviewers``,
    the stored rows of reviewers' tables (see ``database.reconcile``); it
    returns the tables to write as its result and writes the registry row only.
    """
    config = config or records.load_config(None)
    names = ("inserted", "updated", "unchanged", "skipped", "needs_review", "output_inserted", "output_updated", "output_unchanged")
    if versioned:
        done = pipeline.execute(store, version, rows, config["reviewer_aliases"], historical)
        duplicate = done.action == "DUPLICATE_VERSION"
        c = done.counts
        stats = dict.fromkeys(names, 0) | {"inserted": c["new"], "updated": c["updated"] + c["author_updated"] + c["removed"], "unchanged": c["unchanged"], "author_updated": c["author_updated"], "removed": c["removed"]}
        stats["needs_review"] = store.read("entries", version.document_key).where("active and author_status <> 'RESOLVED'").count()
        if duplicate:
            stats |= {"inserted": 0, "updated": 0}
            pipeline.log_result(store, version, "DUPLICATE", "Known v2 document version")
        return Routed("V2", stats, duplicate, done)
    if flat is None or reviewers is None:
        raise ValueError("the flat table's mode needs its rows and the reviewers' tables")
    done = database.upsert_database(rows, flat, F.lit(version.drive_file_id), F.lit(version.drive_link), version.processed_at)
    written = done.table.where(F.col("drive_file_id") == version.drive_file_id)
    tables, tabs = database.reconcile(written, reviewers, config["reviewer_output_tabs"])
    output = tabs.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"output_{n}") for n in ("inserted", "updated", "unchanged")]).first().asDict()
    stats = dict.fromkeys(names, 0) | done.stats.first().asDict() | output
    pipeline.log_result(store, version, "PROCESSED", "")
    return Routed("LEGACY", stats, False, (done, tables))
